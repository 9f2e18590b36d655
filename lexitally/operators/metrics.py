"""Classification metrics from confusion counts.

Predictions are rows (label, predicted) plus any experiment keys in `by`; one
grouped count reduces them to classes x classes cells per experiment, and every
metric is arithmetic on those cells.
"""

from pyspark.sql import functions as F


def confusion_cells(predictions, label, classes, by=(), predicted="predicted"):
    """(by, actual, predicted, count) for every pair of classes, zeros included."""
    counted = predictions.groupBy(*by).agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(predicted) == p)).alias(f"_{i}_{j}")
            for i, a in enumerate(classes)
            for j, p in enumerate(classes)
        ]
    )
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"_{i}_{j}").alias("count"))
            for i, a in enumerate(classes)
            for j, p in enumerate(classes)
        ]
    )
    return counted.select(*by, F.inline(cells))


def confusion_matrix(cells, classes, by=()):
    """Wide form: rows actual_x, columns pred_y."""
    wide = cells.groupBy(*by, "actual").agg(
        *[F.sum(F.when(F.col("predicted") == p, F.col("count")).otherwise(0)).alias(f"pred_{p}") for p in classes]
    )
    return wide.withColumn("actual", F.concat(F.lit("actual_"), "actual"))


def _ratio(top, bottom):
    return F.when(bottom > 0, top / F.greatest(bottom, F.lit(1))).otherwise(F.lit(0.0))


def _class_table(cells, by):
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("count").alias("s"), F.lit(0).cast("long").alias("g"), hit.cast("long").alias("t")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("s"), F.col("count").alias("g"), F.lit(0).cast("long").alias("t")),
    )
    per_class = cells.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("s").alias("support"), F.sum("g").alias("_guessed"), F.sum("t").alias("_hits")
    )
    measured = per_class.withColumns(
        {"precision": _ratio(F.col("_hits"), F.col("_guessed")), "recall": _ratio(F.col("_hits"), F.col("support"))}
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / F.when(both > 0, both)).otherwise(F.lit(0.0))
    return measured.withColumn("f1", f1)


def class_report(cells, by=(), digits=4, macro=True):
    """Precision, recall, F1 and support per class, with a macro average row; empty predictions count 0."""
    table = _class_table(cells, by)
    measures = ("precision", "recall", "f1")
    rows = table.select(*by, "class", *measures, "support")
    if macro:
        mean = table.groupBy(*by).agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
        rows = rows.unionByName(mean.withColumn("class", F.lit("macro avg")))
    return rows.withColumns({m: F.round(m, digits) for m in measures})


def summary(cells, by=(), digits=4):
    """Accuracy, macro precision, recall and F1, and support-weighted F1."""
    out = _class_table(cells, by).groupBy(*by).agg(
        F.round(F.sum("_hits") / F.sum("support"), digits).alias("accuracy"),
        F.round(F.avg("precision"), digits).alias("macro_precision"),
        F.round(F.avg("recall"), digits).alias("macro_recall"),
        F.round(F.avg("f1"), digits).alias("macro_f1"),
        F.round(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), digits).alias("weighted_f1"),
    )
    return out


def majority_baseline(df, label, classes, digits=4):
    """Metrics of always answering the most frequent class (smallest label on ties)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label)))).scalar()
    constant = df.where(F.col(label).isNotNull()).select(label, top.alias("predicted"))
    return summary(confusion_cells(constant, label, classes), digits=digits)
