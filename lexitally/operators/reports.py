"""Counts, shares, crosstabs and summaries of labelled posts."""

from functools import reduce
from operator import add

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.guards import row_count
from lexitally.functions.labels import display_name, negative_or_not, positive_or_not
from lexitally.operators.ordering import running_total
from lexitally.session import stored


def group_counts(df, *by, name="count"):
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def topic_distribution(df, topic="topic", names=K.TOPIC_DISPLAY):
    """Posts per topic with a display name, largest first."""
    counted = group_counts(df, topic).withColumn("topic_display", display_name(topic, names))
    return counted.orderBy(F.desc("count"), topic)


def crosstab(df, row, col, values):
    """Counts over a fixed list of column values, zero-filled, with a row total."""
    values = list(values)
    wide = df.where(F.col(col).isin(values)).groupBy(row).pivot(col, values).count()
    filled = wide.na.fill(0, [str(v) for v in values])
    return filled.withColumn("total", reduce(add, [F.col(f"`{v}`") for v in values]))


def row_percentages(wide, values, digits=1, total="total"):
    """Each value column as a percentage of the row total; the total is kept."""
    shares = {str(v): F.round(F.col(f"`{v}`") / F.col(total) * 100, digits) for v in values}
    return wide.withColumns(shares)


def share_of_group(df, keys, label, digits=1):
    """Counts per (keys, label) and their share of the keys; absent combinations stay absent.

    The shares are windowed over the aggregated counts, so a group has at most
    as many rows as there are labels.
    """
    counts = group_counts(df, *keys, label)
    of_group = F.sum("count").over(Window.partitionBy(*keys))
    return counts.withColumn("percentage", F.round(F.col("count") / of_group * 100, digits))


def label_trend(df, period, label, values=K.LABELS, digits=1):
    """Label counts and percentages per period, in calendar order."""
    counts = crosstab(df, period, label, values)
    shares = {f"{v}_pct": F.round(F.col(f"`{v}`") / F.col("total") * 100, digits) for v in values}
    return counts.withColumns(shares).orderBy(period)


def label_share_matrix(df, period, group, label, value, groups, digits=1):
    """Share of one label, periods x groups, with every period present and gaps null."""
    shares = share_of_group(df, [group, period], label, digits).where(F.col(label) == value)
    wide = shares.groupBy(period).pivot(group, list(groups)).agg(F.first("percentage"))
    periods = df.select(period).distinct()
    return periods.join(wide, period, "left").orderBy(period)


def spaced(c):
    """Underscores as spaces, for headings."""
    return F.replace(F.col(c), F.lit("_"), F.lit(" "))


def quality_summary(df, key="post_id", text="text_clean", label="final_sentiment", n_words="word_count", labels=K.LABELS):
    """Record counts, gaps, duplicates, word range and label counts as (metric, value).

    Per-key partial aggregation carries everything, so duplicates need no
    separate distinct.
    """
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(text).isNull()).alias("no_text"),
        F.count_if(F.col(label).isNull()).alias("no_label"),
        F.min(n_words).alias("lo"),
        F.max(n_words).alias("hi"),
        *[F.count_if(F.col(label) == x).alias(f"n_{x}") for x in labels],
    )
    row = per_key.agg(
        F.sum("n").alias("total_records"),
        F.sum("no_text").alias("missing_text"),
        F.sum("no_label").alias("missing_label"),
        F.sum(F.col("n") - 1).alias("duplicate_key"),
        F.min("lo").cast("long").alias("min_word_count"),
        F.max("hi").cast("long").alias("max_word_count"),
        *[F.sum(f"n_{x}").alias(f"{x}_records") for x in labels],
    )
    return row.unpivot([], row.columns, "metric", "value")


def preparation_summary(df, key="post_id", text="text_clean", prepared="text_no_stopwords", n_words="word_count_no_stopwords"):
    """Quality of the stop-word-free text as (metric, value)."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(text).isNull()).alias("no_text"),
        F.count_if(F.col(prepared).isNull()).alias("no_prepared"),
        F.count_if(F.trim(F.col(prepared)) == "").alias("empty"),
        F.min(n_words).alias("lo"),
        F.max(n_words).alias("hi"),
        F.sum(n_words).alias("words"),
    )
    row = per_key.agg(
        F.sum("n").cast("double").alias("total_records"),
        F.sum("no_text").cast("double").alias("missing_text_clean"),
        F.sum("no_prepared").cast("double").alias("missing_text_no_stopwords"),
        F.sum("empty").cast("double").alias("empty_text_no_stopwords"),
        F.sum(F.col("n") - 1).cast("double").alias("duplicate_post_id"),
        F.min("lo").cast("double").alias("word_count_no_stopwords_min"),
        F.max("hi").cast("double").alias("word_count_no_stopwords_max"),
        F.round(F.sum("words") / F.sum("n"), 2).alias("word_count_no_stopwords_mean"),
    )
    return row.unpivot([], row.columns, "metric", "value")


def topic_profile(df, topic="topic", key="post_id", ts="created_at", n_words="word_count"):
    return df.groupBy(topic).agg(
        F.count(key).alias("posts"),
        F.min(ts).alias("date_from"),
        F.max(ts).alias("date_to"),
        F.round(F.avg(n_words), 1).alias("avg_words"),
        F.max(n_words).alias("max_words"),
    )


def describe(df, column):
    """Count, mean, deviation, extremes and interpolated quartiles as one row.

    Quartiles are read off the running count over the distinct values, so no
    task ever holds all of them.
    """
    values = stored(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")), "distinct-values")
    ranked = running_total(values, column, "_n", "_before").withColumn("_last", values.agg(F.sum("_n")).scalar() - 1)

    def at(position):
        here = (F.col("_before") <= position) & (position < F.col("_before") + F.col("_n"))
        return F.max(F.when(here, F.col(column))).cast("double")

    quartiles = (0.25, 0.5, 0.75)
    place = {q: F.col("_last") * F.lit(q) for q in quartiles}
    summary = ranked.agg(
        F.sum("_n").alias("count"),
        F.round(F.sum(F.col(column) * F.col("_n")) / F.sum("_n"), 6).alias("mean"),
        F.max("_last").alias("_last"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
        *[at(F.floor(place[q])).alias(f"_lo{i}") for i, q in enumerate(quartiles)],
        *[at(F.ceil(place[q])).alias(f"_hi{i}") for i, q in enumerate(quartiles)],
    )
    between = {
        f"p{int(q * 100)}": F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (place[q] - F.floor(place[q]))
        for i, q in enumerate(quartiles)
    }
    mean = values.agg(F.sum(F.col(column) * F.col("_n")) / F.sum("_n")).scalar()
    spread = F.sum(F.col("_n") * F.pow(F.col(column) - mean, F.lit(2.0)))
    deviation = values.agg(F.when(F.sum("_n") > 1, F.round(F.sqrt(spread / F.greatest(F.sum("_n") - 1, F.lit(1))), 6))).scalar()
    return summary.withColumns({**between, "std": deviation}).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def temporal_coverage(df, ts="created_at"):
    """First and last timestamp, months and quarters with data."""
    months = df.groupBy(F.trunc(ts, "month").alias("m")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    return months.agg(
        F.min("lo").alias("start"),
        F.max("hi").alias("end"),
        F.count("m").alias("months"),
        F.count_distinct(F.trunc("m", "quarter")).alias("quarters"),
    )


def class_distribution(df, label):
    """Count and percentage per class."""
    counts = group_counts(df.where(F.col(label).isNotNull()), label)
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        F.col(label).alias("class"), "count", F.round(F.col("count") / total * 100, 2).alias("percentage")
    )


def imbalance_profile(df, label, by=(), test_size=K.TEST_SIZE):
    """Size, imbalance and majority-class baseline of a label column."""
    counts = group_counts(df.where(F.col(label).isNotNull()), *by, label)
    return counts.groupBy(*by).agg(
        F.sum("count").alias("records"),
        F.count(F.lit(1)).alias("n_classes"),
        (F.max("count") / F.min("count")).alias("imbalance_ratio"),
        (F.max("count") / F.sum("count")).alias("baseline_accuracy"),
        F.min(F.struct(F.col("count"), F.col(label)))[label].alias("minority_class"),
        F.min("count").alias("minority_count"),
        F.bround(F.min("count") * F.lit(test_size), 0).cast("long").alias("minority_in_test"),
    )


def target_options(df, label="final_sentiment"):
    """Imbalance of four ways to pose the task: three classes, polar only, negative or positive against the rest.

    Each row carries its four recodings as an array, so the table is read once.
    """
    recoded = F.array(
        F.struct(F.lit("A_multiclass_3_classes").alias("option"), F.col(label).alias("target")),
        F.struct(F.lit("B_binary_drop_neutral").alias("option"), F.when(F.col(label) != "neutral", F.col(label)).alias("target")),
        F.struct(F.lit("C_binary_negative_vs_rest").alias("option"), negative_or_not(label).alias("target")),
        F.struct(F.lit("D_binary_positive_vs_rest").alias("option"), positive_or_not(label).alias("target")),
    )
    options = df.where(F.col(label).isNotNull()).select(F.inline(recoded))
    profile = imbalance_profile(options, "target", by=["option"])
    all_rows = row_count(df.where(F.col(label).isNotNull()))
    return profile.select(
        "option",
        F.col("records").alias("records_kept"),
        F.round(F.col("records") / all_rows * 100, 1).alias("records_kept_pct"),
        "n_classes",
        F.round("imbalance_ratio", 2).alias("imbalance_ratio"),
        F.round(F.col("baseline_accuracy") * 100, 1).alias("baseline_accuracy_pct"),
        "minority_class",
        "minority_count",
        F.col("minority_in_test").alias("minority_in_test_set"),
    )


def class_weights(df, label, name="weight"):
    """Balanced weights n / (classes x class size)."""
    counts = group_counts(df.where(F.col(label).isNotNull()), label)
    per_class = counts.agg(F.sum("count") / F.count(F.lit(1))).scalar()
    return counts.select(label, (per_class / F.col("count")).alias(name))


def with_class_weights(df, label, name="weight"):
    """Every row with the balanced weight of its class."""
    return df.join(class_weights(df, label, name), label)
