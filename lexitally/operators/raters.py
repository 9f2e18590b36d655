"""Several raters per post: template, counts, vote, adjudication, agreement."""

from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.labels import normalise_label
from lexitally.functions.text import preview, strip


def annotation_template(posts, raters=K.RATERS, text="text_raw"):
    """The sheet raters fill in: readable preview, empty rater and label columns."""
    keys = [c for c in ("item_id", "post_id", "topic", "created_at", "url") if c in posts.columns]
    empty = [F.lit("").alias(c) for c in [*raters, "final_sentiment"]]
    return posts.select(*keys, preview(text).alias("text_preview"), *empty)


def _count_equal(raters, value):
    return reduce(add, [F.coalesce((F.col(r) == value).cast("int"), F.lit(0)) for r in raters])


def vote(sheet, raters=K.RATERS, labels=K.LABELS, min_valid=K.MIN_VALID_VOTES):
    """Plurality vote over the rater columns.

    An unknown label spoils the row; fewer than `min_valid` labels ask for more;
    one label ahead of all others wins (2-1-1 included); a tie goes to manual
    review. Plain column arithmetic, one pass, no shuffle.
    """
    normal = sheet.withColumns({r: normalise_label(r, labels) for r in raters})
    counts = {label: _count_equal(raters, label) for label in labels}
    tallied = normal.withColumns(
        {
            **{f"_n_{label}": n for label, n in counts.items()},
            "invalid_annotation_count": _count_equal(raters, K.INVALID),
        }
    )
    n = {label: F.col(f"_n_{label}") for label in labels}
    top = F.greatest(*n.values())
    winners = reduce(add, [(c == top).cast("int") for c in n.values()])
    winner = F.coalesce(*[F.when(c == top, label) for label, c in n.items()])
    decided = tallied.withColumn("valid_annotation_count", reduce(add, n.values())).withColumn(
        "final_sentiment",
        F.when(F.col("invalid_annotation_count") > 0, "invalid_label")
        .when(F.col("valid_annotation_count") < min_valid, "needs_review")
        .when(winners == 1, winner)
        .otherwise("manual_review"),
    )
    return decided.drop(*[f"_n_{label}" for label in labels])


def review_queue(voted, label="final_sentiment"):
    return voted.where(F.col(label).isin(K.REVIEW_STATES))


def adjudicate(voted, adjudications, key="post_id", label="final_sentiment", adjudicated="adjudicated_sentiment"):
    """Replace a manual-review label where a valid adjudication exists."""
    decided = adjudications.select(key, normalise_label(adjudicated, unknown=None).alias(adjudicated))
    current = F.lower(strip(label))
    use = (current == "manual_review") & F.col(adjudicated).isNotNull()
    return voted.join(decided, key, "left").withColumn(label, F.when(use, F.col(adjudicated)).otherwise(current))


def unresolved(resolved, label="final_sentiment", labels=K.LABELS):
    return resolved.where(F.col(label).isNull() | ~F.col(label).isin(list(labels)))


def vote_quality(voted, labels=K.LABELS):
    """Counts of decided and undecided posts as (metric, value)."""
    state = F.col("final_sentiment")
    row = voted.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(state.isin(list(labels))).alias("records_with_final_label"),
        F.count_if(state.isin(K.REVIEW_STATES)).alias("records_needing_review"),
        F.count_if(state == "needs_review").alias("needs_review_missing_annotations"),
        F.count_if(state == "manual_review").alias("manual_review_ties"),
        F.count_if(state == "invalid_label").alias("invalid_label_records"),
    )
    return row.unpivot([], row.columns, "metric", "value")


def resolution_quality(resolved, labels=K.LABELS):
    """Counts after adjudication as (metric, value)."""
    state = F.col("final_sentiment")
    row = resolved.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(state.isin(list(labels))).alias("resolved_final_records"),
        F.count_if(state.isNull() | ~state.isin(list(labels))).alias("remaining_unresolved_records"),
        *[F.count_if(state == label).alias(f"{label}_records") for label in reversed(labels)],
    )
    return row.unpivot([], row.columns, "metric", "value")


def cohen_kappa(sheet, raters=K.RATERS, labels=K.LABELS):
    """Cohen's kappa for every pair of raters, over posts both labelled.

    The pairs of rater columns are spelled out per row, so the aggregate is at
    most pairs x labels x labels groups and no post is joined with itself.
    """
    normal = sheet.select(*[normalise_label(r, labels, unknown=None).alias(r) for r in raters])
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("rater_a"), F.lit(b).alias("rater_b"), F.col(a).alias("a"), F.col(b).alias("b"))
            for a, b in combinations(raters, 2)
        ]
    )
    both = normal.select(F.inline(pairs)).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    count = F.count(F.lit(1))
    seen = both.groupBy("rater_a", "rater_b").agg(
        count.alias("n"),
        F.count_if(F.col("a") == F.col("b")).alias("agree"),
        *[F.count_if(F.col("a") == x).alias(f"a_{x}") for x in labels],
        *[F.count_if(F.col("b") == x).alias(f"b_{x}") for x in labels],
    )
    observed = F.col("agree") / F.col("n")
    expected = reduce(add, [F.col(f"a_{x}") * F.col(f"b_{x}") for x in labels]) / (F.col("n") * F.col("n"))
    kappa = F.when(expected == 1, F.lit(1.0)).otherwise((observed - expected) / (1 - expected))
    return seen.select("rater_a", "rater_b", F.col("n").alias("n_posts"), F.round(kappa, 6).alias("kappa"))


def fleiss_kappa(sheet, raters=K.RATERS, labels=K.LABELS):
    """Fleiss' kappa over the posts every rater labelled, as one row."""
    m = len(raters)
    normal = sheet.select(*[normalise_label(r, labels, unknown=None).alias(r) for r in raters])
    per_post = normal.select(*[_count_equal(raters, x).alias(f"n_{x}") for x in labels]).where(
        reduce(add, [F.col(f"n_{x}") for x in labels]) == m
    )
    squares = reduce(add, [F.col(f"n_{x}") * F.col(f"n_{x}") for x in labels])
    totals = per_post.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((squares - m) / F.lit(m * (m - 1))).alias("agreement"),
        *[F.sum(f"n_{x}").alias(f"t_{x}") for x in labels],
    )
    observed = F.col("agreement") / F.col("n")
    expected = reduce(add, [F.pow(F.col(f"t_{x}") / (F.col("n") * m), 2) for x in labels])
    kappa = F.when(expected == 1, F.lit(1.0)).otherwise((observed - expected) / (1 - expected))
    return totals.where(F.col("n") > 0).select(F.col("n").alias("n_posts"), F.round(kappa, 6).alias("kappa"))
