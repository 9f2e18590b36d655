"""Quality classifier by importance resampling.

Two generative models of hashed n-grams, one of target text (labelled good) and
one of all raw text, give every document the log ratio of its probabilities;
Gumbel noise is added and the k highest stay, which draws k documents without
replacement in proportion to their weights.

Counts are made of whole texts of all rows: a task adds up its own vector of
`BUCKETS` counts and only sums leave it, so the driver receives one vector of fixed
length and no n-gram is shuffled. Scoring is a projection. The k-th key is found by
counting rows in ever narrower ranges (a few rows to the driver), so neither a sort
nor a task holds all rows.

Three choices keep clean text in. The target model is smoothed towards the raw one
(`PRIOR` counts a bucket). A bucket counts only if the two models differ there by
more than chance and a factor (`EVIDENCE` standard deviations, `FACTOR` in log units
from the median ratio of target text); else words that are merely rare decide. The
sum is divided by the root of the number of n-grams, else length decides, and
multiplied by `SHARPNESS`, so that the noise only decides close cases.

The models see all rows; labels are a bounded sample of `labelled` rows (those with
the smallest hashes), three quarters to fit the target and a quarter to set k: k is
the number of all rows whose weight reaches the cut that best parts good from bad
labelled rows, or a lower one that keeps 99 % of the good.

Defined results: a null or empty text has no n-grams and weight 0; without good
labelled rows all weights are 0 and every row stays; rows that tie with the k-th
stay too; repeated rows draw the same noise; an empty table gives no rows.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from lexitally.session import stage_folder

BUCKETS = 1 << 18
PRIOR = 5.0
EVIDENCE = 5.0
FACTOR = 0.7
SHARPNESS = 20.0
RANGES = 4096
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"


def hashed_ngrams(text, buckets=BUCKETS):
    """Array column: buckets of the words and punctuation runs of a text, and of neighbouring pairs of them."""
    bucket = lambda *parts: F.xxhash64(*parts).bitwiseAND(F.lit(buckets - 1)).cast("int")
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    singles = lambda t: F.transform(t, lambda a: bucket(a))
    pairs = lambda t: F.zip_with(F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))), F.slice(t, 2, F.size(t)), lambda a, b: bucket(a, b))
    return F.get(F.transform(F.array(tokens), lambda t: F.concat(singles(t), pairs(t))), F.lit(0))


def _labelled(labels, most, id_col, good):
    """(id, good, fit): a bounded sample of labelled rows; `fit` for the model, the rest for the cut."""
    once = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
    draw = F.xxhash64("_id", F.lit("labelled"))
    return once.orderBy(draw, "_id").limit(most).select("_id", "good", (F.pmod(draw, F.lit(4)) > 0).alias("fit"))


def bucket_counts(rows, buckets=BUCKETS):
    """Two vectors: n-grams a bucket in all rows, and in those marked `_target`. rows: (_ngrams, _target)."""

    def added(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            grams = batch.column(0)
            sizes = np.diff(grams.offsets.to_numpy())
            flat = grams.flatten().to_numpy()
            raw += np.bincount(flat, minlength=buckets)
            good = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)
            target += np.bincount(flat[good], minlength=buckets)
        seen = np.nonzero(raw)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "n", "t"])

    parts = rows.select("_ngrams", "_target").mapInArrow(added, "bucket int, n long, t long")
    summed = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    at = summed["bucket"].to_numpy()
    raw[at], target[at] = summed["n"].to_numpy(), summed["t"].to_numpy()
    return raw, target


def log_ratios(raw, target):
    """Log ratio of the target model to the raw one, a bucket each."""
    if not target.sum():
        return np.zeros(len(raw))
    expected = raw * (target.sum() / raw.sum())
    ratio = np.log((target + PRIOR) / (expected + PRIOR))
    order = np.argsort(ratio, kind="stable")
    mass = np.cumsum(target[order])
    ratio = ratio - ratio[order[np.searchsorted(mass, mass[-1] / 2)]]
    evident = np.abs(target - expected) > EVIDENCE * np.sqrt(expected + 1)
    return np.where(evident & (np.abs(ratio) > FACTOR), ratio, 0.0)


def _weigher(spark, ratios):
    shared = spark.sparkContext.broadcast(ratios)

    @F.pandas_udf("double")
    def weight(ngrams: pd.Series) -> pd.Series:
        ratio = shared.value
        return pd.Series([SHARPNESS * ratio[g].sum() / np.sqrt(len(g)) if len(g) else 0.0 for g in ngrams], dtype="float64")

    return weight


def _cut(scores):
    """The weight that best parts good from bad labelled rows, lowered until 99 % of the good reach it."""
    good = np.sort(scores.loc[scores["good"], "log_weight"].to_numpy())
    bad = np.sort(scores.loc[~scores["good"], "log_weight"].to_numpy())
    if not len(good):
        return -np.inf
    low = good[int(0.01 * len(good))]
    if not len(bad):
        return low
    tried = np.unique(np.concatenate([good, bad]))
    gain = np.searchsorted(bad, tried) / len(bad) - np.searchsorted(good, tried) / len(good)
    return min(low, tried[np.argmax(gain)])


def weighted(docs, labels, good, id_col="doc_id", text="text", labelled=20_000):
    """(rows with `log_weight`, cut). rows: `row` (the input's columns), `_good`, `_fit`.

    `good` is a condition on the rows of `labels` (`id_col` and whatever it needs).
    """
    spark = docs.sparkSession
    sample = _labelled(labels, labelled, id_col, good)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("_doc"), hashed_ngrams(F.col(f"`{text}`")).alias("_ngrams")
    )
    marked = rows.join(F.broadcast(sample), F.col("_doc") == F.col("_id"), "left")  # at most `labelled` ids and flags
    raw, target = bucket_counts(marked.select("_ngrams", F.coalesce(F.col("good") & F.col("fit"), F.lit(False)).alias("_target")))
    weight = _weigher(spark, log_ratios(raw, target))
    scored = marked.select("row", "good", "fit", F.size("_ngrams").cast("long").alias("n_ngrams"), weight("_ngrams").alias("log_weight"))
    known = scored.where(F.col("good").isNotNull() & ~F.col("fit")).select("good", "log_weight").toArrow().to_pandas()  # at most `labelled` rows
    return scored.select("row", "n_ngrams", "log_weight"), _cut(known)


def kth_largest(rows, key, k):
    """The k-th largest value of a long column, by counting rows in ever narrower ranges; None if there are fewer."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None or k <= 0:
        return None
    while low < high:
        width = (high - low) // RANGES + 1
        place = F.floor((F.col(key) - low) / width)
        counts = rows.where(F.col(key).between(low, high)).groupBy(place.alias("place")).count().collect()  # at most RANGES rows
        for place, n in sorted(counts, reverse=True):
            if n >= k:
                low, high = low + place * width, min(high, low + (place + 1) * width - 1)
                break
            k -= n
        else:
            return None
    return low


def resample(docs, labels, good, keep=(), id_col="doc_id", text="text", seed="resample", **options):
    """Every row with `n_ngrams`, `log_weight`, `draw` (weight plus noise, in 1e-9) and `kept`.

    `keep`: the input's columns to carry; all by default. Weights and draws alone are
    written to the shared folder, to find the k-th; they are computed again, and come
    out the same, when the result is read.
    """
    scored, cut = weighted(docs, labels, good, id_col, text, **options)
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(f"row.`{id_col}`"), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    noise = -F.log(-F.log(uniform))
    columns = [F.col(f"row.`{c}`").alias(c) for c in keep or docs.columns]
    out = scored.select(F.struct(*columns).alias("row"), "n_ngrams", "log_weight", F.floor((F.col("log_weight") + noise) * 1e9).alias("draw"))
    with stage_folder(docs.sparkSession, "draws") as write:
        draws = write(out.select("log_weight", "draw"), "draws")
        limit = kth_largest(draws, "draw", draws.where(F.col("log_weight") >= F.lit(float(cut))).count())
    return out.withColumn("kept", F.col("draw") >= limit if limit is not None else F.lit(False))
