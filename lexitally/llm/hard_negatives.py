"""Hard negatives by Kronecker-packed inner products.

Components become integers, floor(scale * x). The candidates of a block are packed:
their j-th components, biased to be no less than zero, lie side by side in separate
fields of one wide integer. An anchor multiplies each of these integers once with its
own biased component and adds the products up; every field then holds one candidate's
biased inner product, exactly, since fields are as wide as the largest sum needs. They
are unpacked and the biases taken off again. There is no rounding at any size.

1. Every block of anchors meets every block of rows in a task of its own. It keeps,
   per anchor, the best `positives` rows of the anchor's label; the best of all
   blocks are the anchor's positives.
2. The same blocks meet again, with the positives' scores. A task keeps, for each
   positive, the best `negatives` rows of other labels whose score is from `low` to
   `high` per cent of the positive's; the best of all blocks are its hard negatives.

What leaves a task is bounded by anchors x results, not by pairs, so no score but
these is ever a row. Rows are dealt by a hash of the whole row: a label, an id or a
group of copies that holds a third of all rows is spread over all blocks. Blocks have a
bounded size (`block_rows`, `block_anchors`); work grows with anchors x rows, as in any
exact search. Nothing is broadcast.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; rows that repeat id, label and vector count once; a row's own
id is never among its results; vectors of different lengths are never compared; ties
go to the smaller id; fewer rows give fewer results; an anchor without positives, or a
positive without rows in its range, gives no rows; an empty table gives no rows. A
score that does not fit 64 bits fails the job rather than being wrong.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally.session import stage_folder, stored

FIELDS = 4096


class Packed:
    """The vectors of several candidates, packed into one wide integer per component."""

    def __init__(self, vectors, largest):
        """`largest`: no anchor component is larger in size."""
        self.n, self.dim = vectors.shape
        self.low = int(vectors.min(initial=0))
        self.sums = vectors.sum(axis=1)
        biased = vectors - self.low
        if self.dim * max(int(vectors.max(initial=0)), -self.low) * largest >= 2**63:
            raise OverflowError("scores do not fit 64 bits")
        bits = (self.dim * int(biased.max(initial=0)) * 2 * largest).bit_length()
        self.width = next(w for w in (4, 8, 16) if bits <= 8 * w)
        fields = np.zeros((self.dim, self.n, max(1, self.width // 8)), np.uint64 if self.width >= 8 else np.uint32)
        fields[:, :, 0] = biased.T
        self.wide = [int.from_bytes(f.tobytes(), "little") for f in fields]

    def scores(self, anchor, bias):
        """Inner products with an anchor (a list of integers), none of which is below -`bias`."""
        total = sum((a + bias) * x for a, x in zip(anchor, self.wide))
        raw = np.frombuffer(total.to_bytes(self.n * self.width, "little"), np.uint32 if self.width == 4 else np.uint64)
        fields = raw[:: max(1, self.width // 8)].astype(np.uint64).view(np.int64)  # modulo 2^64; the score itself fits
        constant = self.low * (sum(anchor) + self.dim * bias)
        return fields - bias * self.sums + np.int64((constant + 2**63) % 2**64 - 2**63)


def usable(vectors, id_col, vec_col, label_col, scale):
    """(id, label, dim, v): distinct rows that take part, with integer components."""
    x = F.col(f"`{vec_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    rows = vectors.where(x.isNotNull() & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & finite)
    return rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.size(x).alias("dim"), whole.alias("v")).distinct()


def _best(scores, at, k):
    """Places of the k highest scores among the places `at`, which are in the order of ties."""
    if len(at) > k:
        some = scores[at]
        at = at[some >= np.partition(some, -k)[-k]]
    return at[np.argsort(-scores[at], kind="stable")][:k]


def _slices(anchors, block):
    """Per slice of a block: its ids, labels and packed vectors; and the anchors as lists of integers with their bias."""
    dim = int(block["dim"].iloc[0])
    block = block.sort_values("id", kind="stable")
    asked = np.array(anchors["v"].tolist(), np.int64).reshape(len(anchors), dim)
    largest = int(np.abs(asked).max(initial=0))
    for at in range(0, len(block), FIELDS):
        part = block.iloc[at : at + FIELDS]
        vectors = np.array(part["v"].tolist(), np.int64).reshape(len(part), dim)
        yield part["id"].to_numpy(), part["label"].to_numpy(), Packed(vectors, largest), asked.tolist(), largest


def _positives(k, types):
    def found(anchors, block):
        out = {name: [] for name in ("q", "positive_id", "positive_score")}
        if len(anchors) and len(block):
            for ids, labels, packed, asked, bias in _slices(anchors, block):
                places = {label: np.flatnonzero(labels == label) for label in set(labels.tolist())}
                for q, own, label, anchor in zip(anchors["q"], anchors["id"], anchors["label"], asked):
                    at = places.get(label)
                    if at is not None:
                        at = at[ids[at] != own]
                        scores = packed.scores(anchor, bias)
                        at = _best(scores, at, k)
                        out["q"] += [q] * len(at)
                        out["positive_id"] += ids[at].tolist()
                        out["positive_score"] += scores[at].tolist()
        return pd.DataFrame(out).astype(types)

    return found


def _negatives(k, low, high, types):
    def found(anchors, block):
        out = {name: [] for name in ("q", "positive_id", "positive_score", "negative_id", "negative_score")}
        if len(anchors) and len(block):
            for ids, labels, packed, asked, bias in _slices(anchors, block):
                for q, own, label, good, anchor in zip(anchors["q"], anchors["id"], anchors["label"], anchors["good"], asked):
                    scores = packed.scores(anchor, bias)
                    other = (labels != label) & (ids != own)
                    for pair in good:
                        p = int(pair["positive_score"])
                        at = np.flatnonzero((scores >= -(-low * p // 100)) & (scores <= high * p // 100) & other)
                        at = _best(scores, at, k)
                        out["q"] += [q] * len(at)
                        out["positive_id"] += [pair["positive_id"]] * len(at)
                        out["positive_score"] += [p] * len(at)
                        out["negative_id"] += ids[at].tolist()
                        out["negative_score"] += scores[at].tolist()
        return pd.DataFrame(out).astype(types)

    return found


def hard_negatives(vectors, is_anchor, positives=5, negatives=5, low=80, high=100, scale=256,
                   id_col="vec_id", vec_col="embedding", label_col="label", block_rows=65_536, block_anchors=4_096):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor's positives.

    `is_anchor` is a condition on a column `id`. A result is a stored table.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[id_col]
    key = "str" if kind == "string" else "int64"
    with stage_folder(spark, "hard-negatives") as write:
        rows = write(usable(vectors, id_col, vec_col, label_col, scale), "rows")
        anchors = write(rows.where(is_anchor).select(F.monotonically_increasing_id().alias("q"), "*"), "anchors")
        n = rows.count()
        row_blocks = max(1, -(-n // block_rows), min(spark.sparkContext.defaultParallelism, n // 1024))
        anchor_blocks = max(1, -(-anchors.count() // block_anchors))

        def dealt(frame, blocks, name, others, other_name):
            block = F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)).cast("int")
            return frame.withColumn(name, block).withColumn(other_name, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).groupBy("dim", "_qb", "_rb")

        def met(asked, task, schema):
            right = dealt(rows, row_blocks, "_rb", anchor_blocks, "_qb")
            return dealt(asked, anchor_blocks, "_qb", row_blocks, "_rb").cogroup(right).applyInPandas(task, schema)

        types = {"q": "int64", "positive_id": key, "positive_score": "int64"}
        near = met(anchors, _positives(positives, types), f"q long, positive_id {kind}, positive_score long")
        order = Window.partitionBy("q").orderBy(F.desc("positive_score"), "positive_id")
        near = near.distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= positives)
        good = write(near.groupBy("q").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("good")), "positives")
        types = types | {"negative_id": key, "negative_score": "int64"}
        hard = met(
            anchors.join(good, "q"), _negatives(negatives, low, high, types),
            f"q long, positive_id {kind}, positive_score long, negative_id {kind}, negative_score long",
        )
        order = Window.partitionBy("q", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
        hard = hard.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        return stored(
            hard.join(anchors.select("q", F.col("id").alias("anchor_id")), "q")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
            "hard-negatives",
        )
