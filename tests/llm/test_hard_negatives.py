import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexitally.llm.hard_negatives import Packed, hard_negatives


def plain(rows, every, positives, negatives):
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i, label, tuple(math.floor(256 * np.float64(x)) for x in v)] = None
    out = set()
    for i, label, v in usable:
        if i % every == 0:
            scored = sorted({(-sum(a * b for a, b in zip(v, w)), j, other == label) for j, other, w in usable if j != i and len(w) == len(v)})
            for s, p, same in [x for x in scored if x[2]][:positives]:
                fit = [(t, j) for t, j, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s][:negatives]
                out |= {(i, p, n + 1, j, -s, -t) for n, (t, j) in enumerate(fit)}
    return sorted(out)


@pytest.mark.parametrize("width, size", [(4, 300), (8, 10**6), (16, 10**9)])
def test_packed_scores_are_exact(width, size):
    rng = np.random.default_rng(1)
    vectors, anchor = rng.integers(-size, size, (50, 7)), rng.integers(-size, size // 2, 7)
    packed = Packed(vectors, size)
    assert packed.width == width
    assert packed.scores(anchor.tolist(), size).tolist() == [sum(int(a) * int(b) for a, b in zip(anchor, v)) for v in vectors]


def test_a_score_beyond_64_bits_fails():
    with pytest.raises(OverflowError):
        Packed(np.full((2, 2), 2**40), 2**40)


@pytest.mark.parametrize("block", [65_536, 20])
def test_matches_brute_force(spark, block):
    rng = np.random.default_rng(5)
    hot = (1 + rng.random(6)).tolist()
    # A third of all rows are copies, a third of all rows have one label, many scores tie.
    rows = [(i, hot if i % 3 == 0 else (rng.random(6) + rng.integers(0, 2)).round(1).tolist(), 0 if i % 3 == 1 else int(rng.integers(0, 4))) for i in range(240)]
    rows += [(240, None, 1), (250, [1.0, None] + [0.0] * 4, 1), (260, hot, None), (270, [float("nan")] * 6, 0), (280, [float("inf")] + [0.0] * 5, 0), (None, hot, 1),
             (290, [1.0, 2.0], 1), (291, [0.5, 2.0], 1), (292, [0.5, 1.9], 2), (300, [], 1), (301, [], 2), rows[10], rows[10], (310, [-1.0] * 6, 9), (311, [1.0] * 6, 9), (312, [0.9] * 6, 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    vectors = vectors.withColumns({c: F.lit("x") for c in ("id", "q", "v", "dim", "rank")})
    found = hard_negatives(vectors, F.col("id") % 10 == 0, block_rows=block, block_anchors=block)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, found.collect()))
    assert got == plain(rows, 10, 5, 5) and len(got) > 100


def test_empty_table(spark):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives(vectors, F.col("id") % 10 == 0).count() == 0
