import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexitally.llm.vafile import top_k


def plain(rows, k, every):
    usable = []
    for i, v in dict.fromkeys((i, tuple(v) if v is not None else None) for i, v in rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(1024 * np.float64(x)) for x in v]))
    out = []
    for q, v in usable:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(4096, 1024), (16, 4)])
def test_matches_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=8).round(1).tolist()) for i in range(150)]
    rows += [(150, None), (160, [1.0, None] + [0.0] * 6), (170, [float("nan")] * 8), (180, [float("inf")] + [0.0] * 7), (190, [1.0, 2.0]), (191, [0.5, -2.0]),
             (200, []), (201, []), (10, rows[10][1]), (210, [0.0] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("v", F.lit(1)).withColumn("c", F.lit(1))
    found = top_k(vectors, F.col("vec_id") % 10 == 0, k=5, block_rows=blocks[0], block_queries=blocks[1], first=1)
    assert sorted(map(tuple, found.collect())) == plain(rows, 5, 10)


def test_empty_table(spark):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(vectors, F.col("vec_id") % 10 == 0).count() == 0
