"""Exact top-k inner-product search over a vector-approximation file.

1. Components become integers, floor(scale * x). Equal vectors form a class with
   one vector and its k + 1 smallest ids: no other copy can be among k results.
2. The approximation file holds one byte per component: the number of the cell,
   out of 256 equal cells between the component's extremes over all vectors.
3. Scan: every block of queries meets every block of approximations in a task of
   its own. A cell bounds the score from both sides. A task keeps the vectors whose
   upper bound reaches its (k+1)-th best lower bound, so what leaves a task is
   bounded by what can still win, not by pairs.
4. Refine: the kept ones of all blocks are put in order of their bounds. The first
   few exact vectors of every query are read; their (k+1)-th best exact score then
   is a certain limit, and exactly those whose bound still reaches it are read too.
   (k + 1, because the query's own vector is among them.)

Work grows with queries x rows, as in any exact search; memory does not: blocks
have fixed sizes, and nothing is broadcast but the extremes, two numbers for each
component. Blocks are dealt by hash, and classes leave no key with many rows.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part, neither as query nor as candidate; vectors of different lengths are
never compared; rows that repeat id and vector count once; ties go to the smaller
id; fewer than k candidates give fewer rows; an empty table gives no rows. A score
that does not fit 64 bits fails the job rather than being wrong.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally.session import stored

CELLS = 256


def digitised(vectors, id_col, vec_col, scale):
    """(id, v): rows that take part, with integer components."""
    x = F.col(f"`{vec_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    return vectors.where(x.isNotNull() & finite).select(F.col(f"`{id_col}`").alias("id"), whole.alias("v"))


def vector_classes(rows, copies):
    """(c, dim, v, ids): distinct vectors with the `copies` smallest of their ids."""
    order = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= copies)
    grouped = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return grouped.select(F.monotonically_increasing_id().alias("c"), F.size("v").alias("dim"), "v", "ids")


def cell_grid(classes):
    """Per vector length: lower edges and widths of the cells of every component."""
    parts = classes.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    grid = {}
    for dim, group in parts.toArrow().to_pandas().sort_values("at").groupby("dim"):
        low = group["low"].to_numpy(np.float64)
        grid[int(dim)] = low, np.floor((group["high"].to_numpy(np.float64) - low) / CELLS) + 1
    return grid


def approximations(classes, grid):
    """The approximation file: (c, dim, cells), one byte per component."""

    def cells(frames):
        for frame in frames:
            out = []
            for dim, v in zip(frame["dim"], frame["v"]):
                low, width = grid.get(dim, (np.zeros(0), np.ones(0)))
                out.append(np.minimum((np.asarray(v, np.float64) - low) // width, CELLS - 1).astype(np.uint8).tobytes())
            yield pd.DataFrame({"c": frame["c"], "dim": frame["dim"], "cells": out})

    return classes.select("c", "dim", "v").mapInPandas(cells, "c long, dim int, cells binary")


def _scan(grid, best, step=128):
    """Bounds of one block of queries against one block of approximations."""

    def bounded(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"q": pd.Series(dtype="int64"), "c": pd.Series(dtype="int64"), "low": pd.Series(dtype="float64"), "high": pd.Series(dtype="float64")})
        if queries.empty or block.empty:
            return none
        dim = int(block["dim"].iloc[0])
        low, width = grid.get(dim, (np.zeros(0), np.ones(0)))
        cells = np.frombuffer(b"".join(block["cells"]), np.uint8).reshape(len(block), dim)
        corner = low + cells * width
        vectors = np.array(queries["v"].tolist(), np.float64).reshape(len(queries), dim)
        span = width - 1
        most = np.abs(low) + CELLS * width
        ids, keys, out = block["c"].to_numpy(), queries["q"].to_numpy(), [none]
        for at in range(0, len(vectors), step):
            some = vectors[at : at + step]
            slack = np.abs(some) @ most * 2.0**-45  # rounding of products beyond 2^53
            base = some @ corner.T
            lows = base + (np.minimum(some, 0) @ span - slack)[:, None]
            highs = base + (np.maximum(some, 0) @ span + slack)[:, None]
            if len(ids) > best:
                limit = np.partition(lows, -best, axis=1)[:, -best]
            else:
                limit = np.full(len(some), -np.inf)
            q, c = np.nonzero(highs >= limit[:, None])
            out.append(pd.DataFrame({"q": keys[at + q], "c": ids[c], "low": lows[q, c], "high": highs[q, c]}))
        return pd.concat(out, ignore_index=True)

    return bounded


def _dealt(key, blocks):
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _exact(pairs, classes, queries):
    """Pairs (q, c) with the exact score."""
    both = pairs.join(classes.select("c", F.col("v").alias("_x")), "c").join(queries.select("q", F.col("v").alias("_y")), "q")
    product = F.zip_with("_x", "_y", lambda a, b: a * b)
    return both.select("q", "c", F.aggregate(product, F.lit(0).cast("long"), lambda s, x: s + x).alias("score"))


def top_k(vectors, is_query, k=10, id_col="vec_id", vec_col="embedding", scale=1024, block_rows=4096, block_queries=1024, first=4):
    """The k highest integer inner products of every query row: query_id, rank, id, score.

    `is_query` is a condition on the rows; candidates are all rows but the query's
    own id. `first`: in units of k + 1, how many exact vectors are read at first.
    """
    best = k + 1
    rows = digitised(vectors, id_col, vec_col, scale)
    classes = stored(vector_classes(rows, best), "vector-classes")
    asked = digitised(vectors.where(is_query), id_col, vec_col, scale).distinct()
    queries = stored(asked.select(F.monotonically_increasing_id().alias("q"), "id", F.size("v").alias("dim"), "v"), "vector-queries")
    grid = cell_grid(classes)
    file = approximations(classes, grid)
    row_blocks = max(1, -(-classes.count() // block_rows))
    query_blocks = max(1, -(-queries.count() // block_queries))
    left = (
        queries.select("q", "dim", "v", _dealt("q", query_blocks).alias("_qb"))
        .withColumn("_rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    )
    right = (
        file.select("c", "dim", "cells", _dealt("c", row_blocks).alias("_rb"))
        .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    scanned = (
        left.groupBy("dim", "_qb", "_rb").cogroup(right.groupBy("dim", "_qb", "_rb"))
        .applyInPandas(_scan(grid, best), "q long, c long, low double, high double")
    )
    scanned = stored(scanned, "vector-bounds")
    by_low = Window.partitionBy("q").orderBy(F.desc("low"))
    lows = scanned.withColumn("_n", F.row_number().over(by_low)).where(F.col("_n") <= best)
    limits = lows.groupBy("q").agg(F.when(F.count("*") == best, F.min("low")).alias("limit"))
    able = scanned.join(limits, "q").where(F.col("limit").isNull() | (F.col("high") >= F.col("limit")))
    by_high = Window.partitionBy("q").orderBy(F.desc("high"), "c")
    ordered = stored(able.select("q", "c", "high", F.row_number().over(by_high).alias("place")), "vector-candidates")
    early = stored(_exact(ordered.where(F.col("place") <= first * best).select("q", "c"), classes, queries), "vector-scores")
    by_score = Window.partitionBy("q").orderBy(F.desc("score"))
    certain = (
        early.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= best)
        .groupBy("q").agg(F.when(F.count("*") == best, F.min("score")).alias("sure"))
    )
    late = (
        ordered.where(F.col("place") > first * best).join(certain, "q")
        .where(F.col("sure").isNull() | (F.col("high") >= F.col("sure"))).select("q", "c")
    )
    scored = early.unionByName(_exact(late, classes, queries))
    named = (
        scored.join(classes.select("c", F.explode("ids").alias("id")), "c")
        .join(queries.select("q", F.col("id").alias("query_id")), "q").where(F.col("id") != F.col("query_id"))
    )
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return named.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
