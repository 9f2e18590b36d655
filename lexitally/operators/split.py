"""Stratified splits and folds, exact in size and independent of partitioning."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally import constants as K


def _hashed(df, id_col, stratum, seed, digits):
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.where(F.col(stratum).isNotNull()).withColumn("_hash", h).withColumn("_range", F.substring("_hash", 1, digits))


def _offsets(keyed, stratum):
    """(stratum, _range, _n, _offset): rows of each range and of the ranges before it."""
    before = Window.partitionBy(stratum).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy(stratum, "_range").agg(F.count(F.lit(1)).alias("_n"))
    return sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def ranked_within(df, id_col, stratum, seed=K.SEED, digits=3):
    """Add `_rank`, the 1-based position of each row in its stratum by a seeded hash of the id.

    A window per stratum would sort a class that holds most of the table in one
    task. The first hex digits of the hash cut every stratum into 16**digits
    even ranges instead: ranges are numbered separately and shifted by the
    counts of the ranges before them, which gives the same rank. Those counts (at most
    16**digits rows a stratum) are broadcast: joined by stratum, a class would be one task.
    """
    keyed = _hashed(df, id_col, stratum, seed, digits)
    offsets = _offsets(keyed, stratum).drop("_n")
    inside = Window.partitionBy(stratum, "_range").orderBy("_hash", id_col)
    numbered = keyed.withColumn("_i", F.row_number().over(inside))
    located = numbered.join(F.broadcast(offsets), [stratum, "_range"])
    return located.withColumn("_rank", F.col("_offset") + F.col("_i")).drop("_hash", "_range", "_i", "_offset")


def test_quotas(df, stratum, test_size=K.TEST_SIZE):
    """Test rows per class: ceil(test_size * n) shared out by floor plus largest remainder."""
    sizes = df.where(F.col(stratum).isNotNull()).groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("n").over(everything)
    shared = sizes.withColumn("_want", F.ceil(total * F.lit(test_size))).withColumn("_all", total)
    shared = shared.withColumn("_floor", F.floor(F.col("n") * F.col("_want") / F.col("_all")))
    shared = shared.withColumn("_left", (F.col("n") * F.col("_want")) % F.col("_all"))
    place = F.row_number().over(everything.orderBy(F.desc("_left"), stratum))
    spare = F.col("_want") - F.sum("_floor").over(everything)
    return shared.select(
        stratum, "n", (F.col("_floor") + F.when(place <= spare, 1).otherwise(0)).cast("long").alias("quota")
    )


def _last_test_rows(keyed, id_col, stratum, quotas):
    """(stratum, _edge, _edge_id, _some, _all): hash and id of each class's last test row, and how many of the rows with both are test.

    Only the range that holds the row is numbered; keys and hashes are all that is shuffled.
    """
    place = F.col("_quota") - F.col("_offset")
    ranges = _offsets(keyed, stratum).join(F.broadcast(quotas), stratum).where(F.col("_range").isNotNull() & (place > 0) & (place <= F.col("_n")))
    inside = keyed.join(F.broadcast(ranges.select(stratum, "_range", place.alias("_take"))), [stratum, "_range"])
    order, same = Window.partitionBy(stratum, "_range").orderBy("_hash", id_col), Window.partitionBy(stratum, "_range", "_hash", id_col)
    numbered = inside.withColumn("_i", F.row_number().over(order)).withColumns({"_all": F.count(F.lit(1)).over(same), "_first": F.min("_i").over(same)})
    return numbered.where(F.col("_i") == F.col("_take")).select(
        stratum, F.col("_hash").alias("_edge"), F.col(id_col).alias("_edge_id"), (F.col("_take") - F.col("_first") + 1).alias("_some"), "_all"
    )


def _known(small):
    """A table of a row a class, made once, and its rows."""
    rows = small.collect()
    return small.sparkSession.createDataFrame(rows, small.schema), rows


def stratified_split(df, id_col, stratum, test_size=K.TEST_SIZE, seed=K.SEED, digits=3):
    """Add `split`: exactly the quota of every class is test, chosen by seeded hash. Rows without an id are left out.

    A row is test if it is not after its class's last test row in the order of hashes, so the rows
    themselves stay where they are; the last rows, one a class, are found first and broadcast.
    """
    others = [c for c in df.columns if c != stratum]
    quotas = _known(test_quotas(df, stratum, test_size).select(stratum, F.col("quota").alias("_quota")))[0]
    last = _last_test_rows(_hashed(df.select(id_col, stratum), id_col, stratum, seed, digits), id_col, stratum, quotas)
    edges, found = _known(last)
    placed = _hashed(df, id_col, stratum, seed, digits).where(F.col(id_col).isNotNull()).join(F.broadcast(quotas), stratum).join(F.broadcast(edges), stratum, "left")
    tied = F.coalesce((F.col("_hash") == F.col("_edge")) & (F.col(id_col) == F.col("_edge_id")), F.lit(False))
    before = F.coalesce((F.col("_hash") < F.col("_edge")) | ((F.col("_hash") == F.col("_edge")) & (F.col(id_col) < F.col("_edge_id"))), F.lit(False))

    def named(rows, test):
        return rows.select(stratum, *others, F.when(test, "test").otherwise("train").alias("split"))

    if all(row["_some"] == row["_all"] for row in found):
        return named(placed, before | tied)
    # An id comes more than once at the edge: so many of its rows are test as the quota has left.
    torn = tied & (F.col("_some") < F.col("_all"))
    edge = placed.where(torn).withColumn("_i", F.row_number().over(Window.partitionBy(stratum).orderBy("_hash")))
    return named(placed.where(~torn), before | tied).unionByName(named(edge, F.col("_i") <= F.col("_some")))


def stratified_folds(df, id_col, stratum, folds=K.FOLDS, seed=K.SEED):
    """Add `fold` 0..folds-1, even within every class."""
    return ranked_within(df, id_col, stratum, seed).withColumn("fold", (F.col("_rank") - 1) % folds).drop("_rank")


def split_feasibility(df, label, test_size=K.TEST_SIZE, enough=K.FEW_TEST_ROWS):
    """Test rows per class and whether the smallest class is too thin to judge."""
    quotas = test_quotas(df, label, test_size)
    smallest = F.min("quota").over(Window.partitionBy(F.lit(1)))
    return quotas.select(
        label, F.col("n").alias("records"), F.col("quota").alias("test_records"), (smallest < enough).alias("few_test_records")
    )
