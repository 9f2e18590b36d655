"""Running totals over a whole table without a whole-table window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

def running_total(df, order, amount, name, ranges=None):
    """Add the total of `amount` over all rows before this one in a unique numeric order.

    Approximate quantiles of the order column cut the table into ranges; each
    range is summed on its own and shifted by the totals of the ranges before
    it. The cut points (at most `ranges`, held on the driver) only balance the
    work: totals are exact wherever they fall. By default there are as many ranges
    as shuffle partitions.
    """
    ranges = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    points = [i / ranges for i in range(1, ranges)]
    cuts = df.select(F.percentile_approx(order, points, 10_000)).first()[0]
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast(f"array<{dict(df.dtypes)[order]}>")
    ranged = df.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col(order))))
    earlier = Window.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum(amount).alias("_amount"))  # one row per range
        .select("_range", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_offset"))
    )
    before = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(amount).over(before), F.lit(0))
    summed = ranged.withColumn("_inside", inside).join(offsets, "_range")
    return summed.withColumn(name, F.col("_offset") + F.col("_inside")).drop("_range", "_offset", "_inside")
