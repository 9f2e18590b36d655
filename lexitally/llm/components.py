"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from pyspark.sql import functions as F

from lexitally.session import delete_path, scratch_path


def connected_components(edges, name="components"):
    """(node, component): the smallest node reachable, for every node of an edge (u, v).

    Each step replaces a node's edges by edges to its smallest neighbour: partial
    minima, then a join, so a node with very many edges is never in one task. The
    table of a step is written to the shared folder and the one before deleted.
    """
    spark = edges.sparkSession

    def written(frame):
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path), path

    def star(pairs, keep):
        """pairs (u, v): every kept neighbour v of u, and u itself, to the smallest of them."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return (
            pairs.where(keep).join(least.select("u", F.least("u", "m").alias("m")), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        ), least

    current, path = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = star(both, F.col("v") > F.col("u"))
        large = large.where("u <> v").distinct()
        small, least = star(large, F.lit(True))
        hooked = small.unionByName(least.select("u", F.col("m").alias("v")))
        following, following_path = written(hooked.where("u <> v").distinct())
        delete_path(spark, path)
        current, path = following, following_path
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            roots = current.select(F.col("v").alias("node")).distinct()
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )
        before = state
