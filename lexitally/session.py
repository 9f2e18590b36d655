"""Session and shared-folder helpers."""

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master="local[8]", app="lexitally", **conf):
    """A session with the settings the jobs rely on: AQE with skew-join splitting and UTC."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """The shared folder for stage tables: spark.checkpoint.dir, else Spark's warehouse folder.

    Both are folders that the driver and all executors reach; nothing is written
    to a machine-local place.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def scratch_path(spark, name):
    """A fresh path for a written table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Materialise `df` through a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df, name):
    """Write `df` once as a table in the shared folder and read it back.

    For a stage that several later jobs read: columnar, prunable, with sizes
    the optimizer can see, and safe from the loss of an executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df):
    """Deal the rows of a small table over all cores.

    A file with one row group is read by one task, however many cores there are. Only
    tables that could not give every core a split are shuffled: fewer files than
    cores, and less than a split for each. Larger ones stay as they are.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * split and len(df.inputFiles()) < cores else df


def delete_path(spark, path):
    """Delete a stage table that no later job reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def stage_folder(spark, name):
    """`stored` into a fresh sub-folder of the shared folder that is deleted at the end of the block."""
    path = scratch_path(spark, name)

    def stored_here(df, table):
        df.write.parquet(f"{path}/{table}")
        return spark.read.parquet(f"{path}/{table}")

    try:
        yield stored_here
    finally:
        delete_path(spark, path)
