"""op4: importance resampling of all documents towards the good labelled ones."""

from pyspark.sql import functions as F

from lexitally.llm.registry import query
from lexitally.llm.resampling import resample
from lexitally.sources.io import read_table


def good():
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


@query("op4_importance_resampling")
def op4(spark, sf):
    drawn = resample(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"), good(), keep=["doc_id"])
    return drawn.select("row.doc_id", "n_ngrams", F.round("log_weight", 6).alias("log_weight"), "draw", "kept")
