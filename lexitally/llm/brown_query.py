"""op6: class-based language-model scores of all documents."""

from pyspark.sql import functions as F

from lexitally.llm.brown import score_documents
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


@query("op6_brown_class_lm")
def op6(spark, sf):
    train = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    scored = score_documents(read_table(spark, sf, "documents"), train)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
