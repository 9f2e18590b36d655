"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as
Parquet to the shared folder and reads it again as the next one's docs. All but the
last return the columns of documents.
"""

from pyspark.sql import functions as F

from lexitally.llm import line_chunks, near_duplicates, quality_rules, resampling
from lexitally.llm.packing_query import packed
from lexitally.llm.resampling_query import good
from lexitally.llm.text import only
from lexitally.session import stored
from lexitally.sources.io import read_table


def keep_well_formed(spark, docs, sf_dir):
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def keep_drawn(spark, docs, sf_dir):
    """Documents drawn by their importance weight towards the good labelled ones."""
    return only(resampling.resample(docs, read_table(spark, sf_dir, "labels"), good()), F.col("kept")).select("row.*")


def drop_repeated_lines(spark, docs, sf_dir):
    """Documents without line chunks and passages that an earlier document has; n_chars follows the text. No document goes."""
    cleaned = line_chunks.drop_repeated_lines(docs, passages=True)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return cleaned.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_duplicates.drop_near_duplicates(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packed(docs)


STAGES = [
    ("quality_rules", keep_well_formed),
    ("quality_classifier", keep_drawn),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # hashes, models and token ids have no SQL form; tests hold it against plain Python


def run(spark, sf_dir):
    """All stages over all documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
