"""op8: near-duplicate groups of all documents."""

from lexitally.llm.near_duplicates import near_duplicates
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


@query("op8_minhash_near_duplicates")
def op8(spark, sf):
    return near_duplicates(read_table(spark, sf, "documents"))
