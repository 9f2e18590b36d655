"""op7: harmonic packing of all documents."""

import public_tokenizers
from pyspark.sql import functions as F

from lexitally.llm.packing import pack
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


def packed(docs):
    """Pieces with the checksum of their ids."""
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op7_harmonic_packing")
def op7(spark, sf):
    return packed(read_table(spark, sf, "documents"))
