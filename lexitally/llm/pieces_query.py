"""op3: SentencePiece ids of all documents and their round trip."""

import public_tokenizers
from pyspark.sql import functions as F

from lexitally.llm.pieces import encode_documents
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


@query("op3_sentencepiece")
def op3(spark, sf):
    docs = encode_documents(read_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_bytes"),
    )
