"""op11: bytes that repeat in strings of 200 are removed from all documents."""

from pyspark.sql import functions as F

from lexitally.llm.registry import query
from lexitally.llm.suffix_repeats import remove_repeats
from lexitally.sources.io import read_table


@query("op11_suffix_repeats")
def op11(spark, sf):
    found = remove_repeats(read_table(spark, sf, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
