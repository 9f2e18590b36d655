"""op10: main text of all pages."""

from pyspark.sql import functions as F

from lexitally.llm.html_consensus import extract
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


@query("op10_html_consensus")
def op10(spark, sf):
    return extract(read_table(spark, sf, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
