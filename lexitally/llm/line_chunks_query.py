"""op5: repeated line chunks and passages removed from all documents."""

from lexitally.llm.line_chunks import drop_repeated_lines
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


@query("op5_line_chunks")
def op5(spark, sf):
    return drop_repeated_lines(read_table(spark, sf, "documents"), keep=["doc_id"], passages=True).select("row.doc_id", "text", "n_lines", "n_removed")
