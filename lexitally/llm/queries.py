"""The training-data operators as named queries over the given tables, with SQL where it can express them."""

from lexitally.llm import (  # noqa: F401  (they fill the registry)
    brown_query,
    hard_negatives_query,
    html_consensus_query,
    licenses_query,
    line_chunks_query,
    near_duplicates_query,
    packing_query,
    pieces_query,
    prefix_trie_query,
    quality_rules_query,
    resampling_query,
    suffix_repeats_query,
    vafile_query,
)
from lexitally.llm.registry import ORACLE, QUERIES  # noqa: F401
