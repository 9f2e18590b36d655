"""Training-data operators: search, scans, tokenising, filtering, de-duplication, scoring, packing, extraction.

Nothing else in the library imports this subpackage.
"""
