"""Helpers of the operator tests."""

import pytest
from pyspark.sql import functions as F

ODD = [
    None, "", " ", "\n", "a", "a b c d", "the same words again and again the same words again and again",
    "x" * 5000, "é ñ ü " * 50, "word " * 3000, "\t\x0b tab\r\nline ", "日本語 テキスト 😀", "#### %% && <b>|</b>",
]


@pytest.fixture
def odd(spark):
    """Documents with null, empty, very long, repeated rows, and columns with clashing names."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "\n"), (None, "no id here at all"), (20, ODD[6]), (21, ODD[6])]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(7).cast("long") for c in ("kept", "row", "words", "n_words", "key", "id", "_w", "_text", "sequence_id", "start")}
    ).withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})


@pytest.fixture
def empty(odd):
    return odd.limit(0)
