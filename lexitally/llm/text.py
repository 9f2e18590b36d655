"""Words as the operators see them: runs of anything but ASCII white space."""

from pyspark.sql import functions as F

#: White space between words, in Java's and DuckDB's notation.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def words(text):
    """Array of the words of a text column; null for a null text."""
    return F.array_remove(F.split(text, SPACE), "")


def lower_ascii(text):
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def only(rows, condition):
    """Rows that meet a condition on costly columns, computed once.

    Spark moves a filter below the projection that computes its columns, and writes
    their expressions out in it again for every use. It leaves a filter above a
    column like the row number, which it must not compute twice.
    """
    return rows.withColumn("_place", F.monotonically_increasing_id()).where(condition & (F.col("_place") >= 0)).drop("_place")


def word_bytes(text):
    """The same words of a Python string, lower-cased (A-Z only), as bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split()
