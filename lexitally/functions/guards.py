"""Scalar totals."""

from pyspark.sql import functions as F


def row_count(df):
    """Number of rows as a scalar subquery."""
    return df.select(F.count(F.lit(1))).scalar()
