"""Rounding."""

from pyspark.sql import functions as F


def settled(value, digits):
    """Round half up, after dropping the noise summation order leaves in the last bits.

    Scores are sums and means of short decimals, so exact halves are common;
    without the first step they would fall either way from run to run.
    """
    return F.round(F.round(value, 9), digits)
