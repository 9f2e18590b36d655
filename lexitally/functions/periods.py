"""Timestamps and calendar periods (UTC)."""

from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.labels import display_name


def utc_timestamp(c):
    """Parse to a timestamp, null where the text is no date."""
    return F.try_to_timestamp(F.col(c).cast("string"))


def with_periods(df, ts="created_at"):
    """Drop rows without a usable timestamp; add month, quarter start and quarter name."""
    dated = df if dict(df.dtypes)[ts] in ("timestamp", "timestamp_ntz") else df.withColumn(ts, utc_timestamp(ts))
    return dated.where(F.col(ts).isNotNull()).withColumns(
        {
            "month": F.date_format(ts, "yyyy-MM"),
            "quarter_start": F.to_date(F.date_trunc("quarter", ts)),
            "quarter": quarter_name(ts),
        }
    )


def quarter_name(ts):
    return F.concat_ws(" ", display_name(F.quarter(ts), K.QUARTER_DISPLAY), F.year(ts).cast("string"))


def window_name(ts, windows=K.TIME_WINDOWS):
    """Name of the window holding a timestamp, both ends exclusive; null outside all of them.

    The windows are a short configured list, so the range test is a chain of
    comparisons in the scan's projection rather than a range join.
    """
    epoch = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.coalesce(
        *[F.when((epoch > start * 1_000_000) & (epoch < end * 1_000_000), name) for name, start, end in windows]
    )


def window_rank(c, windows=K.TIME_WINDOWS):
    """Position of a window in the configured order."""
    return F.coalesce(*[F.when(F.col(c) == name, i) for i, (name, _, _) in enumerate(windows, start=1)])
