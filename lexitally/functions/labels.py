"""Label columns: normalisation, recodings, display names."""

from functools import reduce

from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.text import strip


def normalise_label(c, valid=K.LABELS, unknown=K.INVALID):
    """Trim and lower a label; blank becomes null, anything unknown becomes `unknown`.

    Voting marks unknown labels as "invalid"; adjudication passes `unknown=None`.
    """
    c = F.col(c) if isinstance(c, str) else c
    normal = F.lower(strip(c))
    return F.when(normal.isin(list(valid)), normal).when(normal != "", F.lit(unknown).cast("string"))


def is_valid_label(c, valid=K.LABELS):
    """Predicate over the closed label set, after trim and lower."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(strip(c)).isin(list(valid)), F.lit(False))


def negative_or_not(c):
    return F.when(F.col(c) == "negative", "negative").otherwise("non_negative")


def positive_or_not(c):
    return F.when(F.col(c) == "positive", "positive").otherwise("non_positive")


def label_targets(df, label="final_sentiment"):
    """Add the three-class and the binary target."""
    return df.withColumns({"sentiment_3class": F.col(label), "sentiment_binary": negative_or_not(label)})


def display_name(c, names):
    """Mapped name, or the value itself where the map has none."""
    c = F.col(c) if isinstance(c, str) else c
    known = reduce(lambda chain, kv: chain.when(c == kv[0], kv[1]), names.items(), F)
    return known.otherwise(c.cast("string"))
