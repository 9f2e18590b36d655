"""Data contracts: required columns, then row-level checks in one pass."""

from pyspark.sql import functions as F

from lexitally import constants as K


class ContractError(ValueError):
    pass


def require_columns(df, *columns):
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"missing required columns: {', '.join(missing)}")
    return df


def contract_report(df, key="post_id", text="text_clean", label="final_sentiment", valid=K.LABELS):
    """One row with the number of rows that break each rule.

    Keys are counted per key first, so the duplicate check is a partial
    aggregation instead of a distinct over the whole table in one task.
    """
    require_columns(df, key, text, label)
    bad_label = F.col(label).isNull() | ~F.col(label).isin(list(valid))
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(bad_label).alias("bad"),
        F.count_if(F.col(text).isNull()).alias("blank"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_label"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("null_text"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_key"),
    )


def enforce_contract(df, **rules):
    """`df` itself if every rule holds; raises with the counts otherwise."""
    found = contract_report(df, **rules).first().asDict()
    broken = {rule: n for rule, n in found.items() if rule != "rows" and n}
    if broken:
        raise ContractError(f"contract broken: {broken}")
    return df
