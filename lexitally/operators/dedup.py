"""De-duplication, first-seen rules, collection caps and dense ids."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.session import stored


def keep_first(df, keys, order, store=stored):
    """One row per key, the one with the smallest `order`; of rows that share both, the first by its place in the table.

    The winners are found over narrow rows (256-bit key hash, order, place) by hash
    aggregates, reduced in every map task, so a key that holds a third of the table
    sends one row per task. Only then are their rows fetched, so a text moves once.
    The table is stored first: places must stay what they are.
    """
    rows = _placed(df, {"_key": keys}, store)
    return _fetched(rows, _winners(rows, "_key", order), df.columns)


def _placed(df, keys, store):
    """The stored table with hashes of keys and a number for every row."""
    return store(df.withColumns({name: _hashed(of) for name, of in keys.items()} | {"_place": F.monotonically_increasing_id()}), "placed-rows")


def _winners(rows, key, order, carry=()):
    """(_place, key, carry, order): the narrow row of the first of every key."""
    first = rows.groupBy(key).agg(F.min(order).alias("_first"))
    narrow = rows.select(F.col(key).alias("_own"), order, "_place")
    least = narrow.join(first, (F.col("_own") == F.col(key)) & F.col(order).eqNullSafe(F.col("_first"))).groupBy(key).agg(F.min("_place").alias("_place"))
    return rows.select("_place", *carry, order).join(least.select("_place"), "_place") if carry else least.select("_place")


def _fetched(rows, winners, columns):
    return rows.join(winners.select("_place"), "_place", "left_semi").select(*columns)


def _hashed(keys):
    """A 256-bit hash of columns that keeps nulls and borders apart."""
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def dedup_posts(df, order, post_id="post_id", text="text_raw", topic="topic", store=stored):
    """Keep-first by post id, then by (text, topic); rows are fetched once, after both."""
    rows = _placed(df, {"_by_id": [post_id], "_by_text": [text, topic]}, store)
    once = store(_winners(rows, "_by_id", order, carry=("_by_text",)), "first-by-id")
    return _fetched(rows, _winners(once, "_by_text", order), df.columns)


def first_seen(hits, order, topic="topic", post_id="post_id", store=stored):
    """Each post once per topic, at the first of the `order` columns it turned up in.

    The winner is the first narrow row (keys, order, place); a map task sends one a key.
    """
    rows = store(hits.withColumn("_place", F.monotonically_increasing_id()), "placed-rows")
    first = Window.partitionBy(topic, post_id).orderBy(*order, "_place")
    winners = rows.select(topic, post_id, *order, "_place").withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1)
    return _fetched(rows, winners, hits.columns)


def capped_collection(
    hits,
    window_rank="window_rank",
    query_rank="query_rank",
    hit_order="hit_rank",
    topic="topic",
    post_id="post_id",
    per_query=K.MAX_HITS_PER_QUERY,
    target=K.TOPIC_TARGET,
):
    """Collect at most `per_query` posts per (window, query) and stop a topic at `target`.

    The target is tested before each query, so a topic may end up to
    `per_query - 1` above it. Steps: distinct posts per query; the first few of
    each (`row_number <= k` is limited in every map task before it shuffles);
    first-seen per topic; then a running total over the short list of (window,
    query) pairs decides which of them still ran.
    """
    query = [topic, window_rank, query_rank]
    once = hits.groupBy(*query, post_id).agg(F.min(hit_order).alias(hit_order))
    by_hit = Window.partitionBy(*query).orderBy(hit_order, post_id)
    fetched = once.withColumn("_n", F.row_number().over(by_hit)).where(F.col("_n") <= per_query).drop("_n")
    new = first_seen(fetched, [window_rank, query_rank, hit_order], topic, post_id)
    earlier = Window.partitionBy(topic).orderBy(window_rank, query_rank).rowsBetween(Window.unboundedPreceding, -1)
    ran = (
        new.groupBy(*query)
        .agg(F.count(F.lit(1)).alias("_new"))
        .withColumn("_before", F.coalesce(F.sum("_new").over(earlier), F.lit(0)))
        .where(F.col("_before") < target)
        .select(*query)
    )
    return new.join(ran, query, "left_semi")


def collection_shortfall(collected, topic="topic", target=K.TOPIC_TARGET):
    """Posts per topic and whether the topic stayed short of its target."""
    return (
        collected.groupBy(topic)
        .agg(F.count(F.lit(1)).alias("posts"))
        .withColumn("short_of_target", F.col("posts") < target)
    )


def dense_id(df, order, name="item_id", store=stored):
    """Ids 1..n in the order of a unique column, as the first column.

    Rows are sorted by ranges of the order; a row's id is its place in its range plus the
    rows of the ranges before, one number a range. The input is evaluated once.
    """
    rest = [c for c in df.columns if c != name]
    rows = store(df.select(*rest), "unnumbered")
    ranged = store(rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_row", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_row", 33)  # the id holds the partition above 33 bits and the row below
    earlier = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")).select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("_part", part).join(offsets, "_part").select((inside + F.col("_before") + 1).alias(name), *rest)


def duplicate_count(df, *keys):
    """Rows beyond the first of each key, as one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
