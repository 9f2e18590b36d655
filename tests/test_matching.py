"""Tables of keywords and windows against plain computations."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexitally.functions.text import keyword_hits
from lexitally.operators.matching import _counter, count_in_windows, in_windows, relevant_by_table
from lexitally.operators.dedup import dense_id, first_seen
from lexitally.operators.stats import expected_counts
from lexitally.operators.terms import grouped_terms

TEXTS = ["aa aaa aaaa", "The ETH and eth_1, eth-2 ethereum", "", None, "x", "été eth é eth", "ab-ab ab.ab abab", "machine learning  machine learning", "İETH Σ ΑΣ eth٣", "😀eth😀 aa"]


def test_keyword_table_counts_as_the_projection_does(spark):
    keywords = [("a", "aa", False), ("a", "aaa", False), ("a", "eth", True), ("b", "eth", False), ("b", "ab", True), ("b", "machine learning", False), ("c", "-", False), ("c", "é", True), ("c", "ab-ab", True)]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    table = spark.createDataFrame(keywords + [("a", "aa", False), ("d", "", False), ("d", None, True), (None, "x", None)], "topic string, keyword string, whole_word boolean")
    found = {(r.id, r.topic): r.keyword_hits for r in relevant_by_table(docs, "t", table, 1).collect()}
    want = {}
    for topic in "abc":
        whole = [k for t, k, w in keywords if t == topic and w]
        counted = docs.select("id", keyword_hits("t", [k for t, k, _ in keywords if t == topic], whole).alias("n"))
        want |= {(r.id, topic): r.n for r in counted.collect() if r.n}
    assert found == want and len(found) > 10
    with pytest.raises(ValueError):
        relevant_by_table(docs, "t", table, 1, most=3)
    assert relevant_by_table(docs, "t", table.where("false")).count() == 0


def test_many_keywords_cost_little_more_than_few():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    text = " ".join(word() for _ in range(20_000))
    few, many = ([("t", word(), False) for _ in range(n)] for n in (30, 5000))

    def cost(rows):
        hits = _counter(rows)
        start = time.process_time()
        for _ in range(5):
            hits(text)
        return time.process_time() - start

    assert cost(many) < 3 * cost(few) + 0.05


def test_many_overlapping_windows(spark):
    rng = random.Random(2)
    windows = [(f"w{i}", s, s + rng.choice([0, -5, 1, 2, 60, 3600, 86_400, 10**7])) for i in range(10_000) for s in [rng.randrange(-10**6, 10**7)]]
    seconds = [rng.randrange(-2 * 10**6, 2 * 10**7) + rng.choice([0.0, 0.000001, 0.5]) for _ in range(60)] + [float(windows[7][1]), float(windows[7][2])]
    rows = [(i, s) for i, s in enumerate(seconds)] + [(99, None)]
    events = spark.createDataFrame(rows, "id long, s double").withColumn("ts", F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("long")))
    table = spark.createDataFrame(windows, "window_name string, start long, end long")
    found = in_windows(events.select("id", "ts"), "ts", table)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    want = sorted((i, n) for i, s in enumerate(seconds) for n, a, b in windows if a < round(s * 10**6) / 10**6 < b)
    assert sorted((r.id, r.window_name) for r in found.select("id", "window_name").collect()) == want
    assert in_windows(events, "ts", table.where("false")).count() == 0


def test_window_counts_without_meeting_rows(spark):
    rng = random.Random(3)
    windows = [(f"w{i % 300}", s, s + rng.choice([0, -5, 1, 2, 60, 3600, 10**7])) for i in range(400) for s in [rng.randrange(-10**6, 10**7)]] + [("none", None, 5), (None, 0, 10**7)]
    seconds = [rng.randrange(-2 * 10**6, 2 * 10**7) + rng.choice([0.0, 0.000001, 0.5]) for _ in range(60)] + [float(t) for w in windows[:20] for t in w[1:]] * 2
    events = spark.createDataFrame([(s,) for s in [*seconds, None]], "s double").select(F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("long")).alias("ts"))
    table = spark.createDataFrame(windows, "window_name string, start long, end long")
    found = count_in_windows(events, "ts", table)
    want = Counter(n for s in seconds for n, a, b in windows if a is not None and a < round(s * 10**6) / 10**6 < b)
    assert {r["window_name"]: r["count"] for r in found.collect()} == want and len(want) > 50
    assert count_in_windows(events, "ts", table.where("false")).count() == 0
    # Every window holds every row here; a row per match would be far more than these.
    many = events.crossJoin(spark.range(2000).select()).select("ts")
    wide = spark.range(2000).select(F.col("id").cast("string").alias("window_name"), (-F.col("id") - 10**7).alias("start"), (F.col("id") + 10**8).alias("end"))
    assert {r["count"] for r in count_in_windows(many, "ts", wide).collect()} == {2000 * len(seconds)}


def test_expected_counts_of_many_rows(spark):
    counts = spark.range(20_000).select((F.col("id") % 5000).alias("r"), F.when(F.col("id") % 7 < 3, "x").otherwise("y").alias("c"))
    found = expected_counts(counts, "r", "c", ["x", "y", "z"])
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()
    total = found.agg(F.count("*"), F.sum("count"), F.round(F.sum("expected"), 6), F.max(F.when(F.col("c") == "z", F.col("expected")))).first()
    assert tuple(total) == (15_000, 20_000, 20_000.0, 0.0)


def test_dense_ids_over_ranges_and_first_seen_with_ties(spark):
    rows = [(i * 37 % 1009, f"v{i}") for i in range(1009)]
    found = dense_id(spark.createDataFrame(rows, "k long, v string").repartition(7), "k").collect()
    assert sorted((r.item_id, r.k) for r in found) == [(i + 1, i) for i in range(1009)]
    hits = spark.createDataFrame([("t", 1, 2, 5, "a"), ("t", 1, 1, 9, "b"), ("t", 1, 1, 9, "b"), ("t", 2, 3, 3, "c"), (None, 1, 1, 1, "d")], "topic string, post_id long, w long, q long, x string")
    assert sorted(map(tuple, first_seen(hits, ["w", "q"]).collect()), key=str) == [("t", 1, 1, 9, "b"), ("t", 2, 3, 3, "c"), (None, 1, 1, 1, "d")]


def test_grouped_terms_counts_occurrences_and_documents(spark):
    docs = spark.createDataFrame([("t", ["a", "b", "a"]), ("t", ["a"]), ("u", ["b"]), ("u", [])], "topic string, tokens array<string>")
    assert sorted(map(tuple, grouped_terms(docs).collect())) == [("t", "a", 3, 2), ("t", "b", 1, 1), ("u", "b", 1, 1)]


def test_small_tables_are_dealt_over_all_cores_and_others_left(spark, tmp_path):
    from lexitally.session import spread

    spark.range(1000).coalesce(1).write.parquet(f"file://{tmp_path}/one")
    spark.range(1000).repartition(6).write.parquet(f"file://{tmp_path}/six")
    one, six = (spark.read.parquet(f"file://{tmp_path}/{name}") for name in ("one", "six"))
    assert spread(one).rdd.getNumPartitions() == 4 and spread(one).count() == 1000
    assert spread(six) is six
