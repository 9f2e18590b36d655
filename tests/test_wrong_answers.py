"""Cases that once gave other answers than they should."""

import random
from itertools import permutations

from pyspark.sql import functions as F

from lexitally.functions.labels import is_valid_label, normalise_label
from lexitally.functions.text import keyword_hits, not_blank
from lexitally.operators.dedup import keep_first
from lexitally.operators.raters import adjudicate
from lexitally.operators.stats import chi_square
from lexitally.operators.topics import alignment, best_assignment, fit_lda


def test_labels_lose_any_white_space(spark):
    rows = spark.createDataFrame([("negative\n",), ("\t\n",), ("\u00a0Neutral\u2003",), ("\tunsure",), (None,)], "label string")
    found = rows.select(normalise_label("label"), is_valid_label("label"), not_blank("label")).collect()
    assert [tuple(r) for r in found] == [
        ("negative", True, True), (None, False, False), ("neutral", True, True), ("invalid", False, True), (None, False, False),
    ]


def test_adjudication_with_white_space(spark):
    voted = spark.createDataFrame([(1, " manual_review\n"), (2, "neutral")], "post_id long, final_sentiment string")
    decided = spark.createDataFrame([(1, "\tPositive\n"), (2, "negative")], "post_id long, adjudicated_sentiment string")
    found = {r.post_id: r.final_sentiment for r in adjudicate(voted, decided).collect()}
    assert found == {1: "positive", 2: "neutral"}


def test_chi_square_of_wide_tables(spark):
    """A table of independent counts has p = 1 at any size; a shifted one has a tiny p."""
    for rows in (250, 1001):
        even = spark.createDataFrame([(f"r{i}", 5, 7, 9, 21) for i in range(rows)], "topic string, a long, b long, c long, total long")
        assert chi_square(even, "topic", "label", ["a", "b", "c"], counted=True).first().p_value == 1.0
    odd = even.withColumn("a", F.when(F.col("topic") < "r5", F.lit(30)).otherwise(F.col("a"))).withColumn("total", F.col("a") + F.col("b") + F.col("c"))
    assert chi_square(odd, "topic", "label", ["a", "b", "c"], counted=True).first().p_value < 1e-6


def test_keywords_are_plain_text(spark):
    rows = spark.createDataFrame([("i like c++ a lot",), ("a.i or ai",)], "t string")
    found = rows.select(keyword_hits("t", ["c++", "a.i", "("], ["c++", "a.i", "("])).collect()
    assert [r[0] for r in found] == [0, 1]


def test_assignment_of_any_shape(spark):
    random.seed(3)
    for n in range(1, 7):
        worth = [[random.randint(0, 9) for _ in range(n)] for _ in range(n)]
        best = best_assignment(worth)
        assert sorted(best) == list(range(n))
        assert sum(worth[i][j] for i, j in enumerate(best)) == max(sum(worth[i][p[i]] for i in range(n)) for p in permutations(range(n)))
    wide = spark.createDataFrame([("a", 0, 5), ("a", 1, 2), ("b", 0, 4), ("b", 2, 3), ("b", 3, 1)], "actual_topic string, latent_topic int, count long")
    assert alignment(wide).first()[0] == round(8 / 15, 4)
    large = spark.createDataFrame([(f"t{i:02d}", (i + 1) % 30, 10) for i in range(30)], "actual_topic string, latent_topic int, count long")
    assert alignment(large).first()[0] == 1.0


def test_keep_first_with_nulls_and_hot_keys(spark):
    rows = [(i, None if i % 3 == 0 else "k" if i % 3 == 1 else f"k{i % 7}", f"text {i}") for i in range(60)]
    frame = spark.createDataFrame(rows, "seq long, k string, text string")
    want = {}
    for seq, k, text in rows:
        want.setdefault(k, (seq, k, text))
    assert sorted(map(tuple, keep_first(frame, ["k"], "seq").collect())) == sorted(want.values())


def test_lda_is_the_batch_fit(spark):
    """More iterations do not fit worse, and two kinds of documents part."""
    random.seed(5)
    rows = [(i, [f"{'ab'[i % 2]}{random.randint(0, 8)}" for _ in range(12)]) for i in range(80)]
    docs = spark.createDataFrame(rows, "post_id long, _terms array<string>")
    mixed, _ = fit_lda(docs, k=2, iterations=30, min_df=1, max_df=0.99)
    best = {r.post_id: r.weights.index(max(r.weights)) for r in mixed.collect()}
    assert len({best[i] for i in range(0, 80, 2)}) == 1 and len({best[i] for i in range(1, 80, 2)}) == 1 and best[0] != best[1]
