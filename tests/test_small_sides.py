"""Tables of one row a class or topic never make a shuffle by it, whatever sizes Spark guesses."""

import pytest
from pyspark.sql import functions as F

from lexitally.operators import scoring as S
from lexitally.operators import terms as T
from lexitally.operators.split import stratified_split


@pytest.fixture
def docs(spark):
    rows = [(i, "ab"[i % 2], "negative", [f"w{i % 5}", "x", f"v{i % 3}"]) for i in range(40)]
    return spark.createDataFrame(rows, "post_id long, topic string, final_sentiment string, tokens array<string>")


@pytest.fixture
def unguessed(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_joins_no_stratum_by_shuffle(docs, unguessed):
    made = plan(stratified_split(docs, "post_id", "topic"))
    assert made.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in made


def test_topic_tables_are_broadcast(docs, unguessed):
    terms = docs.select("topic", F.explode("tokens").alias("term")).groupBy("topic", "term").agg(F.count("*").alias("tf"), F.count("*").alias("df"))
    terms = terms.withColumns({f"n_{x}": F.lit(1) for x in ("negative", "neutral", "positive")})
    for made in (T.min_max_within(terms, ["tf"], store=lambda df, _: df), S.label_gap(docs, terms)):
        assert "BroadcastHashJoin" in plan(made) and "SortMergeJoin" not in plan(made)


def test_documents_against_every_topic(docs, spark):
    terms = spark.createDataFrame([("a", "x", 0.5, 1.0), ("b", "x", 0.25, 0.5), ("b", "w1", 1.0, 0.0)], "topic string, term string, custom_term_score double, positional_score_norm double")
    pairs = spark.createDataFrame([("a", "w1 x", 0.75)], "topic string, bigram string, custom_bigram_score double")
    found = {r.post_id: r for r in S.best_topic_scores(docs, terms, pairs).collect()}
    assert len(found) == 40 and found[0].document_unigram_score == 0.5 and found[0].document_positional_score == 0.5
    assert found[1].document_bigram_score == 0.75 and found[1].matched_unigram_count == 1 and found[1].matched_bigram_count == 1
