"""Features of documents are counted and weighted where their documents are."""

from collections import Counter, defaultdict
from math import isclose, log, sqrt

from lexitally.functions.text import long_tokens
from lexitally.operators import models as L
from lexitally.operators.blocks import weighted_terms
from lexitally.session import stored

ROWS = [(1, "train", "a", ["aa", "bb", "aa", "x"]), (2, "train", "b", ["bb", "cc"]), (2, "test", "b", ["aa", "bb", "cc"]), (None, "train", "a", ["cc", "aa", "bb"]),
        (None, "train", "a", ["cc", None]), (5, "test", "a", ["dd", "aa"]), (6, "train", "b", None), (7, "train", "b", [])]


def grams(tokens, a, b):
    words = [t for t in tokens or [] if t is not None and len(t) > 1]
    return (words if a == 1 else []) + ([f"{x} {y}" for x, y in zip(words, words[1:])] if b == 2 else [])


def expected(a, b, raw, min_df=2):
    tf = defaultdict(Counter)
    for *key, tokens in ROWS:
        tf[tuple(key)].update(grams(tokens, a, b))
    df = Counter(t for key, terms in tf.items() if key[1] == "train" for t in terms)
    n = sum(r[1] == "train" for r in ROWS)
    value = {(*key, t): k if raw else k * (log((1 + n) / (1 + df[t])) + 1) for key, terms in tf.items() for t, k in terms.items() if min_df <= df[t] <= 0.9 * n}
    length = Counter()
    for key, v in value.items():
        length[key[0]] += v * v
    return value if raw else {key: v / sqrt(length[key[0]]) for key, v in value.items()}


def same(features, wanted):
    found = {(r["post_id"], r["split"], r["topic"], r["term"]): r["value"] for r in features.collect()}
    assert found.keys() == wanted.keys()
    assert all(isclose(found[k], v, rel_tol=1e-12) for k, v in wanted.items())


def test_no_row_a_document_and_term_meets_the_vocabulary(spark):
    docs = spark.createDataFrame(ROWS, "post_id long, split string, topic string, tokens array<string>").repartition(3)
    plans = []

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    features = L.ngram_features(docs, {(1, 1)}, carry=["topic"], store=watched)
    assert plans and "Window" not in plans[0]
    same(features[1, 1], expected(1, 1, False))
    same(weighted_terms(docs.withColumn("tokens", long_tokens("tokens")), ("post_id", "split", "topic"), "tokens", [(1, 2)], True, max_df=0.9).withColumnRenamed("v12", "value"), expected(1, 2, True))


def test_ranges_share_counts_but_not_lengths(spark):
    docs = spark.createDataFrame(ROWS, "post_id long, split string, topic string, tokens array<string>").repartition(3)
    for (a, b), features in L.ngram_features(docs, {(1, 1), (2, 2), (1, 2)}, carry=["topic"]).items():
        same(features, expected(a, b, False))
    same(L.ngram_features(docs.where("false"), {(1, 1)}, carry=["topic"])[1, 1], {})
