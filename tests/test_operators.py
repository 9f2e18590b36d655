"""Operators against brute force on small fixtures, skewed groups included."""

import math
import random
import time
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.functions.text import long_tokens
from lexitally.operators import dedup as D
from lexitally.operators import models as L
from lexitally.operators import raters as A
from lexitally.operators import reports as R
from lexitally.operators import scoring as S
from lexitally.operators import terms as T
from lexitally.operators.split import stratified_folds, stratified_split
from lexitally.operators.topics import assign_topics, fit_lda, fit_nmf
from lexitally.plans import experiments as X
from lexitally.sources.contracts import ContractError, enforce_contract, require_columns
from lexitally.sources.io import read_csv, write_csv

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "x", "zeta", "theta"]


@pytest.fixture(scope="module")
def docs(spark):
    """Sixty documents; one topic and one word ("alpha") hold most of the rows."""
    rng = random.Random(7)
    rows = []
    for i in range(60):
        topic = "big" if i % 3 else ("small" if i % 2 else "tiny")
        label = K.LABELS[rng.choice([0, 1, 1, 2])]
        words = [rng.choice(WORDS if topic == "big" else WORDS[3:]) for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.8:
            words.insert(0, "alpha")
        rows.append((i, topic, label, " ".join(words)))
    rows.append((60, "big", "neutral", "unseen"))
    frame = spark.createDataFrame(rows, "post_id long, topic string, final_sentiment string, text_no_stopwords string")
    return T.with_tokens(frame).cache()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- contracts and files --------------------------------------------------------------


def test_contracts(spark):
    good = spark.createDataFrame([(1, "a", "negative"), (2, "b", "neutral")], "post_id long, text_clean string, final_sentiment string")
    assert enforce_contract(good) is good
    with pytest.raises(ContractError, match="missing required columns: url"):
        require_columns(good, "post_id", "url")
    bad = good.union(spark.createDataFrame([(2, None, "odd")], good.schema))
    with pytest.raises(ContractError, match="'invalid_label': 1, 'null_text': 1, 'duplicate_key': 1"):
        enforce_contract(bad)


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi", twice'), (2, "two\nlines"), (3, "plain; text")]
    write_csv(spark.createDataFrame(rows, "post_id long, t string").coalesce(1), str(tmp_path / "out"))
    assert rows_of(read_csv(spark, str(tmp_path / "out"), "post_id long, t string")) == rows


def test_many_topics_and_classes(spark):
    """500 topics and 300 classes: nothing depends on there being few."""
    rows = [(i, f"t{i % 500:03d}", ["all", f"w{i % 500}", f"w{i % 7}"], f"c{i % 300:03d}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "post_id long, topic string, tokens array<string>, label string")
    stats = T.topic_term_stats(docs).where("term = 'all'").collect()
    assert len(stats) == 500 and {(r.topic_term_count, r.corpus_term_count, r.topic_doc_count) for r in stats} == {(6, 3000, 6)}
    ratios = T.topic_vs_rest_tfidf(docs, min_df=2, max_df=0.9)
    assert ratios.where("term = 'w499'").count() == 500
    only = ratios.where("term = 'w499' AND topic = 't499'").first()
    assert only.topic_distinctiveness_ratio == float("inf") and only.other_doc_count == 2994
    split = stratified_split(docs, "post_id", "label").groupBy("label").agg(F.count_if(F.col("split") == "test").alias("n")).collect()
    assert len(split) == 300 and {r.n for r in split} == {2} and sum(r.n for r in split) == 600


# --- de-duplication and collection --------------------------------------------------------


def test_dedup_keeps_first_of_a_hot_group(spark):
    rows = [(i, i if i % 3 else 0, "copy" if i % 2 else f"t{i}", "a" if i < 150 else "b") for i in range(300)]
    frame = spark.createDataFrame(rows, "seq long, post_id long, text_raw string, topic string").repartition(7)
    first, seen = {}, set()
    for r in rows:
        first.setdefault(r[1], r)
    expected = [r for r in sorted(first.values()) if not ((r[2], r[3]) in seen or seen.add((r[2], r[3])))]
    assert rows_of(D.dedup_posts(frame, "seq")) == expected


def test_capped_collection(spark):
    rng = random.Random(3)
    rows = list({(t, w, q, rng.randint(1, 80)) for t in ("a", "b") for w in range(1, 6) for q in (1, 2, 3) for _ in range(20)})
    rows = [(*r, rng.random()) for r in rows]
    frame = spark.createDataFrame(rows, "topic string, window_rank int, query_rank int, post_id long, hit_rank double")
    expected = []
    for topic in ("a", "b"):
        kept = {}
        for w in range(1, 6):
            for q in (1, 2, 3):
                if len(kept) >= 30:
                    continue
                hits = sorted((r[4], r[3]) for r in rows if r[:3] == (topic, w, q))[:8]
                for _, post in hits:
                    kept.setdefault(post, (w, q))
        expected += [(topic, *where, post) for post, where in kept.items()]
    found = D.capped_collection(frame, target=30).select("topic", "window_rank", "query_rank", "post_id")
    assert rows_of(found) == sorted(expected)


def test_dense_ids(spark):
    keys = random.Random(1).sample(range(10**9), 500)
    numbered = D.dense_id(spark.createDataFrame([(k,) for k in keys], "post_id long").repartition(5), "post_id")
    assert rows_of(numbered) == [(i, k) for i, k in enumerate(sorted(keys), 1)]


def test_describe(spark):
    values = [random.Random(2).randint(1, 40) for _ in range(101)] + list(range(30))
    row = R.describe(spark.createDataFrame([(v,) for v in values], "v int"), "v").first()
    assert [row.p25, row.p50, row.p75] == pytest.approx(list(np.percentile(values, [25, 50, 75])))
    assert (row["count"], row.min, row.max) == (len(values), min(values), max(values))
    assert row["std"] == pytest.approx(np.std(values, ddof=1), abs=1e-6)


# --- raters ----------------------------------------------------------------------------------


def plurality(labels):
    labels = [x.strip().lower() if x and x.strip() else None for x in labels]
    if any(x is not None and x not in K.LABELS for x in labels):
        return "invalid_label"
    counts = Counter(x for x in labels if x)
    if sum(counts.values()) < 3:
        return "needs_review"
    top = [x for x, n in counts.items() if n == max(counts.values())]
    return top[0] if len(top) == 1 else "manual_review"


def test_vote_over_all_combinations(spark):
    from itertools import product

    sheets = list(product(["negative", " Neutral", "positive", None, "odd"], repeat=4))
    frame = spark.createDataFrame([(i, *s) for i, s in enumerate(sheets)], "post_id int, " + ", ".join(f"{r} string" for r in K.RATERS))
    found = [r.final_sentiment for r in A.vote(frame).orderBy("post_id").collect()]
    assert found == [plurality(s) for s in sheets]


def test_adjudication_only_touches_ties(spark):
    voted = spark.createDataFrame([(1, "manual_review"), (2, "manual_review"), (3, "neutral"), (4, "needs_review")], "post_id int, final_sentiment string")
    decided = spark.createDataFrame([(1, " Positive"), (2, "odd"), (3, "negative"), (4, "negative")], "post_id int, adjudicated_sentiment string")
    resolved = A.adjudicate(voted, decided)
    assert rows_of(resolved.select("post_id", "final_sentiment")) == [(1, "positive"), (2, "manual_review"), (3, "neutral"), (4, "needs_review")]
    assert {r.post_id for r in A.unresolved(resolved).collect()} == {2, 4}


def test_identical_raters_agree_fully(spark):
    same = spark.createDataFrame([(i, *[K.LABELS[i % 3]] * 4) for i in range(9)], "post_id int, " + ", ".join(f"{r} string" for r in K.RATERS))
    assert {r.kappa for r in A.cohen_kappa(same).collect()} == {1.0}
    assert A.fleiss_kappa(same).first().kappa == 1.0


# --- splits ------------------------------------------------------------------------------------


def test_split_ignores_partitioning(docs):
    one = stratified_split(docs.select("post_id", "topic"), "post_id", "topic")
    other = stratified_split(docs.select("post_id", "topic").repartition(9, "topic"), "post_id", "topic")
    assert rows_of(one) == rows_of(other)
    assert one.where("split = 'test'").count() == math.ceil(0.2 * docs.count())


def test_folds_are_even_within_classes(docs):
    sizes = stratified_folds(docs.select("post_id", "topic"), "post_id", "topic").groupBy("topic", "fold").count()
    for topic in ("big", "small", "tiny"):
        counts = [r["count"] for r in sizes.where(F.col("topic") == topic).collect()]
        assert max(counts) - min(counts) <= 1


# --- corpus statistics -----------------------------------------------------------------------------


def test_tfidf_rows_have_length_one(docs):
    pairs = T.ngram_counts(docs)
    weights = T.tfidf(pairs, T.vocabulary(pairs, docs))
    lengths = weights.groupBy("post_id").agg(F.sum(F.col("value") * F.col("value")).alias("s")).collect()
    assert lengths and all(r.s == pytest.approx(1.0) for r in lengths)


def test_min_max_stays_in_range(docs):
    stats = T.min_max_within(T.topic_term_stats(docs), ["topic_term_freq"]).agg(F.min("topic_term_freq_norm"), F.max("topic_term_freq_norm")).first()
    assert tuple(stats) == (0.0, 1.0)


def test_test_rows_never_change_the_fitted_tables(docs):
    parted = stratified_split(docs, "post_id", "topic").cache()
    changed = parted.withColumn("tokens", F.when(F.col("split") == "test", F.array(F.lit("alpha"), F.lit("new"))).otherwise(F.col("tokens")))
    keep = F.col("split") == "train"
    one, two = (rows_of(S.fit_scores(x.where(keep))[0]) for x in (parted, changed))
    assert one == two


def test_best_topic_keeps_documents_without_a_match(docs):
    terms, pairs = S.fit_scores(docs)
    best = {r.post_id: r for r in S.best_topic_scores(docs, terms, pairs).collect()}
    assert len(best) == docs.count()
    assert best[60].matched_unigram_count == 0 and best[60].document_custom_score == 0.0


# --- models -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def parted(docs):
    return stratified_split(docs, "post_id", "topic").cache()


def matrix_of(features):
    vectors = {}
    for r in features.collect():
        vectors.setdefault(r.post_id, {})[r.term] = r.value
    return vectors


def test_naive_bayes_matches_the_formula(parted):
    features = L.text_features(parted, "bow", carry=["topic"]).cache()
    found = {r.post_id: r.predicted for r in L.naive_bayes(features, parted, "topic", ["big", "small", "tiny"], True).collect()}
    vectors, docs = matrix_of(features), parted.collect()
    train = [d for d in docs if d.split == "train"]
    vocab = sorted({t for d in train for t in vectors.get(d.post_id, {})})
    sizes = Counter(d.topic for d in train)
    weight = {c: len(train) / (len(sizes) * n) for c, n in sizes.items()}
    log_prob = {}
    for c in sizes:
        mass = {t: weight[c] * sum(vectors.get(d.post_id, {}).get(t, 0) for d in train if d.topic == c) for t in vocab}
        total = sum(mass.values()) + len(vocab)
        log_prob[c] = {t: math.log((m + 1) / total) for t, m in mass.items()}
    for d in docs:
        if d.split == "test":
            score = {c: round(math.log(weight[c] * sizes[c] / sum(weight[x] * sizes[x] for x in sizes)) + sum(v * log_prob[c][t] for t, v in vectors.get(d.post_id, {}).items()), 9) for c in sizes}
            assert found[d.post_id] == min(score, key=lambda c: (-score[c], c))


@pytest.mark.parametrize("blocks", [{}, {"block_tokens": 12}])
def test_nearest_neighbours_match_brute_force(parted, blocks):
    features = L.text_features(parted, "tfidf").cache()
    found = {}
    for r in L.nearest_neighbours(features, parted, "topic", **blocks).collect():
        found.setdefault(r.test_id, []).append((r["rank"], r.train_id))
    vectors, docs = matrix_of(features), parted.collect()
    for d in docs:
        if d.split != "test":
            continue
        a = vectors.get(d.post_id, {})
        order = []
        for e in docs:
            if e.split == "train":
                b = vectors.get(e.post_id, {})
                order.append((round(sum((a.get(t, 0) - b.get(t, 0)) ** 2 for t in {*a, *b}), 9), e.post_id))
        assert [i for _, i in sorted(found[d.post_id])] == [i for _, i in sorted(order)[:5]]


def test_ngram_ranges_from_one_count_are_the_features_of_each(parted):
    spans = [(1, 1), (2, 2), (1, 2)]
    found = L.ngram_features(parted, spans, carry=["topic"])
    for span in spans:
        want = L.text_features(parted, "tfidf", span, carry=["topic"])
        rows = [{(r.post_id, r.split, r.topic, r.term): round(r.value, 9) for r in table.collect()} for table in (found[span], want)]
        assert rows[0] == rows[1] and len(rows[0]) > 50


def test_features_shuffle_documents_and_not_their_terms(parted):
    parted = parted.sparkSession.createDataFrame(parted.select("post_id", "split", "topic", "tokens").collect())
    plan = L.text_features(parted, "bow", carry=["topic"])._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    pairs = [line for line in plan.splitlines() if "Exchange hashpartitioning(post_id" in line]
    assert pairs and not any("term" in line for line in pairs)


def _documents(rng, n, words, first_id):
    codes = [np.unique(words(rng)) for _ in range(n)]
    return pd.DataFrame({"id": np.arange(first_id, first_id + n), "codes": codes, "values": [rng.integers(1, 4, len(c)).astype(float) for c in codes]})


def test_blocks_of_neighbours_with_common_and_rare_terms():
    rng = np.random.default_rng(4)
    words = lambda r: np.concatenate([r.integers(0, 6, r.integers(0, 5)), r.integers(6, 400, r.integers(0, 9))])
    test, train = _documents(rng, 60, words, 0), _documents(rng, 150, words, 1000)
    dense = [np.zeros((len(side), 400)) for side in (test, train)]
    for table, side in zip(dense, (test, train)):
        for i, (c, v) in enumerate(zip(side["codes"], side["values"])):
            table[i, c] = v
    d2 = ((dense[0][:, None] - dense[1]) ** 2).sum(axis=2)
    want = {(i, 1000 + int(j), d2[i, j]) for i in range(60) for j in np.lexsort((np.arange(150), d2[i]))[:5]}
    for options in ({}, {"cells": 500}, {"common": 0.0}, {"common": 2.0}):
        found = L._block_neighbours("id", 5, **options)(test, train)
        assert set(found.itertuples(index=False, name=None)) == want


def test_distances_cost_what_documents_share():
    def cost(length):
        rng = np.random.default_rng(5)
        test, train = (_documents(rng, n, lambda r: r.integers(0, 1_000_000, length), at) for n, at in ((400, 0), (3000, 1000)))
        start = time.process_time()
        L._block_neighbours("id", 5)(test, train)
        return time.process_time() - start

    cost(2)
    assert cost(300) < 8 * cost(2) + 0.5


def test_forest_predicts_every_test_row(parted):
    vectors = L.vectorise(parted.withColumn("_terms", long_tokens("tokens")), "tfidf")
    guess = L.random_forest(vectors, "topic", trees=5, weighted=True, max_depth=5)
    assert guess.count() == parted.where("split = 'test'").count()
    assert {r.predicted for r in guess.collect()} <= {"big", "small", "tiny"}


def test_forest_matrix_and_folds(docs):
    runs = X.forest_matrix(docs, {"three": ("topic", ["big", "small", "tiny"])}, trees=2)
    assert runs.select("representation", "config").distinct().count() == 4
    classes = ["big", "small", "tiny"]
    scores = X.fold_scores(X.fold_runs(docs, "topic", classes, folds=2), classes)
    assert scores.count() == 4


# --- latent topics -------------------------------------------------------------------------------------


def test_nmf_loss_never_rises(docs):
    weights, terms, losses = fit_nmf(docs, k=2, iterations=6, tolerance=0.0)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    assert weights.count() == docs.count()
    assert terms.agg(F.min(F.least("h0", "h1"))).first()[0] >= 0.0


def test_lda_mix_sums_to_one(docs):
    mixed, top = fit_lda(docs.withColumn("_terms", long_tokens("tokens")), k=2, iterations=3, n_terms=4)
    sums = mixed.select(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in sums)
    assert top.count() == 8
    dominant = assign_topics(mixed, k=2)
    assert dominant.where("dominant_topic_probability < 0.5").count() == 0


def test_fold_sums_give_the_models_of_single_folds(spark):
    """Cross-validation from shared sums predicts what a model fitted on each fold's training rows predicts."""
    from lexitally.functions.text import long_tokens
    from lexitally.operators.models import naive_bayes, text_features
    from lexitally.plans.folds import bayes_folds

    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, y, [rng.choice(words[k * 8 : k * 8 + 25]) for _ in range(rng.randrange(0, 12))], i % 3) for i in range(60) for k, y in [(i % 2, "ab"[i % 2])]]
    docs = spark.createDataFrame(rows, "post_id long, y string, tokens array<string>, fold long").withColumn("_terms", long_tokens("tokens"))
    found = {(r.representation, r.fold, r.post_id): (r.actual, r.predicted) for r in bayes_folds(docs, "y", ["a", "b", "never"], 3).collect()}
    want = {}
    for fold in range(3):
        parted = docs.withColumn("split", F.when(F.col("fold") == fold, "test").otherwise("train"))
        for kind in ("bow", "tfidf"):
            for r in naive_bayes(text_features(parted, kind, carry=["y"]), parted, "y", ["a", "b", "never"]).collect():
                want[kind, fold, r.post_id] = r.y, r.predicted
    assert found == want and len(found) == 120
