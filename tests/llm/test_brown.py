import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexitally.llm import brown as B
from lexitally.llm.text import word_bytes


def corpus(n=300):
    """Two languages whose words alternate between two kinds: neighbours tell much about a word."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        tongue = "ab"[i % 2]
        words = [f"{tongue}{kind}{rng.integers(40)}" for _ in range(rng.integers(3, 25)) for kind in "xy"]
        rows.append((i, " ".join(words).title()))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"known": 60, "clustered": 20, "suffixes": 8, "n_classes": 9}])
def test_scores(spark, odd, sizes):
    """Base scores by brute force; the model beats them on held-out texts; a join changes no score."""
    docs = odd.unionByName(spark.createDataFrame([(i + 100, t) for i, t in corpus()], "doc_id long, text string"), allowMissingColumns=True)
    train = F.col("doc_id") % 4 != 1
    found = B.score_documents(docs.repartition(3), train, **sizes).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts = Counter()
    for d, t in rows:
        if d is None or d % 4 != 1:
            counts.update([*word_bytes(t or ""), b""])
    n, v = sum(counts.values()), len(counts)
    want = sorted((d is None, d or 0, len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
                  for d, w in ((d, [*word_bytes(t or ""), b""]) for d, t in rows))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == want
    assert {r.train_tokens for r in found} == {n}
    held = [r for r in found if not r.train and r.doc_id >= 100]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_exchange_raises_the_likelihood():
    """On texts of two kinds of words, with the counts a plain pass over them gives."""
    rng = np.random.default_rng(1)
    stream = np.concatenate([np.append(rng.integers(1, 11, 9) + 10 * (np.arange(9) % 2), 0) for _ in range(200)])
    units, k = 21, 4
    classes = 1 + np.arange(units) % 3
    classes[0] = 0

    def tables(classes):
        left = np.concatenate([[0], stream[:-1]])
        after, before = np.zeros((units, k)), np.zeros((units, k))
        np.add.at(after, (stream, classes[left]), 1)
        np.add.at(before, (left, classes[stream]), 1)
        return after, before

    def likelihood(classes):
        table = B.class_bigrams(tables(classes)[0], classes)
        return B._entropy(table).sum() - B._entropy(table.sum(0)).sum() - B._entropy(table.sum(1)).sum()

    first = likelihood(classes)
    for _ in range(3):
        classes = B.exchange(*tables(classes), classes)
    assert likelihood(classes) > first and classes[0] == 0
    assert len(set(classes[1:11])) < 3 and not set(classes[1:11]) & set(classes[11:])


def test_probabilities_sum_to_one(spark):
    """Over the end, every training word and one unseen word a unit, after any class."""
    texts = spark.createDataFrame([(t,) for _, t in corpus(60)], "text string")
    counts = B.word_counts(texts)
    model = B.fit(texts, counts)
    d = model.dictionary
    total = 0.0
    for r in counts.collect():
        word = bytes(r.word)
        unit = 0 if not word else int(d.look_up([word])[1][0])
        share = math.log10(r.n + 1) - model.share_total[unit] if unit >= d.first_suffix else 0.0
        total += 10 ** (model.transition[1, model.classes[unit]] + model.emission[unit] + share)
    for unit in range(d.first_suffix, d.units):
        total += 10 ** (model.transition[1, model.classes[unit]] + model.emission[unit] - model.share_total[unit])
    # A unit's shares leave out nothing: n + v + 1 is the counts plus one each, plus the unseen word.
    assert total == pytest.approx(1.0, abs=1e-9)


def test_empty_table(empty):
    assert B.score_documents(empty, F.lit(True)).count() == 0


def test_nothing_to_learn_from(odd):
    rows = B.score_documents(odd, F.lit(False)).collect()
    assert len(rows) == odd.count() and {r.train_tokens for r in rows} == {0} and {r.n_known for r in rows} == {0}
