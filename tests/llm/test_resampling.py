import random

import numpy as np
from pyspark.sql import functions as F

from lexitally.llm import resampling as R


def good():
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


def corpus(spark, n=600):
    random.seed(2)
    clean = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = random.choices(clean, k=random.randint(5, 80))
        bad = i % 5 == 0
        if bad:
            words = [random.choice(["scum", "trash", "%%%"]) if random.random() < 0.5 else w for w in words]
        rows.append((i, " ".join(words)))
        if i % 2 or i % 20 == 0:
            labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    kept = {r.doc_id: r.kept for r in R.resample(docs, labels, good()).select("row.doc_id", "kept").collect()}
    held_out = set(range(600)) - {r.doc_id for r in labels.collect()}
    assert np.mean([kept[d] for d in held_out if d % 5]) > 0.97
    assert np.mean([not kept[d] for d in range(0, 600, 5)]) > 0.9


def test_counts_and_weights_match_plain_numpy(spark):
    docs, _ = corpus(spark, 80)
    rows = docs.select("doc_id", R.hashed_ngrams(F.col("text"), 64).alias("_ngrams"), (F.col("doc_id") % 2 == 0).alias("_target"))
    raw, target = R.bucket_counts(rows.repartition(3), 64)
    want = np.zeros((2, 64))
    for r in rows.collect():
        for b in r._ngrams:
            want[0, b] += 1
            want[1, b] += r._target
    assert (raw == want[0]).all() and (target == want[1]).all()
    assert len(rows.first()._ngrams) == 2 * len(docs.first().text.split()) - 1


def test_kth_largest(spark):
    random.seed(1)
    values = [random.randint(-(10**13), 10**13) for _ in range(500)] + [5] * 300
    rows = spark.createDataFrame([(v,) for v in values], "x long")
    for k in (1, 2, 250, 400, 800):
        assert R.kth_largest(rows, "x", k) == sorted(values, reverse=True)[k - 1]
    assert R.kth_largest(rows, "x", 0) is None and R.kth_largest(rows.limit(0), "x", 3) is None


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (6, 0, 1), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    out = R.resample(odd, labels, good())
    assert out.count() == odd.count() and out.select("row.*").columns == odd.columns
    assert all(r.n_ngrams == 0 and r.log_weight == 0 for r in out.where("row.text IS NULL OR trim(row.text) = ''").collect())
    assert R.resample(odd, labels.limit(0), good()).where("kept").count() == odd.count()
    assert R.resample(empty, labels, good()).count() == 0
