"""Small published tables, input and output, that the operators must reproduce."""

import pytest
from pyspark.sql import functions as F

from lexitally import constants as K
from lexitally.operators import metrics as M
from lexitally.operators import reports as R
from lexitally.operators.split import test_quotas as quotas_of
from lexitally.operators.stats import chi_square, paired_t_test, t_two_sided
from lexitally.operators.topics import alignment

TOPICS = ["Artificial Intelligence", "Climate Change", "Cryptocurrency", "Cybersecurity"]
TOPIC_BY_LABEL = [(68, 155, 30), (98, 151, 16), (103, 149, 20), (88, 165, 13)]


@pytest.fixture(scope="module")
def topic_by_label(spark):
    rows = [(t, *c, sum(c)) for t, c in zip(TOPICS, TOPIC_BY_LABEL)]
    return spark.createDataFrame(rows, "topic string, negative long, neutral long, positive long, total long")


def repeated(spark, counts):
    return spark.createDataFrame([(k, n) for k, n in counts.items()], "label string, n int").select(
        "label", F.explode(F.sequence(F.lit(1), "n")).alias("post_id")
    )


def test_chi_square(topic_by_label):
    row = chi_square(topic_by_label, "topic", "label", counted=True, digits=10).first()
    assert row.chi2_statistic == pytest.approx(16.9966694297615, abs=1e-8)
    assert row.p_value == pytest.approx(0.0092954924696, abs=1e-9)
    assert (row.degrees_of_freedom, row.total_records) == (6, 1056)
    assert row.cramers_v == pytest.approx(0.0897087813, abs=1e-9)


def test_chi_square_one_degree_of_freedom_is_corrected(spark):
    table = spark.createDataFrame([("a", 10, 20, 30), ("b", 30, 40, 70)], "topic string, x long, y long, total long")
    row = chi_square(table, "topic", "label", ["x", "y"], counted=True).first()
    assert row.degrees_of_freedom == 1
    assert row.chi2_statistic == pytest.approx(0.4464285714, abs=1e-8)
    assert row.p_value == pytest.approx(0.5040358664, abs=1e-8)


def test_row_percentages(topic_by_label):
    rows = {r.topic: r for r in R.row_percentages(topic_by_label, K.LABELS).collect()}
    assert rows["Climate Change"].negative == 37.0 and rows["Cybersecurity"].positive == 4.9


def test_class_weights(spark):
    labels = repeated(spark, {"negative": 357, "neutral": 620, "positive": 79})
    found = {r.label: round(r.weight, 4) for r in R.class_weights(labels, "label").collect()}
    assert found == {"negative": 0.986, "neutral": 0.5677, "positive": 4.4557}
    binary = {r.label: round(r.weight, 4) for r in R.class_weights(repeated(spark, {"negative": 357, "rest": 699}), "label").collect()}
    assert binary == {"negative": 1.479, "rest": 0.7554}


def test_target_options(spark):
    labels = repeated(spark, {"negative": 357, "neutral": 620, "positive": 79}).withColumnRenamed("label", "final_sentiment")
    rows = {r.option[0]: r for r in R.target_options(labels).collect()}
    assert [rows[k].records_kept for k in "ABCD"] == [1056, 436, 1056, 1056]
    assert [rows[k].imbalance_ratio for k in "ABCD"] == [7.85, 4.52, 1.96, 12.37]
    assert [rows[k].baseline_accuracy_pct for k in "ABCD"] == [58.7, 81.9, 66.2, 92.5]
    assert [rows[k].minority_in_test_set for k in "ABCD"] == [16, 16, 71, 16]


def test_split_quotas(spark):
    topics = repeated(spark, dict(zip(TOPICS, (253, 265, 272, 266))))
    assert {r.label: r.quota for r in quotas_of(topics, "label").collect()} == dict(zip(TOPICS, (51, 53, 55, 53)))
    labels = repeated(spark, {"negative": 357, "neutral": 620, "positive": 79})
    assert {r.label: r.quota for r in quotas_of(labels, "label").collect()} == {"negative": 72, "neutral": 124, "positive": 16}


def test_report_from_confusion_matrix(spark):
    matrix = {"negative": (36, 23, 13), "neutral": (37, 66, 21), "positive": (5, 5, 6)}
    cells = spark.createDataFrame(
        [(a, p, n) for a, row in matrix.items() for p, n in zip(K.LABELS, row)], "actual string, predicted string, count long"
    )
    report = {r["class"]: r for r in M.class_report(cells).collect()}
    assert (report["negative"].precision, report["negative"].recall, report["negative"].f1) == (0.4615, 0.5, 0.48)
    assert (report["neutral"].precision, report["neutral"].recall, report["neutral"].f1) == (0.7021, 0.5323, 0.6055)
    assert (report["positive"].precision, report["positive"].recall, report["positive"].f1) == (0.15, 0.375, 0.2143)
    assert (report["macro avg"].f1, report["macro avg"].support) == (0.4333, 212)


def test_majority_baseline(spark):
    labels = repeated(spark, {"negative": 357, "neutral": 620, "positive": 79})
    row = M.majority_baseline(labels, "label", K.LABELS).first()
    assert (row.accuracy, round(row.macro_f1, 3)) == (0.5871, 0.247)


def test_t_distribution(spark):
    p = spark.range(1).select(*[t_two_sided(F.lit(t), 4) for t in (-2.0831, -3.7363)]).first()
    assert [round(x, 4) for x in p] == [0.1057, 0.0202]
    odd = spark.range(1).select(t_two_sided(F.lit(3.0), 3), t_two_sided(F.lit(1.0), 1)).first()
    assert odd[0] == pytest.approx(0.0576688, abs=1e-6) and odd[1] == pytest.approx(0.5)


def test_paired_t_test_without_differences(spark):
    rows = [("m", f, r, 0.5 + f / 10) for f in range(5) for r in ("bow", "tfidf")]
    row = paired_t_test(spark.createDataFrame(rows, "classifier string, fold int, representation string, value double"), ["classifier"]).first()
    assert row.t_stat is None and row.p_value is None and row.verdict == "no significant difference"


def test_alignment_of_latent_topics(spark):
    table = [(18, 7, 164, 64), (90, 104, 64, 7), (130, 66, 19, 57), (98, 78, 16, 74)]
    cells = spark.createDataFrame(
        [(t, i, n) for t, row in zip(TOPICS, table) for i, n in enumerate(row)], "actual_topic string, latent_topic int, count long"
    )
    assert alignment(cells).first()[0] == 0.447
