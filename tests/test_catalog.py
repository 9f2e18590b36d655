"""A cross-section of the named queries against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "A1_A2_csv_round_trip", "A4_contract_report", "E5_F7_quarterly_share_of_topic", "E7_monthly_trend", "E14_plurality_vote",
    "E16_cohen_kappa", "E22_B15_target_options", "H1_stratified_split", "H23_chi_square", "B1_collector_cleaner",
    "B2_corpus_cleaner", "B7_topic_relevance", "C1_dedup_posts", "C1_dedup_repeated_posts", "F5_filtered_bigrams", "F5_filtered_bigrams_by_class",
    "H7_forest_properties", "H19_lda_mixes", "H20_nmf_properties", "H21_dominant_topic", "H22_alignment", "B19_valid_label_filter", "E7_quarterly_trend", "C3_capped_collection", "C5_dense_id", "D2_adjudication",
    "G2_topic_term_stats", "G6_topic_vs_rest_tfidf", "G8_bigram_frequency", "G18_D5_term_scores", "G20_D7_best_topic_scores",
    "H5_weighted_naive_bayes", "H6_nearest_neighbours", "H9_class_report", "H17_F3_discriminative_unigrams",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def ordered(rows):
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, tables, name):
    found = entry_points.queries()[name](spark, FOLDER)
    result = tables.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert ordered(found.select(*[f"`{c}`" for c in columns]).collect()) == ordered(result.fetchall())


def test_every_check_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 5 and all(r.total == r.F + r.O + r.P for r in rows)
