"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores, BENCH_SHARED_DIR the folder for stage tables (default: the warehouse
folder). With BENCH_DUCKDB=1 each query's SQL is timed too, on the same machine in the
same run, as `duckdb`. A few queries run untimed first, so that no figure holds the start
of the JVM. The stage table all text queries share is written next, under its
own name; every query then runs once into a sink that drops its rows.
"""

import json
import os
import re
import time

from catalog import ORACLE, QUERIES
from catalog.tables import features
from lexitally.session import build_session

HEADLINE = [
    "E5_F7_quarterly_share_of_topic",
    "E7_monthly_trend",
    "E14_plurality_vote",
    "H23_chi_square",
    "H1_stratified_split",
    "B1_collector_cleaner",
    "B2_corpus_cleaner",
    "C1_dedup_posts",
    "C3_capped_collection",
    "C5_dense_id",
    "G1_corpus_term_frequency",
    "G2_topic_term_stats",
    "G6_topic_vs_rest_tfidf",
    "G8_bigram_frequency",
    "G13_frequent_bigrams_by_class",
    "G18_D5_term_scores",
    "H4_naive_bayes",
    "H5_weighted_naive_bayes",
    "H6_nearest_neighbours",
    "H17_F3_discriminative_unigrams",
]

WARM_UP = ["E1_group_count", "E6_monthly_share_of_topic", "B3_entity_decode", "E24_split_feasibility"]


def _duckdb(folder, threads):
    import duckdb

    tables, found = duckdb.connect(), {}
    tables.execute(f"SET threads = {threads}")
    for file in os.listdir(folder):
        tables.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{file}')")
    for name in HEADLINE:
        start = time.perf_counter()
        tables.execute(f"CREATE OR REPLACE TEMP TABLE result AS {ORACLE[name]}")
        found[name] = round(time.perf_counter() - start, 3)
    return found


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.ui.showConsoleProgress": "false",
           **({"spark.checkpoint.dir": os.environ["BENCH_SHARED_DIR"]} if "BENCH_SHARED_DIR" in os.environ else {})},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        timings[name] = round(time.perf_counter() - start, 3)

    for name in WARM_UP:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    timed("stage_topic_features", lambda: features(spark, folder))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    other = _duckdb(folder, int(cpus)) if os.environ.get("BENCH_DUCKDB") else None
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                "queries": timings, "sf": float(scale.group(1)) if scale else None, **({"duckdb": other} if other else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
