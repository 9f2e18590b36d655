"""The registered queries against their SQL, and the pipeline stage by stage, on the smallest tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_every_operator_has_one_query():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()


@pytest.mark.parametrize("name", ["op1_vafile_top_k", "op2_license_scan", "op9_quality_rules", "op12_prefix_trie", "op13_hard_negatives"])
def test_query_matches_sql(spark, name):
    tables = duckdb.connect()
    for file in os.listdir(FOLDER):
        tables.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    found = entry_points.queries()[name](spark, FOLDER)
    result = tables.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    plain = lambda rows: sorted((tuple(round(v, 9) if isinstance(v, float) and not math.isnan(v) else v for v in r) for r in rows), key=str)
    assert plain(found.select(*columns).collect()) == plain(result.fetchall())


def test_pipeline_stages(spark):
    """Every stage keeps the columns of documents and adds no row; the tokens packed are those of the documents left."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(10**6, None, "en", None, None), (10**6 + 1, "", "en", "s", 0), (None, "x " * 30, None, None, 60)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, columns = docs.count(), docs.columns
        ids = {r.doc_id for r in docs.collect()}
        out = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        assert out.columns == columns and out.count() <= before and {r.doc_id for r in out.collect()} <= ids, name
        docs = out
    from lexitally.llm.tokens import encoder
    import public_tokenizers

    encode = encoder(public_tokenizers.path("byte_bpe_50k.json")).encode
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert sum(r.length for r in packed) == sum(len(encode(r.text or "")) // 4 + 1 for r in docs.collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_takes_an_empty_table(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where(F.lit(False))
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, FOLDER).count() == 0
