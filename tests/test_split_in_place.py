"""Splits leave documents where they are."""

from collections import Counter

from lexitally.operators.split import ranked_within, stratified_split
from lexitally.operators.split import test_quotas as quotas_of


def test_a_split_shuffles_no_documents(spark):
    docs = spark.createDataFrame([(i, "abc"[i % 3], "x" * 50) for i in range(300)], "post_id long, topic string, text string").repartition(3)
    parted = stratified_split(docs, "post_id", "topic")
    plan = parted._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan
    assert Counter((r["topic"], r["split"]) for r in parted.collect()) == {(t, s): n for t in "abc" for s, n in (("test", 20), ("train", 80))}
    assert parted.columns == ["topic", "post_id", "text", "split"]


def test_a_split_is_by_rank_also_where_ids_repeat_or_lack(spark):
    rows = [(i // 7 if i % 10 else None, "ab"[i % 2], i) for i in range(700)] + [(1, None, 0)]
    docs = spark.createDataFrame(rows, "post_id long, topic string, place int")
    quota = {r["topic"]: r["quota"] for r in quotas_of(docs, "topic").collect()}
    expected = Counter((r["topic"], r["post_id"], "test" if r["_rank"] <= quota[r["topic"]] else "train") for r in ranked_within(docs, "post_id", "topic").collect())
    found = stratified_split(docs, "post_id", "topic").collect()
    assert Counter((r["topic"], r["post_id"], r["split"]) for r in found) == expected
    assert len({r["place"] for r in found}) == len(found) == 630
    some = {(r["topic"], r["post_id"]): set() for r in found}
    for r in found:
        some[r["topic"], r["post_id"]].add(r["split"])
    assert any(len(kinds) == 2 for kinds in some.values())  # an id's rows are torn at the edge
