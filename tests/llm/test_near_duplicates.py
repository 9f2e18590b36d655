import random
from itertools import combinations
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexitally.llm import near_duplicates as N
from lexitally.llm.components import connected_components
from lexitally.llm.text import word_bytes


def shingles(text):
    w = word_bytes(text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain(rows):
    ids = {d: shingles(t) for d, t in rows if d is not None}
    group = {d: d for d in ids}
    for a, b in combinations(ids, 2):
        x, y = ids[a], ids[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {d: low if g == high else g for d, g in group.items()}
    return {d: (len(ids[d]), g, g == d) for d, g in group.items()}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = []
    base = [word() for _ in range(120)]
    rows += [edited(base, rng.randrange(9), rng) for _ in range(70)]  # near copies, some of them only near to a few
    rows += [" ".join(base)] * 30
    passage = [word() for _ in range(30)]
    rows += [" ".join([word() for _ in range(rng.randrange(5, 40))] + passage) for _ in range(60)]
    for _ in range(20):
        own = [word() for _ in range(rng.randrange(1, 60))]
        rows += [" ".join(own), edited(own, 1, rng), " ".join(own).upper()]
    chain = [word() for _ in range(100)]
    for i in range(12):  # each near its neighbours only
        rows.append(" ".join(chain))
        chain = chain[2:] + [word() for _ in range(2)]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("block", [512, 16])
def test_matches_brute_force(spark, odd, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N.open_pairs, "__defaults__", (N.MATCHES, 2 * block))
    monkeypatch.setattr(N.checked, "__defaults__", (block,))
    docs = odd.unionByName(spark.createDataFrame(corpus(), "doc_id long, text string"), allowMissingColumns=True)
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    found = N.near_duplicates(docs.repartition(4)).collect()
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id], r.doc_id


def test_drop_keeps_one_of_each_group(spark, odd):
    docs = odd.unionByName(spark.createDataFrame(corpus()[:80], "doc_id long, text string"), allowMissingColumns=True)
    kept = N.drop_near_duplicates(docs)
    want = {d for d, (_, _, stays) in plain([(r.doc_id, r.text) for r in docs.collect()]).items() if stays}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want | {None}


def test_empty_table(empty):
    assert N.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, 1000 + i) for i in range(50)] + [(i, i + 1) for i in range(2000, 2040)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    loose = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root(x) for x in parent if x not in loose}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_signatures_agree_as_sets_do():
    rng = random.Random(3)
    family, agreed, similar = N.MinHash(64), 0, 0.0
    for _ in range(60):
        words = [str(rng.random()) for _ in range(80)]
        a, b = N.shingle_set(" ".join(words)), N.shingle_set(edited(words, 3, rng))
        similar += len(set(a) & set(b)) / len(set(a) | set(b))
        x, y = family.signatures([a, b])
        agreed += (x == y).mean()
    assert abs(agreed - similar) / 60 < 0.02


def test_candidate_tests_miss_less_than_one_in_a_million():
    agree = lambda n, k: comb(n, k) * 0.75**k * 0.25 ** (n - k)
    found = sum(
        agree(N.COORDINATES, k) * agree(N.MORE, j)
        for k in range(N.MATCHES, N.COORDINATES + 1) for j in range(max(0, N.ALL_MATCHES - k), N.MORE + 1)
    )
    assert 1 - found < 1e-6


@pytest.mark.parametrize("block", [2048, 3])
def test_blocks_of_components_find_the_links(spark, block):
    """All components are paired with each other; blocks are larger or smaller than a component."""
    rng = np.random.default_rng(1)

    def links(groups, size=6):
        base = rng.integers(1, 2**62, 60)
        sets, members = [], []
        for g in range(groups):
            own = np.concatenate([base, rng.integers(1, 2**62, 6 if g % 5 else 60)])
            for k in range(size):
                members.append((len(sets), g * 1000))
                sets.append(np.unique(np.concatenate([own, [g * 100 + k]]).astype(np.uint64)))
        pairs = [(a * 1000, b * 1000) for a in range(groups) for b in range(a)]
        want = set()
        for a, b in pairs:
            for x in (s for s, (_, c) in zip(sets, members) if c == a):
                for y in (s for s, (_, c) in zip(sets, members) if c == b):
                    common = len(np.intersect1d(x, y))
                    if 100 * common >= 75 * (len(x) + len(y) - common):
                        want.add((a, b))
        frame = N.checked_in_blocks(
            spark.createDataFrame(pairs, "g long, p long"), spark.createDataFrame(members, "cls long, comp long"),
            spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "cls long, shingles binary"), block=block)
        assert {(r.g, r.p) for r in frame.collect()} == want
        return len(want)

    assert links(5) > 0 and links(12) > 10


def test_similar_texts_without_links_make_few_rows(spark, tmp_path):
    """All are candidates for each other and none is linked: rows grow with the texts, not with their pairs."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = [(i, " ".join(base[:165] + [f"x{rng.randrange(10**6)}" for _ in range(35)])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = N.signed(docs, "doc_id", "text").withColumnRenamed("id", "cls")
    kept = iter(range(9))

    def keep(frame, name):
        path = f"{tmp_path}/{name}-{next(kept)}"
        frame.write.parquet(path)
        return spark.read.parquet(path)

    signed = keep(signed, "signed")
    found = N.open_pairs(keep(N.prefix_postings(signed, keep), "postings"), signed, spark.createDataFrame([], "cls long, comp long")).collect()
    assert not any(100 * len(shingles(a) & shingles(b)) >= 75 * len(shingles(a) | shingles(b)) for (_, a), (_, b) in combinations(rows, 2))
    assert 40 < len(found) < 4 * len(rows)


@pytest.mark.parametrize("block", [2048, 3])
def test_clusters_find_the_links(spark, tmp_path, block):
    rng = np.random.default_rng(1)
    base = rng.integers(1, 2**62, 60)
    sets, members = [], []
    for g in range(12):
        own = np.concatenate([base, rng.integers(1, 2**62, 60 if g % 3 else 6)])
        for k in range(1 + 5 * (g % 2)):
            members.append((len(sets), g * 1000))
            sets.append(np.unique(np.concatenate([own, [g * 100 + k]]).astype(np.uint64)))
    group = {g * 1000: g * 1000 for g in range(12)}
    for (a, x), (b, y) in combinations(zip((c for _, c in members), sets), 2):
        common = len(np.intersect1d(x, y))
        if 100 * common >= 75 * (len(x) + len(y) - common) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {k: low if v == high else v for k, v in group.items()}

    def keep(frame, name):
        frame.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    found = N.checked_in_clusters(
        spark.createDataFrame([(a * 1000, a * 1000 + 1000) for a in range(11)], "a long, b long"), spark.createDataFrame(members, "cls long, comp long"),
        spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "cls long, shingles binary"), keep, block).collect()
    linked = {k: k for k in group}
    for r in found:
        low, high = sorted((linked[r.g], linked[r.p]))
        linked = {k: low if v == high else v for k, v in linked.items()}
    assert linked == group and len(set(group.values())) < 12
