import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lexitally.llm.prefix_trie import CELLS, NODES, conversation_trie, with_shared_head

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, heads):
    convs = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    if heads:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        convs = {c: tuple(convs.get(c - c % 20, ())[: h[c]]) + tuple(turns[h[c] :]) for c, turns in convs.items()}
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        leaf = lambda n: not any(len(m) == len(n) + 1 and m[:-1] == n for m in nodes)
        words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(node))
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), sum(len(n) == len(node) + 1 for n in below),
            sum(map(leaf, below)), sum((len(nodes[n]) - 1) * words(n) for n in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(3)
    texts = ["a b", "a", "", None, "x y z\tw", "long " * 500]
    rows = []
    for c in range(0, 120):
        if c % 7 == 3:
            continue
        turns = [("user" if i % 2 else None, rng.choice(texts) if c % 3 else "same words here") for i in range(rng.randrange(1, 7))]
        rows += [(c, rng.choice([i, i, None]) if c % 5 == 0 else i, *t) for i, t in enumerate(turns)]
    rows += [(c, 0, "user", "hot") for c in range(400, 440)]  # a group of copies
    rows += [(7, i // 2, "user", "a b") for i in range(300)]  # one very long conversation, with ties and repeated rows
    rows += [(None, 1, "user", "no conversation"), (-21, 0, "u", "neg"), (2**40, None, None, None), (2**40, None, None, None)]
    return rows


@pytest.mark.parametrize("cells", [CELLS, 1], ids=["sketch", "full sketch"])
@pytest.mark.parametrize("heads", [True, False])
def test_matches_brute_force(spark, heads, cells):
    rows = conversations()
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("place", "part", "a", "words", "depth")}).repartition(5)
    found = conversation_trie(table, with_shared_head if heads else None, cells=cells)
    assert found.columns == NODES
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, heads)


@pytest.mark.parametrize("rows", [[], [(20, 0, "user", "only one")], [(1, 0, "u", "cut away"), (2, 0, "u", "x")]])
def test_small_tables(spark, rows):
    found = conversation_trie(spark.createDataFrame(rows, SCHEMA), with_shared_head)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, True)
