import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexitally.llm import suffix_sort
from lexitally.llm.suffix_repeats import Anchors, remove_repeats
from lexitally.llm.suffix_sort import sorted_suffixes


def plain(texts, length):
    """Per text: the bytes that stay and the runs removed."""
    texts = [(t or "").encode() for t in texts]
    seen = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            seen.setdefault(t[s : s + length], []).append((i, s))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s : s + length] = b"\1" * length
    out = []
    for t, g in zip(texts, gone):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(g), np.uint8), [0]]).astype(int)))
        out.append((bytes(c for c, x in zip(t, g) if not x), len(t), list(zip(edge[::2].tolist(), edge[1::2].tolist()))))
    return out


def random_texts(n, passages, size, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randrange(size // 4, size)) for _ in range(passages)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            whole = rng.choice(shared)
            cut = rng.randrange(len(whole)) if rng.random() < 0.5 else 0
            parts += [text(rng.randrange(size // 4)), whole[cut : cut + rng.randrange(1, 2 * len(whole))]]
        texts.append("\n".join(parts))
    return texts + ["x" * 3 * size, "ab" * 2 * size, None, "", texts[0], texts[0], "hot passage " * 3 + texts[1]]


@pytest.mark.parametrize("group", [20_000, 3])
@pytest.mark.parametrize("length, core, n, size", [(24, 8, 150, 16), (200, 64, 100, 120)])
def test_matches_brute_force(spark, length, core, n, size, group):
    texts = random_texts(n, 6, size, 7)
    # One core with very many different zones, and repeated rows.
    rng = random.Random(9)
    filler = lambda: "".join(rng.choice("pqrs ") for _ in range(length))
    texts += [filler()[: rng.randrange(length)] + "k" * (core // 2) + "-the same core in all of them, followed by others-"[:length // 2] * (1 + length // 80) + filler() for _ in range(40)]
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(5, texts[5])]
    texts.append(texts[5])
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "place", "spans", "id", "kept")}).repartition(3)
    found = remove_repeats(docs, length=length, core=core, group=group)
    got = sorted((r.doc_id or -1, bytes(r.kept), r.n_bytes, [tuple(s) for s in r.removed]) for r in found.collect())
    want = sorted((i or -1, *x) for (i, _), x in zip(rows, plain(texts, length)))
    assert got == want
    assert sum(bool(x[3]) for x in want) > 20 and sum(not x[3] for x in want) > 10


def test_pieces_change_nothing():
    texts = [t.encode() for t in random_texts(40, 5, 200, 3) if t]
    windows = lambda found: {(i, p - o, p) for i, p, lo, hi, *_ in found for o in range(lo, hi + 1)}
    whole = windows(Anchors()(texts))
    assert whole == windows(Anchors(piece=333)(texts))
    assert len(whole) == len({w[:2] for w in whole}) == sum(max(0, len(t) - 199) for t in texts)


def test_suffixes_are_sorted_and_collisions_found(monkeypatch):
    rng = np.random.default_rng(2)
    rows = rng.integers(97, 99, (400, 12)).astype(np.uint8)
    sizes = rng.integers(0, 13, 400)
    rows[np.arange(12) >= sizes[:, None]] = 0
    groups = np.sort(rng.integers(0, 30, 400))
    text = lambda i: rows[i, : sizes[i]].tobytes()
    real, bases = suffix_sort.prefix_hashes, []

    def poor(rows, seed):
        bases.append(seed)
        return real(rows, seed) & np.uint64(7) if seed < 2 else real(rows, seed)

    monkeypatch.setattr(suffix_sort, "prefix_hashes", poor)
    order, shared = sorted_suffixes(rows, sizes, groups)
    assert bases == [0, 1, 2]
    assert [(groups[i], text(i)) for i in order] == sorted((groups[i], text(i)) for i in range(400))
    for at in range(400):
        if at and groups[at] == groups[at - 1]:
            a, b = text(order[at - 1]), text(order[at])
            assert shared[at] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        else:
            assert shared[at] == -1


def test_odd_and_empty_tables(spark, odd, empty):
    assert remove_repeats(empty).count() == 0
    rows = odd.collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.kept), r.n_bytes, [tuple(s) for s in r.removed]) for r in remove_repeats(odd).collect())
    assert got == sorted((r.doc_id if r.doc_id is not None else -1, *x) for r, x in zip(rows, plain([r.text for r in rows], 200)))
