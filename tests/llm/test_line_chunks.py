import random

from lexitally.llm.line_chunks import LEAST_WORDS, PASSAGE_WORDS, drop_repeated_lines, line_chunks
from lexitally.llm.line_chunks_query import op5


def plain(rows):
    """First occurrences by (id, place); rows that repeat id and text are one document."""
    seen, out = set(), {}
    for d, text in sorted({(d, t) for d, t in rows if t}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, kept, gone = text.encode().split(b"\n"), [], 0
        for start, n, words in line_chunks(lines):
            chunk = b"\n".join(lines[start : start + n])
            if words >= PASSAGE_WORDS or n > 1 and words >= LEAST_WORDS:
                if chunk in seen:
                    gone += n
                    continue
                seen.add(chunk)
            kept += lines[start : start + n]
        out[d, text] = (b"\n".join(kept).decode(), len(lines), gone)
    return out


def test_matches_brute_force(spark, odd):
    random.seed(4)
    lines = [" ".join(random.choices("abcdefgh", k=random.randint(3, 9))) for _ in range(200)]
    run = lines[:12]
    passage = " ".join(random.choices("xyzuvw", k=60))
    rows = []
    for i in range(100, 160):
        own = random.sample(lines, 8)
        if i % 3 == 0:
            own[4:4] = run
        if i % 4 == 0:
            own.insert(random.randint(0, 8), passage)
        rows.append((i, "\n".join(own)))
    rows += [rows[0], (150, rows[3][1]), (170, "\n" * 40), (171, "\n" * 40)]
    docs = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    found = drop_repeated_lines(docs).select("row.doc_id", "row.text", "text", "n_lines", "n_removed").toDF("doc_id", "before", "text", "n_lines", "n_removed").collect()
    assert len(found) == docs.count()
    for r in found:
        if r.before:
            assert (r.text, r.n_lines, r.n_removed) == want[r.doc_id, r.before], r.doc_id
        else:
            assert r.text == r.before and r.n_removed == 0
    assert sum(text.count(passage) for text in {r.doc_id: r.text for r in found if r.text}.values()) == 1  # row 100 is there twice
    assert any(r.n_removed > 8 for r in found)


def test_boundaries_resist_shifts():
    random.seed(5)
    lines = [str(random.random()).encode() for _ in range(400)]
    whole = {tuple(lines[s : s + n]) for s, n, _ in line_chunks(lines)}
    shifted = lines[:50] + [b"new"] + lines[50:]
    moved = [tuple(shifted[s : s + n]) for s, n, _ in line_chunks(shifted)]
    assert sum(c in whole for c in moved) >= len(moved) - 3


def test_empty_table(empty):
    assert drop_repeated_lines(empty).count() == 0


def test_every_repeated_passage_goes_whole(spark, tmp_path):
    random.seed(6)
    line = lambda n: " ".join(str(random.randint(0, 10**9)) for _ in range(n))
    passages = [[line(words) for _ in range(n)] for n, words in [(4, 15), (3, 20), (2, 30), (20, 15), (40, 2), (2, 25), (5, 11)] * 8]
    own, rows = {}, []
    for i, shared in enumerate(passages):
        first, second = [line(9) for _ in range(4)], [line(9) for _ in range(4)]
        rows += [(2 * i, "\n".join(first[:2] + shared + first[2:])), (2 * i + 1, "\n".join(second[:1] + shared + second[1:]))]
        own[2 * i], own[2 * i + 1] = rows[-2][1], "\n".join(second)
    loop = [line(3) for _ in range(20)]
    rows += [(900, "\n".join(loop * 3 + ["end"])), (901, "\n".join(["a b"] * 100)), (902, "\n".join(["x", *passages[3][:9], "y", *passages[3][5:], "z"]))]
    own |= {900: "\n".join([*loop, "end"]), 902: "x\ny\nz"}
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    before, found = dict(rows), {r.doc_id: r for r in op5(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for i, text in own.items():
        assert found[i].text == text, i
    for i, r in found.items():
        assert r.n_lines == before[i].count("\n") + 1 and r.n_lines - r.n_removed == r.text.count("\n") + 1
    assert 0 < found[901].text.count("a b") < 50  # one passage stays
