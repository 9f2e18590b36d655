import random
import textwrap

from lexitally.llm import licenses as L


def plain(text):
    best = None
    n = 0
    for unit, part in enumerate([text, *text.split("\n")]) if text is not None else []:
        grams = set(L.normal_bigrams(part))
        hits = []
        for name, template in L.TEMPLATES:
            other = set(L.normal_bigrams(template))
            common = len(grams & other)
            if grams and 200 * common >= L.PERCENT * (len(grams) + len(other)):
                hits.append((-2.0 * common / (len(grams) + len(other)), unit, name))
        n += bool(hits)
        best = min([*hits, *([best] if best else [])], default=None)
    return n, *((best[2], -best[0], best[1]) if best else (None, None, None))


def test_matches_brute_force(spark, odd):
    texts = [t for _, t in L.TEMPLATES] + [
        "Prose.\nReleased under the  MIT\tlicense!\nMore prose.", "licensed under cc by nc 4 0 and more words here", "Released under the MIT",
        "\n".join(t for _, t in L.TEMPLATES[:6]), "(the) the the the",
    ]
    more = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    found = L.scan(docs).select("row.text", "n_matches", "license", "dice", "unit").collect()
    assert len(found) == docs.count()
    for text, *rest in found:
        assert tuple(rest) == plain(text), text


def test_size_bounds_lose_nothing():
    for size in range(1, 60):
        low, high = L.size_bounds(size)
        for a in range(1, 120):
            if 200 * min(a, size) >= L.PERCENT * (a + size):
                assert low <= a <= high


def test_empty_table_and_plan(odd, empty, capsys):
    assert L.scan(empty).count() == 0
    L.scan(odd).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan


def test_wrapped_notices_and_notices_within_lines(spark):
    random.seed(8)
    prose = "".join(" ".join(f"w{random.randint(0, 10**6)}" for _ in range(30)) + "\n" for _ in range(5))
    notices = [t for _, t in L.TEMPLATES]
    texts = [prose + "\n".join(textwrap.wrap(t, width, initial_indent=mark, subsequent_indent=mark, break_long_words=False, break_on_hyphens=False)) + "\n" + prose for t in notices for width, mark in ((72, "# "), (30, " * "))]
    texts += [prose.replace("\n", " ") + t + " " + prose.replace("\n", " ") for t in notices]
    want = [n for n, _ in L.TEMPLATES for _ in range(2)] + [n for n, _ in L.TEMPLATES]
    mit, gpl = notices[-3], next(t for n, t in L.TEMPLATES if n == "GPL-3.0" and "either" in t)
    texts += ["\n".join([prose, *textwrap.wrap(mit, 60), prose, "Released under the MIT License.", prose, *textwrap.wrap(gpl, 60), prose]), prose * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in L.scan(docs).select("row.doc_id", "n_matches", "license", "dice", "unit").collect()}
    for i, name in enumerate(want):
        assert (found[i].license, found[i].dice) == (name, 1.0) and found[i].n_matches >= 1, texts[i]
    assert [found[i].unit for i in range(len(notices) * 2)] == [6] * (len(notices) * 2)
    assert found[len(want)].n_matches == 3
    assert found[len(want) + 1].n_matches == 0
