from collections import Counter

from lexitally.llm import quality_rules as Q


def plain(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(inside)


def test_measures_match_plain_python(odd):
    found = Q.quality_report(odd).select("row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept", "failed_rules").collect()
    assert len(found) == odd.count()
    for text, *measures, kept, broken in found:
        assert tuple(measures) == plain(text), text
        assert kept == (not broken)


def test_keep_good_keeps_columns_and_rows(spark, odd):
    good = spark.createDataFrame([(100, "The cat and the dog walked to the old house by the river in the rain.")], "doc_id long, text string")
    both = odd.unionByName(good, allowMissingColumns=True)
    kept = Q.keep_good(both)
    assert kept.columns == both.columns
    assert 100 in {r.doc_id for r in kept.collect()}
    assert not {0, 1, 4, 7} & {r.doc_id for r in kept.collect()}


def test_empty_table(empty):
    assert Q.quality_report(empty).count() == 0 and Q.keep_good(empty).count() == 0


def test_one_projection_without_user_functions(odd, capsys):
    Q.quality_report(odd).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan
