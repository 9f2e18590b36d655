"""op9: quality rules over documents."""

from pyspark.sql import functions as F

from lexitally.llm import quality_rules as Q
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


def _sql_rules():
    parts = []
    for _, measure, low, high in Q.RULES:
        parts += [f"{measure} >= {low}"] if low is not None else []
        parts += [f"{measure} <= {high}"] if high is not None else []
    return " AND ".join(parts)


_STOP = ", ".join("'" + w + "'" for w in sorted(set(Q.STOP_WORDS)))
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT r, i, list_slice(w, i, i + 4) AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM s WHERE len(w) >= 5)),
again AS (SELECT r, i FROM win JOIN (SELECT r, k FROM win GROUP BY r, k HAVING count(*) > 1) USING (r, k)),
rep AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM again CROSS JOIN (SELECT unnest(range(0, 5)) AS o) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  len(ls) AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper,
  len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha,
  len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop
  FROM s LEFT JOIN rep USING (r)),
q AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
  CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_word_ratio,
  CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
  CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_word_ratio,
  CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END AS upper_char_ratio,
  CASE WHEN n_words > 0 THEN n_alpha / n_words ELSE 0 END AS alpha_word_ratio,
  CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_ratio FROM m),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE {_sql_rules()} END AS kept FROM f"""


@query("op9_quality_rules", SQL)
def op9(spark, sf):
    judged = Q.quality_report(read_table(spark, sf, "documents"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & F.col("kept")).alias("kept"),
    )
