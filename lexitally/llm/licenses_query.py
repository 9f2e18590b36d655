"""op2: licence scan of all documents."""

from lexitally.llm.licenses import PERCENT, TEMPLATES, normal_bigrams, scan, size_bounds
from lexitally.llm.registry import query
from lexitally.sources.io import read_table


def _values():
    rows = []
    for i, (name, text) in enumerate(TEMPLATES):
        grams = normal_bigrams(text)
        low, high = size_bounds(len(grams))
        rows.append(f"({i}, '{name}', {low}, {high}, {len(grams)}, [" + ", ".join(f"'{g}'" for g in grams) + "])")
    return ", ".join(rows)


SQL = rf"""
WITH t(i, name, low, high, size, grams) AS (VALUES {_values()}),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
u AS (SELECT r, unnest(list_prepend(text, string_split(text, chr(10)))) AS x, unnest(range(0, len(string_split(text, chr(10))) + 1)) AS unit FROM d WHERE text IS NOT NULL),
w AS (SELECT r, unit, list_filter(string_split(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda y: y <> '') AS w FROM u),
g AS (SELECT r, unit, list_distinct(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) AS g FROM w WHERE len(w) > 1),
c AS (SELECT r, unit, name, len(list_intersect(g.g, t.grams)) AS common, len(g.g) + size AS total FROM g JOIN t ON len(g.g) BETWEEN low AND high),
m AS (SELECT *, 2.0::DOUBLE * common / total AS dice FROM c WHERE 200 * common >= {PERCENT} * total),
b AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, unit, name) AS k, count(DISTINCT unit) OVER (PARTITION BY r) AS n FROM m)
SELECT doc_id, coalesce(len(string_split(text, chr(10))) + 1, 0)::BIGINT AS n_units, coalesce(n, 0)::BIGINT AS n_matches,
  name AS license, dice, unit::BIGINT AS unit
FROM d LEFT JOIN (SELECT * FROM b WHERE k = 1) USING (r)"""


@query("op2_license_scan", SQL)
def op2(spark, sf):
    return scan(read_table(spark, sf, "documents")).select("row.doc_id", "n_units", "n_matches", "license", "dice", "unit")
