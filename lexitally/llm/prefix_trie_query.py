"""op12: the prefix tree of all conversations, each rebuilt with a head that others share."""

from lexitally.llm.prefix_trie import conversation_trie, with_shared_head
from lexitally.llm.registry import query
from lexitally.sources.io import read_table

#: crc32 of a decimal number in SQL: a table of 256 entries made by rule, then one step a digit.
CRC = """
bits AS (SELECT n, n AS c, 0 AS k FROM range(256) t(n) UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT n, c FROM bits WHERE k = 8),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crcs AS (SELECT conv_id, 0 AS k, 4294967295::BIGINT AS c FROM ids UNION ALL
  SELECT r.conv_id, r.k + 1, xor(r.c // 256, s.c) FROM crcs r JOIN steps s ON s.n = xor(r.c % 256, ascii(substr(r.conv_id::VARCHAR, r.k + 1, 1)))
  WHERE r.k < length(r.conv_id::VARCHAR)),
hs AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM crcs WHERE k = length(conv_id::VARCHAR))"""

SQL = f"""
WITH RECURSIVE {CRC},
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
  {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS m FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(m ORDER BY i) AS ms FROM t GROUP BY 1),
r AS (SELECT l.conv_id, list_concat(coalesce(b.ms, [])[1:h], l.ms[h + 1:]) AS ms
  FROM l JOIN hs USING (conv_id) LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 20),
p AS (SELECT conv_id, ms[1:d] AS prefix, d, ms[1:d - 1] AS upper, len(ms) AS size FROM (SELECT *, unnest(range(len(ms) + 1)) AS d FROM r)),
g AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(upper) AS upper,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256,
  CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(list_filter(regexp_split_to_array(any_value(prefix)[-1].text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) END AS saved
  FROM p GROUP BY prefix, d),
c AS (SELECT upper, count(*) AS n_children FROM g WHERE d > 0 GROUP BY upper),
n AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN c ON c.upper = g.prefix),
s AS (SELECT prefix[1:e] AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM n) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.top = n.prefix LEFT JOIN g u ON n.d > 0 AND u.prefix = n.upper"""


@query("op12_prefix_trie", SQL)
def op12(spark, sf):
    return conversation_trie(read_table(spark, sf, "conversations"), with_shared_head)
