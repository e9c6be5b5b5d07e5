"""What queries of this package return, in DuckDB's SQL."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op12_skyband"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), t AS (SELECT rid, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (sum(lang_n) OVER g + 5 * count(*) OVER g) AS q
  FROM cells WINDOW g AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM numbered WHERE part = 'pair' OR rank <= 50
"""

# The inner reductions are crc32, bit by bit; 3988292384 is its polynomial.
ORACLE["op11_prefix_trie"] = r"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT c, c - c % 100 AS family, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(8)),
        lambda rest, i: CASE WHEN rest & 1 = 1 THEN xor(rest >> 1, 3988292384::BIGINT) ELSE rest >> 1 END)
    ), 4294967295::BIGINT) % 6 AS head
  FROM (SELECT DISTINCT c FROM own)
), parts AS (
  SELECT ids.c, 0 AS part, pos, role, text FROM ids JOIN own ON own.c = ids.family AND pos <= head
  UNION ALL
  SELECT ids.c, 1, pos, role, text FROM ids JOIN own ON own.c = ids.c AND pos > head
), turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, length(text) AS len,
    sha256(length(role) || ':' || role || text) AS mark
  FROM parts
), paths AS (
  SELECT c, d, len, list(mark) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM turns
  UNION ALL SELECT c, 0, 0, [] FROM ids
), ends AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
nodes AS (
  SELECT path, p.d, any_value(len) AS len, count(*) AS n, min(p.c) AS conv_id,
    sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE e.d = p.d), '')) AS ends_sha256
  FROM paths p JOIN ends e ON p.c = e.c GROUP BY path, p.d
), families AS (
  SELECT a.path, a.d, count(b.path) AS n_children
  FROM nodes a LEFT JOIN nodes b ON b.d = a.d + 1 AND list_slice(b.path, 1, b.d - 1) = a.path GROUP BY a.path, a.d
), sums AS (
  SELECT a.path, a.d, sum((b.n - 1) * b.len) AS saved_tokens, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves
  FROM nodes a JOIN nodes b ON b.d >= a.d AND list_slice(b.path, 1, a.d) = a.path
  JOIN families f ON f.path = b.path AND f.d = b.d GROUP BY a.path, a.d
)
SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM nodes v JOIN families f ON f.path = v.path AND f.d = v.d JOIN sums s ON s.path = v.path AND s.d = v.d
LEFT JOIN nodes up ON up.d = v.d - 1 AND up.path = list_slice(v.path, 1, v.d - 1)
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op9_oddsketch"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) >= 3
      THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(list_slice(words, i, i + 2), ' '))
      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] END) AS s
  FROM w
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, l.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON reach.b = l.a
), component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN component c ON c.doc_id = d.doc_id
"""

ORACLE["op2_warc"] = r"""
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest AS digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to,
  url, 1 AS n_metadata
FROM p LEFT JOIN firsts ON digest = payload_digest
"""
