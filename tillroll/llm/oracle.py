"""DuckDB SQL for the llm queries that SQL can express.

Whole tables, no subsets. Queries without an entry here are tested against a
brute-force version in ``tests/llm``.
"""

from __future__ import annotations

EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER best::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 20
"""

MIXING = r"""
WITH sizes AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS order_key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM per),
weighed AS (
  SELECT *, [5, 2, 1][source_rank % 3 + 1] AS weight, source_size * 2 AS cap FROM ranked),
levels AS (
  SELECT *,
         coalesce(sum(cap) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
         sum(weight) OVER (lv ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open_weight,
         sum(source_size) OVER ()::DOUBLE AS total
  FROM weighed WINDOW lv AS (ORDER BY cap::DOUBLE / weight, source_rank)),
level AS (
  SELECT first((total * 1.5::DOUBLE - capped) / open_weight ORDER BY cap::DOUBLE / weight, source_rank)
         FILTER ((total * 1.5::DOUBLE - capped) / open_weight < cap::DOUBLE / weight) AS level FROM levels),
targets AS (
  SELECT source, source_size, source_rank,
         least(coalesce(level * weight::DOUBLE, cap::DOUBLE), cap::DOUBLE) AS target
  FROM levels CROSS JOIN level),
placed AS (
  SELECT doc_id, size, source_size, source_rank, target,
         (sum(size) OVER (PARTITION BY s.source ORDER BY order_key, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS o,
         floor(target + 0.5::DOUBLE)::BIGINT AS words
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
parts AS (
  SELECT *, greatest(0, least(size, words - o)) AS p0,
         greatest(0, least(size, words - o - source_size)) AS p1,
         o::DOUBLE / nullif(target, 0) AS d0, (o + source_size)::DOUBLE / nullif(target, 0) AS d1
  FROM placed)
SELECT doc_id, size, source_size, target, (p0 + p1)::BIGINT AS taken,
       CASE WHEN p0 > 0 THEN CASE source_rank % 3
         WHEN 0 THEN d0 * 2 / (sqrt(2.25::DOUBLE - 2 * d0) + 1.5::DOUBLE)
         WHEN 1 THEN d0 ELSE d0 * 2 / (sqrt(0.25::DOUBLE + 2 * d0) + 0.5::DOUBLE) END END AS first_at,
       CASE WHEN p1 > 0 THEN CASE source_rank % 3
         WHEN 0 THEN d1 * 2 / (sqrt(2.25::DOUBLE - 2 * d1) + 1.5::DOUBLE)
         WHEN 1 THEN d1 ELSE d1 * 2 / (sqrt(0.25::DOUBLE + 2 * d1) + 0.5::DOUBLE) END END AS second_at
FROM parts
"""

MERKLE = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
         coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
         text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
           CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
hashed AS (
  SELECT doc_id, lang,
         sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(low)) || ':' || low, '-')) AS low_leaf,
         xor(list_reduce(list_prepend(4294967295, list_transform(
           string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) % 3 = 0 AS hit
  FROM fields CROSS JOIN crc_table),
leaves AS (
  SELECT doc_id, lang, leaf, CASE WHEN hit THEN low_leaf ELSE leaf END AS seen,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, any_value(level) + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, pos // 8),
subroots AS (
  SELECT lang, level AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
         count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY pos // 8),
runs AS (
  SELECT lang, level, pos // 8 AS run, list(digest ORDER BY pos) AS members
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 8),
top_runs AS (
  SELECT level, pos // 8 AS run, list(digest ORDER BY pos) AS members FROM tops WHERE n > 1 GROUP BY level, pos // 8),
start AS (
  SELECT row_number() OVER () AS row_no, l.doc_id, l.leaf, l.seen, l.lang, l.pos, s.subroot, s.height, s.pos AS top_pos
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang),
inside AS (
  SELECT row_no, 0 AS level, pos, seen AS node, '' AS proof FROM start
  UNION ALL
  SELECT i.row_no, i.level + 1, i.pos // 8,
         sha256(array_to_string(r.members[:i.pos % 8], '') || i.node || array_to_string(r.members[i.pos % 8 + 2:], '')),
         i.proof || array_to_string(r.members[:i.pos % 8], '') || array_to_string(r.members[i.pos % 8 + 2:], '')
  FROM inside i JOIN start s ON i.row_no = s.row_no
  JOIN runs r ON r.lang IS NOT DISTINCT FROM s.lang AND r.level = i.level AND r.run = i.pos // 8),
above AS (
  SELECT i.row_no, 0 AS level, s.top_pos AS pos, i.node, i.proof
  FROM inside i JOIN start s ON i.row_no = s.row_no AND i.level = s.height
  UNION ALL
  SELECT a.row_no, a.level + 1, a.pos // 8,
         sha256(array_to_string(r.members[:a.pos % 8], '') || a.node || array_to_string(r.members[a.pos % 8 + 2:], '')),
         a.proof || array_to_string(r.members[:a.pos % 8], '') || array_to_string(r.members[a.pos % 8 + 2:], '')
  FROM above a JOIN top_runs r ON r.level = a.level AND r.run = a.pos // 8),
root AS (SELECT level AS height, digest AS root FROM tops WHERE n = 1)
SELECT s.doc_id, s.leaf, s.subroot, r.root, sha256(a.proof) AS proof_sha256, a.node AS folded_root,
       a.node = r.root AS verified
FROM start s JOIN above a ON a.row_no = s.row_no JOIN root r ON a.level = r.height
"""

LINE_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT row_no, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT row_no) >= 3),
verdicts AS (
  SELECT k.*, s.key IS NULL OR k.doc_id IS NOT DISTINCT FROM s.top AS stays FROM k LEFT JOIN shared s ON k.key = s.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM verdicts GROUP BY row_no
"""

CONVERSATION_TRIE = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
           CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
turns AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'said': said, 'chars': chars} ORDER BY turn NULLS FIRST, sha256(said)) AS s
  FROM turns GROUP BY conv_id),
leads AS (
  SELECT conv_id, s, conv_id - conv_id % 100 AS first_id,
         xor(list_reduce(list_prepend(4294967295, list_transform(
           string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) % 6 AS h
  FROM own CROSS JOIN crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) AS s
  FROM leads c LEFT JOIN own b ON b.conv_id = c.first_id),
prefixes AS (
  SELECT conv_id, len(s) AS length, unnest(range(len(s) + 1)) AS depth, s FROM rebuilt),
nodes AS (
  SELECT depth, s[1:depth] AS path, min(conv_id) AS low, count(*) AS n,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '') AS ends,
         any_value(CASE WHEN depth > 0 THEN s[depth].chars ELSE 0 END) AS chars
  FROM prefixes GROUP BY depth, s[1:depth]),
kids AS (
  SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0
  GROUP BY depth - 1, path[1:depth - 1]),
told AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children
  FROM nodes n LEFT JOIN kids k ON n.depth = k.depth AND n.path = k.path),
up AS (
  SELECT unnest(range(depth + 1)) AS top, * FROM told),
trees AS (
  SELECT top AS depth, path[1:top] AS path, count(*) FILTER (n_children = 0) AS n_leaves,
         sum((n - 1) * chars)::BIGINT AS saved_tokens
  FROM up GROUP BY top, path[1:top])
SELECT t.low AS conv_id, t.depth, p.low AS parent_conv_id, t.n AS n_convs, t.n_children, r.n_leaves,
       r.saved_tokens, sha256(t.ends) AS ends_sha256
FROM told t JOIN trees r ON r.depth = t.depth AND r.path = t.path
LEFT JOIN nodes p ON p.depth = t.depth - 1 AND p.path = t.path[1:t.depth - 1] AND t.depth > 0
"""


def registry() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT_DEDUP, "op2_top_k": TOP_K, "op6_mixing": MIXING,
            "op11_merkle_manifest": MERKLE, "op12_conversation_trie": CONVERSATION_TRIE,
            "op13_line_dedup": LINE_DEDUP}
