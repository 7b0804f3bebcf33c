"""DuckDB statements for the queries that SQL can state over whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH RECURSIVE worded AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM worded
),
sizes AS (SELECT doc_id, COUNT(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS class FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, COALESCE((SELECT n FROM sizes s WHERE s.doc_id = d.doc_id), 0) AS n_shingles,
       LEAST(d.doc_id, COALESCE((SELECT MIN(other) FROM reach r WHERE r.node = d.doc_id), d.doc_id)) AS component_id,
       -- links are those between different sets: copies are one class
       (SELECT COUNT(DISTINCT y.class) FROM links l JOIN sizes x ON x.doc_id = l.a JOIN sizes y ON y.doc_id = l.b AND y.class <> x.class WHERE l.a = d.doc_id) AS n_links
FROM documents d"""

OP9 = f"""
WITH worded AS (SELECT doc_id, {_WORDS.format(text="COALESCE(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM worded WHERE len(w) >= 20)
),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
kept AS (
  SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS text, COUNT(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM worded) t
  WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = t.doc_id AND c.i = t.i) GROUP BY t.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - COALESCE(k.n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(k.text, '')) AS kept_sha256
FROM worded w LEFT JOIN kept k USING (doc_id)"""

# CRC-32 by its polynomial, eight shifts a byte; fixed values: the polynomial and the start value
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

OP11 = f"""
WITH own AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS root, {_CRC32.format(text="CAST(conv_id AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
parts AS (
  SELECT c.conv_id, 0 AS part, o.i, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.root AND o.i <= c.h
  UNION ALL SELECT c.conv_id, 1, o.i, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h
),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS depth FROM parts),
hashed AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
         md5(string_agg(sha256(role || chr(1) || text), ',') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS k
  FROM turns
),
paths AS (
  SELECT conv_id, depth, k, COALESCE(LAG(k) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent, bytes FROM hashed
  UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM convs
),
nodes AS (
  SELECT depth, k, any_value(parent) AS parent, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, (COUNT(*) - 1) * any_value(bytes) AS saves
  FROM paths GROUP BY depth, k
),
kids AS (SELECT depth - 1 AS depth, parent AS k, COUNT(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT DISTINCT a.depth, a.k, b.depth AS d2, b.k AS k2 FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth
),
subtrees AS (
  SELECT b.depth, b.k, SUM(n.saves) AS saved, COUNT(*) FILTER (WHERE c.n IS NULL) AS n_leaves
  FROM below b JOIN nodes n ON n.depth = b.d2 AND n.k = b.k2 LEFT JOIN kids c ON c.depth = n.depth AND c.k = n.k GROUP BY ALL
),
ends AS (
  SELECT depth, k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, depth, k, row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) AS n FROM paths) WHERE n = 1 GROUP BY ALL
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, COALESCE(c.n, 0) AS n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(COALESCE(e.ids, '')) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.depth = n.depth AND s.k = n.k
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.k = n.parent LEFT JOIN kids c ON c.depth = n.depth AND c.k = n.k LEFT JOIN ends e ON e.depth = n.depth AND e.k = n.k"""

OP5 = rf"""
WITH worded AS (
  SELECT doc_id, source, COALESCE(text, '') AS text, {_WORDS.format(text="COALESCE(text, '')")} AS w,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
),
triples AS (
  SELECT doc_id, i, array_to_string(w[i:i+2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 4)
),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, k) AS n FROM triples) WHERE n > 1),
repeated AS (SELECT doc_id, COUNT(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS i FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, w, len({_WORDS.format(text="line")}) AS n_words,
         translate(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')), '123456789', '000000000') AS line
  FROM (SELECT doc_id, source, array_to_string(w, ' ') AS w, unnest(l) AS line FROM worded)
),
hosts AS (SELECT source, COUNT(*) AS docs FROM (SELECT DISTINCT source, array_to_string(w, ' ') AS w FROM worded) GROUP BY source),
counts AS (SELECT source, line, COUNT(*) AS n FROM (SELECT DISTINCT source, w, line FROM lines) GROUP BY source, line),
limits AS (
  SELECT c.source, c.line FROM counts c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE n > 25 AND n > docs * CAST(0.01 AS DOUBLE)
),
lost AS (SELECT doc_id, SUM(n_words) AS n FROM lines x JOIN limits y ON x.source IS NOT DISTINCT FROM y.source AND x.line = y.line GROUP BY doc_id),
base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, COALESCE(r.n, 0) AS n_repeat_words,
         CAST(len(w) - COALESCE(x.n, 0) AS BIGINT) AS n_left
  FROM worded d LEFT JOIN repeated r ON r.doc_id = d.doc_id LEFT JOIN lost x ON x.doc_id = d.doc_id
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_left >= n_words * CAST(0.5 AS DOUBLE) AS kept
FROM base"""

ORACLE: dict[str, str] = {"op2_ngram_jaccard": OP2, "op5_line_quality": OP5, "op9_anchor_repeats": OP9, "op11_prefix_trie": OP11}
