"""DuckDB SQL of the operator queries that SQL can express."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

# Shingles come as lists of words; a text of one or two words is one shingle.
OP2 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s FROM w
),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
    AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.s
"""

SQL = {"op2_ngram_jaccard_join": OP2}

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>!]')) AS marks FROM documents
),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2 * source_size AS cap,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight FROM s
),
r AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate, row_number() OVER o AS pos
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)
),
f AS (SELECT *, (SELECT arg_min(rate, pos) FROM r x WHERE x.rate * x.weight <= x.cap) AS level FROM r),
t AS (
  SELECT source, source_size, coalesce(least(level * weight, cap::DOUBLE), cap::DOUBLE) AS target FROM f
),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
k AS (
  SELECT d.*, e.source_size, e.target, e.epochs, coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || coalesce(d.source, '') AS name
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
),
o AS (
  SELECT *, -ln((CAST('0x' || substr(md5('mix:' || name), 1, 12) AS BIGINT)::DOUBLE + 0.5) / 281474976710656.0::DOUBLE)
    / (1.0::DOUBLE / (1 + marks::DOUBLE / greatest(1, size))) AS key FROM k
),
p AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, name, size) AS through FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN size > 0 AND through - size / 2.0::DOUBLE < target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

SQL["op1_weighted_mix"] = OP1

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS original FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)
"""

# A prefix is told by its text: turns with their lengths, so that different cuts differ.
OP4 = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place, role, text
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
),
p AS (
  SELECT *, string_agg(md5(coalesce(role, '') || chr(31) || coalesce(text, '')), '') OVER (PARTITION BY conv_id ORDER BY place) AS path FROM t
),
e AS (SELECT conv_id, max(place) AS n, arg_max(path, place) AS path FROM p GROUP BY conv_id),
k AS (
  SELECT min(conv_id) AS conv_id FROM e WHERE path NOT IN (SELECT p.path FROM p JOIN e x USING (conv_id) WHERE p.place < x.n) GROUP BY path
)
SELECT conv_id, count(*) AS n_turns,
  string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
FROM t JOIN k USING (conv_id) GROUP BY conv_id
"""

SQL |= {"op3_warc_revisits": OP3, "op4_chat_snapshots": OP4}


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce({byte}, lambda c, b: {step}, 4294967295), 4294967295)"


# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. A row is reached by up to two inserts.
OP12 = rf"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k
  FROM conversations
),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE k <> 0
),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM d
),
f AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, CASE WHEN trimmed = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM o
),
g AS (
  SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
),
inserts(q, p, audit, lines) AS (VALUES
  (0, 0, '', ''), (0, 2, 'I', chr(10) || 'user:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, '', ''), (2, 3, 'I', chr(10) || 'assistant:'), (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:')
),
edits(p, edit, initial, q, role) AS (VALUES
  (0, 'K', 's', 1, ''), (0, 'K', 'u', 2, ''), (1, 'K', 'u', 2, ''), (2, 'K', 'a', 3, ''), (3, 'K', 'u', 2, ''),
  (0, 'R', '', 2, 'user'), (1, 'R', '', 2, 'user'), (2, 'R', '', 3, 'assistant'), (3, 'R', '', 2, 'user'),
  (0, 'D', '', 0, ''), (1, 'D', '', 1, ''), (2, 'D', '', 2, ''), (3, 'D', '', 3, '')
),
walk(conv_id, i, q, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''}} FROM g
  UNION ALL
  SELECT w.conv_id, f.i, e.q, min({{
    'cost': w.best.cost + 3 * length(s.audit) + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
      + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
    'audit': w.best.audit || s.audit || e.edit,
    'lines': w.best.lines || s.lines || CASE WHEN e.edit = 'D' THEN '' WHEN e.edit = 'R' THEN chr(10) || e.role || ':' || f.text
      ELSE chr(10) || f.role || ':' || f.text END}})
  FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN inserts s ON s.q = w.q JOIN edits e ON e.p = s.p
  WHERE e.edit = 'D' OR f.fault IN ('', 'truncated') AND (e.edit = 'R' OR e.initial = f.initial)
  GROUP BY w.conv_id, f.i, e.q
),
done AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + 3 * length(s.audit), 'audit': w.best.audit || s.audit, 'lines': w.best.lines || s.lines}}) AS best
  FROM walk w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.n = w.i
    JOIN inserts s ON s.q = w.q AND (s.p = 3 OR s.p = 0 AND s.q = 0)
  GROUP BY w.conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
  coalesce(best.audit, '') AS audit, sha256(substr(coalesce(best.lines, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id
  LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM a.conv_id
"""

SQL["op12_structure_repair"] = OP12

# A node is told by the hashes of its turns in a row; a subtree holds the nodes whose path starts with its own.
OP13 = rf"""
WITH t AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS d
  FROM conversations
),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, coalesce({_crc32("CAST(conv_id AS VARCHAR)")} % 4, 0) AS h FROM conversations GROUP BY conv_id),
lead AS (SELECT c.conv_id, t.said, t.words, t.d FROM c JOIN t ON t.conv_id = c.base AND t.d <= c.h),
own AS (
  SELECT t.conv_id, t.said, t.words, t.d - c.h + (SELECT count(*) FROM lead WHERE lead.conv_id = c.conv_id) AS d
  FROM t JOIN c ON t.conv_id IS NOT DISTINCT FROM c.conv_id WHERE t.d > c.h
),
r AS (SELECT * FROM lead UNION ALL SELECT * FROM own),
p AS (
  SELECT conv_id, d, words, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, d = max(d) OVER (PARTITION BY conv_id) AS last FROM r
  UNION ALL
  SELECT c.conv_id, 0, 0, '', NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id IS NOT DISTINCT FROM c.conv_id) FROM c
),
n AS (
  SELECT path, min(conv_id) AS conv_id, max(d) AS depth, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM p GROUP BY path
),
k AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM n WHERE path <> '' GROUP BY ALL),
a AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
up AS (SELECT a.*, unnest([left(path, 32 * i) FOR i IN range(0, CAST(length(path) / 32 AS BIGINT) + 1)]) AS above FROM a),
s AS (
  SELECT above AS path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens FROM up GROUP BY above
)
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.n_leaves, s.saved_tokens, a.ends_sha256
FROM a JOIN s USING (path) LEFT JOIN n b ON a.path <> '' AND b.path = left(a.path, length(a.path) - 32)
"""

SQL["op13_prefix_trie"] = OP13
