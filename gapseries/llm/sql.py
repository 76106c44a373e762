"""DuckDB twins of the queries that SQL can express, over the raw tables."""

OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
last AS (SELECT payload, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY payload HAVING count(*) > 1)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN p.page_id < l.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < l.last THEN l.last END AS refers_to
FROM p LEFT JOIN last l ON p.n >= 1000 AND p.payload = l.payload"""

OP5 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len([c for c in x if c IS NULL OR NOT isfinite(c)]) = 0
         AND len([c for c in x if c <> 0]) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
         WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN deg ON deg.a = vec_id"""

OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50) t),
first AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS pos FROM win JOIN first USING (k) WHERE doc_id > least),
lost AS (SELECT doc_id, list(pos) AS lost FROM gone GROUP BY doc_id),
kept AS (SELECT d.doc_id, d.w, l.lost,
                CASE WHEN l.lost IS NULL THEN d.w ELSE [d.w[i] for i in range(1, len(d.w) + 1) if NOT list_contains(l.lost, i)] END AS k
         FROM d LEFT JOIN lost l ON l.doc_id = d.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(k) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept"""

OP9 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS k
         FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0) t),
size AS (SELECT DISTINCT n FROM item),
win AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS k
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, size WHERE len(w) >= n) t),
hit AS (SELECT win.doc_id, win.s, win.n, item.item_id FROM win JOIN item ON item.k = win.k AND item.n = win.n),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM hit) t GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

#: CRC-32 (reflected, polynomial 0xEDB88320) of the bytes in list b: the start and the steps of DuckDB's list_reduce.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(x AS BIGINT) FOR x IN {b}]),
    lambda c, x: list_reduce(list_prepend(xor(c, x), CAST(range(8) AS BIGINT[])), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))"""


def crc32(b: str) -> str:
    return f"xor({_CRC.format(b=b)}, 4294967295)"


OP12 = rf"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(content), 1, 32)) AS pos, sha256(content) AS digest,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(text, '') AS text, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS content
        FROM conversations WHERE conv_id IS NOT NULL) t),
convs AS (SELECT conv_id, {crc32("[ord(ch) FOR ch IN string_split(CAST(conv_id AS VARCHAR), '')]")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own) t),
turns AS (
  SELECT c.conv_id, o.pos, o.digest, o.words, 0 AS own FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, o.pos, o.digest, o.words, 1 FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
rebuilt AS (
  SELECT c.conv_id, coalesce(list(t.digest ORDER BY t.own, t.pos) FILTER (t.digest IS NOT NULL), []) AS seq,
         coalesce(list(t.words ORDER BY t.own, t.pos) FILTER (t.digest IS NOT NULL), []) AS words
  FROM convs c LEFT JOIN turns t ON t.conv_id = c.conv_id GROUP BY c.conv_id),
steps AS (SELECT conv_id, d AS depth, seq, array_to_string(seq[1:d], ',') AS id, CASE WHEN d > 0 THEN array_to_string(seq[1:d - 1], ',') END AS before,
                 CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(seq) AS last
          FROM (SELECT conv_id, seq, words, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt) t),
nodes AS (SELECT id, depth, any_value(before) AS before, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, any_value(seq) AS seq,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends
          FROM steps GROUP BY id, depth),
kids AS (SELECT before AS id, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY before, depth),
up AS (SELECT a AS depth, array_to_string(seq[1:a], ',') AS id, leaf, saved
       FROM (SELECT unnest(range(0, n.depth + 1)) AS a, n.seq, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, (n.n_convs - 1) * n.words AS saved
             FROM nodes n LEFT JOIN kids k ON k.id = n.id AND k.depth = n.depth) t),
totals AS (SELECT id, depth, sum(leaf) AS n_leaves, sum(saved) AS saved FROM up GROUP BY id, depth)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN totals t ON t.id = n.id AND t.depth = n.depth LEFT JOIN kids k ON k.id = n.id AND k.depth = n.depth
LEFT JOIN nodes p ON p.id = n.before AND p.depth = n.depth - 1"""

_LATIN = "[A-Za-z\u00C0-\u00FF]+"
_BYTES = "flatten([CASE WHEN ord(ch) < 128 THEN [ord(ch)] ELSE [195, ord(ch) - 64] END FOR ch IN string_split({x}, '')])"

OP11 = f"""
WITH run AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_LATIN}')) AS run
        FROM documents) t GROUP BY doc_id, run),
hashed AS (SELECT run, n, {crc32("flatten([[ord(ch) FOR ch IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':', '')], " + _BYTES.format(x="run") + "])")} AS h FROM run),
noisy AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM noisy WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
skips AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) t),
near AS (SELECT DISTINCT word, other, n FROM (
  SELECT a.word, b.word AS other, b.n FROM skips a JOIN skips b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT a.word, b.word, b.n FROM skips a JOIN words b ON a.k = b.word
  UNION ALL SELECT a.word, b.word, b.n FROM words a JOIN skips b ON a.word = b.k) t),
best AS (SELECT word, count(*) AS n_near, arg_max(other, (n, -rank)) AS other, max(n) AS n
         FROM (SELECT near.*, row_number() OVER (ORDER BY other ) AS rank FROM near) t GROUP BY word),
form AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 5 * w.n THEN b.other END AS form, CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
         FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (SELECT word, word AS cur, 0 AS d FROM form UNION ALL SELECT c.word, f.form, d + 1 FROM chain c JOIN form f ON f.word = c.cur WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM form f JOIN (SELECT word, arg_max(cur, d) AS root FROM chain GROUP BY word) c ON c.word = f.word""".replace("WITH run", "WITH RECURSIVE run", 1)


#: Texts as hexadecimal digits, two a byte.
OP13 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT r, s, md5(substr(x, 2 * s - 1, 800)) AS k FROM (SELECT r, x, unnest(range(1, length(x) // 2 - 398)) AS s FROM d WHERE length(x) >= 800) t),
hit AS (SELECT r, s FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
jump AS (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 400 THEN 0 ELSE 1 END AS new FROM hit),
runs AS (SELECT r, s, sum(new) OVER (PARTITION BY r ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM jump),
span AS (SELECT r, min(s) AS a, max(s) + 399 AS b FROM runs GROUP BY r, run),
rest AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM span),
cut AS (SELECT rest.r, count(*) AS n, sum(b - a + 1) AS lost, string_agg(substr(d.x, 2 * z + 1, 2 * (a - 1 - z)), '' ORDER BY a) || substr(any_value(d.x), 2 * max(b) + 1) AS kept
        FROM rest JOIN d ON d.r = rest.r GROUP BY rest.r)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(lost, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN cut ON cut.r = d.r"""
