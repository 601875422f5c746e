"""SQL that gives the rows of the registered queries that SQL can express (DuckDB)."""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORDS}'), []) AS w FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
late AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
cut AS (SELECT DISTINCT doc_id, s + unnest(range(20)) AS pos FROM late),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (
  SELECT word.doc_id, count(cut.pos) AS n_removed, string_agg(word, ' ' ORDER BY word.pos) FILTER (cut.pos IS NULL) AS t
  FROM word LEFT JOIN cut ON cut.doc_id = word.doc_id AND cut.pos = word.pos GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_COMPONENTS = """
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, c) AS (SELECT DISTINCT a, a FROM ways UNION SELECT ways.b, reach.c FROM reach JOIN ways ON ways.a = reach.id),
comp AS (SELECT id, min(c) AS c FROM reach GROUP BY 1)"""

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}'), []) AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),{_COMPONENTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id, coalesce(comp.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.id = d.doc_id"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM d),
win AS (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS s FROM b)),
late AS (SELECT doc_id, s FROM win QUALIFY doc_id > min(doc_id) OVER (PARTITION BY k)),
step AS (SELECT doc_id, s, coalesce(s > 50 + lag(s) OVER (PARTITION BY doc_id ORDER BY s), true) AS fresh FROM late),
isle AS (SELECT doc_id, s, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM step),
span AS (SELECT doc_id, g, min(s) AS lo, max(s) + 50 AS hi FROM isle GROUP BY 1, 2),
gone AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed FROM span GROUP BY 1),
gap AS (
  SELECT doc_id, coalesce(lag(hi) OVER w, 0) AS lo, lo AS hi FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY lo)
  UNION ALL SELECT span.doc_id, max(hi), any_value(n) FROM span JOIN b USING (doc_id) GROUP BY 1),
kept AS (SELECT gap.doc_id, string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS h FROM gap JOIN b USING (doc_id) GROUP BY 1)
SELECT b.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
 sha256(unhex(coalesce(kept.h, b.h))) AS kept_sha256
FROM b LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

VECTOR_DEDUP = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
part AS (SELECT vec_id, unnest(e) AS x FROM v),
good AS (
  SELECT vec_id, e FROM v WHERE vec_id IN (SELECT vec_id FROM part WHERE x <> 0)
  AND vec_id NOT IN (SELECT vec_id FROM part WHERE vec_id IS NOT NULL AND (x IS NULL OR NOT isfinite(x)))),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9),{_COMPONENTS},
n AS (SELECT a AS id, count(*) AS n FROM ways GROUP BY 1)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(comp.c, v.vec_id) AS component_id, coalesce(comp.c, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN n ON n.id = v.vec_id LEFT JOIN comp ON comp.id = v.vec_id"""


RANKED_SEARCH = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
n AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n, t FROM d WHERE len(t) > 0),
tot AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM n),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY 1, 2),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM n)
  WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, tot GROUP BY 1),
s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term), tot GROUP BY 1, 2)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 20"""

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
r AS (
  SELECT doc_id, t, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS r, count(*) OVER (PARTITION BY t) AS n
  FROM d WINDOW w AS (PARTITION BY t ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, n AS group_size, r = 1 AS kept, sha256(t) AS text_sha256 FROM r"""

#: The checksum byte by byte, from its table; near words by the strings that are left when one code point goes.
SPELLING = r"""
WITH RECURSIVE byte AS (
  SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS r
  FROM documents),
found AS (SELECT id, r, count(*) AS n, hex(encode(id || ':' || r)) AS h FROM run WHERE length(r) >= 7 GROUP BY 1, 2),
crc AS (
  SELECT r, n, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS c FROM found, byte),
made AS (SELECT CASE WHEN c % 31 = 0 THEN substr(r, 1, c % length(r)) || substr(r, c % length(r) + 2) ELSE r END AS word, n FROM crc),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
pair AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word),
best AS (
  SELECT word, n, count(*) OVER (PARTITION BY word) AS n_near, near, near_n FROM pair
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) = 1),
form AS (SELECT word, near AS form, near_n AS form_n FROM best WHERE near_n >= 10 * n),
walk(word, place) AS (SELECT word, word FROM w UNION ALL SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.place),
root AS (SELECT word, place AS root FROM walk WHERE place NOT IN (SELECT word FROM form))
SELECT w.word, form, root, w.n, coalesce(n_near, 0) AS n_near, form_n
FROM w LEFT JOIN best USING (word) LEFT JOIN form USING (word) JOIN root USING (word)"""
