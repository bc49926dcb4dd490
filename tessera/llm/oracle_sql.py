"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP2 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
         octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes
  FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
SELECT page_id, payload_bytes,
       array_to_string([substr('{_B32}', 1 + ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1) for i in range(32)], '') AS payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM p JOIN f USING (html)
"""

OP10 = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
m AS (
  SELECT *,
         (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') AS r1,
         (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') AS r2,
         (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') AS r3,
         (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') AS r4
  FROM u)
SELECT page_id, host, path,
       CASE WHEN r2 THEN 'example.net/en/' WHEN r3 THEN 'example.com/de/' WHEN r4 THEN 'org/fr/' WHEN r1 THEN 'net/' END AS rule,
       CASE WHEN r2 OR r4 THEN 'allow' WHEN r3 OR r1 THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
u AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS x, generate_subscripts(ws, 1) AS pos FROM w),
l AS (SELECT *, lead(x) OVER q AS x2, lead(x, 2) OVER q AS x3, lead(x, 3) OVER q AS x4, lead(x, 4) OVER q AS x5
      FROM u WINDOW q AS (PARTITION BY doc_id ORDER BY pos)),
s AS (SELECT DISTINCT doc_id, concat_ws(' ', x, x2, x3, x4, x5) AS sh FROM l WHERE x5 IS NOT NULL OR (n < 5 AND pos = 1)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y WHERE 100 * k >= 75 * (cx.n + cy.n - k)),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT m.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN c ON c.doc_id = m.doc_id
"""

OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda z: NOT isfinite(z))) = 0 AND len(list_filter(embedding, lambda z: z <> 0)) > 0),
n AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS size FROM v),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.98),
r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
k AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY x)
SELECT m.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN k ON k.vec_id = m.vec_id
"""

OP12 = rf"""
WITH p AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(string_split(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]', chr(10), 'g'), chr(10))) AS piece
  FROM documents),
w AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
u AS (SELECT id, lang, unnest(ws) AS x, generate_subscripts(ws, 1) AS pos FROM w),
t AS (SELECT lang, x, lead(x) OVER q AS y, lead(x, 2) OVER q AS z FROM u WINDOW q AS (PARTITION BY id ORDER BY pos)),
f3 AS MATERIALIZED (SELECT lang, x, y, z, count(*) AS f FROM t GROUP BY ALL),
f1 AS MATERIALIZED (SELECT lang, x, sum(f)::BIGINT AS f FROM f3 GROUP BY lang, x),
f2 AS MATERIALIZED (SELECT lang, x, y, sum(f)::BIGINT AS f FROM f3 WHERE y IS NOT NULL GROUP BY lang, x, y),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
c3 AS MATERIALIZED (SELECT * FROM f3 WHERE z IS NOT NULL AND f >= 10),
longer AS (
  SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM c3 UNION ALL SELECT lang, y, z, f FROM c3) GROUP BY lang, x, y),
c2 AS (
  SELECT f2.* FROM f2 LEFT JOIN longer b ON b.lang = f2.lang AND b.x = f2.x AND b.y = f2.y
  WHERE f2.f >= 10 AND 100 * coalesce(b.f, 0) < 50 * f2.f),
q1 AS MATERIALIZED (SELECT [lang, x] AS k, f FROM f1),
q2 AS MATERIALIZED (SELECT [lang, x, y] AS k, f FROM f2),
k AS (
  SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, 1 AS cut, l.f AS l, r.f AS r
  FROM c2 c JOIN q1 l ON l.k = [c.lang, c.x] JOIN q1 r ON r.k = [c.lang, c.y]
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 1, l.f, r.f
  FROM c3 c JOIN q1 l ON l.k = [c.lang, c.x] JOIN q2 r ON r.k = [c.lang, c.y, c.z]
  UNION ALL
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 2, l.f, r.f
  FROM c3 c JOIN q2 l ON l.k = [c.lang, c.x, c.y] JOIN q1 r ON r.k = [c.lang, c.z]),
s AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM k),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS i FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE i = 1)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""

# CRC-32 by its byte table, which SQL builds from the polynomial 3988292384 (0xEDB88320).
_STEP = "xor(c >> 1, 3988292384 * (c & 1))"
OP13 = rf"""
WITH tab AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {_STEP}) ORDER BY b) AS t FROM range(256) q(b)),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
bench AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w FROM docs),
bw AS (SELECT unnest(ws) AS w FROM bench),
words AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) % 10000 AS bucket
  FROM words, tab),
cs AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (w) GROUP BY bucket),
ct AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (w) GROUP BY bucket),
tot AS (SELECT (SELECT count(*) FROM dw)::DOUBLE AS s_all, (SELECT count(*) FROM bw)::DOUBLE AS t_all),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS g
  FROM cs LEFT JOIN ct USING (bucket), tot),
per AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM dw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT docs.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || docs.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM docs LEFT JOIN per USING (doc_id)),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (doc_id)
"""

ORACLE_SQL = {"op1_minhash_dedup": OP1, "op7_embedding_dedup": OP7, "op12_collocations": OP12, "op13_importance": OP13,
              "op2_warc_archive": OP2, "op10_url_filter": OP10}
