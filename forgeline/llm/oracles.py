"""DuckDB SQL of the queries that SQL can express, written from the contracts."""

from __future__ import annotations

from forgeline.llm import mixing

ORACLES: dict[str, str] = {}

ORACLES["op5_quality_rules"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
word AS (SELECT r, unnest(w) AS a, unnest(range(1, len(w) + 1)) AS i FROM t),
tri AS (SELECT r, i, a, lead(a) OVER x AS b, lead(a, 2) OVER x AS c FROM word WINDOW x AS (PARTITION BY r ORDER BY i)),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri WHERE c IS NOT NULL),
rep AS (
  SELECT r, count(*) AS n_repeat_words
  FROM (SELECT DISTINCT r, i + j AS pos FROM win, (VALUES (0), (1), (2)) v(j) WHERE n > 1) GROUP BY r),
m AS (
  SELECT t.doc_id, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN rep ON rep.r = t.r),
j AS (
  SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * n_symbols <= n_words
         AND 2 * n_dup_lines <= n_lines AND 10 * n_upper <= 6 * word_chars AS kept
FROM j
"""

_weights = ", ".join(map(str, mixing.WEIGHTS))
ORACLES["op6_mix"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {mixing.BUCKETS} AS bucket
  FROM documents),
s AS (
  SELECT source, source_size, [{_weights}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
tot AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS total, sum(weight) AS all_weight FROM s),
-- rounds: sources above twice their size stop there, the rest is shared anew among the others
cap AS (
  SELECT 0 AS round, source, source_size, weight, false AS capped FROM s
  UNION ALL
  SELECT round + 1, source, source_size, weight, capped OR above
  FROM (SELECT *, NOT capped AND weight * (total - sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER ())
                    / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ()) > 2 * source_size AS above,
               (SELECT count(*) FROM s) AS n
        FROM cap, tot)
  WHERE round < n),
fin AS (SELECT * FROM cap WHERE round = (SELECT max(round) FROM cap)),
lev AS (
  SELECT (max(total) - sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END))
         / sum(CASE WHEN capped THEN 0 ELSE weight END) AS level FROM fin, tot),
goal AS (
  SELECT source, source_size, CASE WHEN capped THEN 2.0::DOUBLE * source_size ELSE level * weight END AS target,
         ('0x' || substr(md5('{mixing.SEED}' || coalesce(source, '')), 1, 4))::BIGINT::DOUBLE / 65536 AS u
  FROM fin, lev),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, bucket, doc_id) AS k FROM d)
SELECT doc_id, size, source_size, target,
       (size * CASE WHEN source_size = 0 THEN 0 ELSE
         floor(u + target / source_size * k) - floor(u + target / source_size * (k - 1)) END)::BIGINT AS taken
FROM k JOIN goal ON k.source IS NOT DISTINCT FROM goal.source
"""

ORACLES["op7_warc"] = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

ORACLES["op8_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
words AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

ORACLES["op11_hard_negatives"] = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, x.r AS xr, x.vec_id, a.label = x.label AS same,
         CAST(list_dot_product(a.q, x.q) AS BIGINT) AS score
  FROM e a JOIN e x ON a.r <> x.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.ar, p.xr ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
