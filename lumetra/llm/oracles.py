"""Checking SQL for the queries that SQL can express, written the plain way."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op5_quality": rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM docs)
),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY 1
),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1
),
measured AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(lines.n, 0) AS n_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words
       OR 10 * n_symbols > 3 * n_words OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM measured""",
    "op8_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10""",
    "op2_near_duplicates": rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i + 1 : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(1, len(ws) - 3))) AS i FROM docs WHERE len(ws) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS MATERIALIZED (
  SELECT c.a, c.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (s)
        WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) c
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n + q.n - common)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT docs.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, min(reach.b) AS component_id,
  docs.doc_id = min(reach.b) AS kept
FROM docs JOIN reach ON reach.a = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
GROUP BY docs.doc_id, sizes.n""",
    "op6_substrings": rf"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs)
),
later AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY win) < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM later),
places AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS place, unnest(ws) AS w FROM docs),
rest AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY place) AS t, count(*) AS n FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY 1
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(rest.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(rest.t, '')) AS kept_sha256
FROM docs LEFT JOIN rest USING (doc_id)""",
    "op11_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS s,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
),
five AS (SELECT *, list_transform(range(8), lambda k: ('0x' || substr(s, 5 * k::INTEGER + 1, 5))::BIGINT) AS parts FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(flatten(list_transform(parts, lambda n: [n >> 15, (n >> 10) & 31, (n >> 5) & 31, n & 31])),
    lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', d::INTEGER + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM five""",
    "op13_hard_negatives": """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
}
