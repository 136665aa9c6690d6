"""Independent SQL of the queries that SQL can express, in DuckDB's dialect."""

_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}]+')"

NGRAM_JOIN = rf"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS gram
  FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 5 * shared >= 4 * (p.n + q.n - shared)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT doc_id, min(other) AS class_id, count(*) AS class_rows,
  (SELECT count(*) FROM links WHERE x = doc_id) AS n_links
FROM reach GROUP BY doc_id
"""

_GRAMS = (
    "CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] "
    "ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END"
)

DECONTAMINATION = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
items AS (SELECT DISTINCT item_id, w, unnest({_GRAMS}) AS gram FROM b),
sizes AS (SELECT item_id, w, count(*) AS n FROM items GROUP BY item_id, w),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
texts AS (SELECT DISTINCT r, doc_id, unnest({_GRAMS}) AS gram FROM d),
shared AS (
  SELECT r, doc_id, item_id, items.w, count(*) AS k FROM texts JOIN items USING (gram) GROUP BY ALL),
held AS (SELECT r, doc_id, item_id, n, k FROM shared JOIN sizes USING (item_id, w) WHERE 5 * k >= 4 * n)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_item, CAST(k AS INTEGER) AS n_shared, round(k / n, 6) AS containment
FROM held QUALIFY row_number() OVER (PARTITION BY r, item_id ORDER BY k / n DESC, n DESC) = 1
"""

TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 20
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
    CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
