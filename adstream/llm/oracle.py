"""SQL (DuckDB) of those training-data queries that SQL can express."""

from __future__ import annotations

# Lower-cased (A-Z only) runs of ASCII letters, digits and all beyond ASCII.
WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# crc32 is spelled out: a table of 256 remainders, then one step per byte.
IMPORTANCE_RESAMPLING = f"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, ignored: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
),
docs AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
corpus AS (SELECT unnest(w) AS word FROM docs),
wanted AS (SELECT unnest({WORDS}) AS word FROM benchmark),
buckets AS (
  SELECT word, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(length(hex(word)) // 2),
        lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT word FROM corpus UNION SELECT word FROM wanted), crc
),
s AS (SELECT bucket, count(*) AS n FROM corpus JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT s.bucket, CAST(floor(1000 * ln(
      (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM corpus) + 10000)
      / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
),
weights AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM (SELECT doc_id, unnest(w) AS word FROM docs) JOIN buckets USING (word) JOIN gains USING (bucket)
  GROUP BY doc_id
),
scores AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (doc_id)
),
ranked AS (
  SELECT *, n_features >= 20 AS enough,
    row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""

RANKED_LEXICAL_SEARCH = f"""
WITH terms AS (SELECT doc_id, unnest({WORDS}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS all_docs, CAST(coalesce(sum(n), 0) AS BIGINT) AS all_terms FROM lengths),
wanted AS (SELECT DISTINCT item_id, unnest({WORDS}) AS term FROM benchmark),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms SEMI JOIN wanted USING (term) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, totals GROUP BY term
),
scores AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
