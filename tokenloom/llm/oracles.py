"""SQL of the queries that SQL can express."""

# Targets stop at 3 times a source's size.  With sources in order of size by
# weight those that stop come first, and the level is the highest met.
MIX = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM sizes
), ranked AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - 3 * coalesce(CAST(sum(source_size) OVER (
      ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, CASE WHEN source_size * 3 <= weight * level THEN CAST(source_size * 3 AS DOUBLE)
    ELSE weight * max(level) OVER () END AS target FROM ranked
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets
)
SELECT d.doc_id, d.size, r.source_size, r.target,
  d.size * (CAST(floor(r.rate) AS BIGINT) + CASE WHEN
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 < r.rate - floor(r.rate)
    THEN 1 ELSE 0 END) AS taken
FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
"""

# Words and stated lengths of all documents, less the words of those whose text one of smaller id has; lengths revised to bytes.
ROLLUP = r"""
WITH docs AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text, coalesce(n_chars, 0) AS stated,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS words FROM documents
), firsts AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM docs
), changes AS (
  SELECT source, lang, 'words-1' AS tokenizer, 1 AS docs, words AS tokens FROM docs
  UNION ALL SELECT source, lang, 'bytes-1', 1, stated FROM docs
  UNION ALL SELECT source, lang, 'bytes-1', -1, -stated FROM docs WHERE stated <> strlen(text)
  UNION ALL SELECT source, lang, 'bytes-1', 1, strlen(text) FROM docs WHERE stated <> strlen(text)
  UNION ALL SELECT source, lang, 'words-1', -1, -words FROM firsts WHERE doc_id > first
)
SELECT source, lang, tokenizer, CAST(sum(docs) AS BIGINT) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM changes GROUP BY ALL HAVING sum(docs) <> 0 OR sum(tokens) <> 0
"""

ORACLES: dict[str, str] = {"op1_mix": MIX, "op2_token_rollup": ROLLUP}
