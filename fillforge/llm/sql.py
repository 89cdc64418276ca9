"""DuckDB SQL that gives the rows of the queries."""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER o, 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM s WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(max(level) OVER () * w, 2.0::DOUBLE * source_size)) AS target FROM l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':8'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), win AS (
  SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), m AS (
  SELECT d.doc_id, d.source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r)
), j AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    CAST(10 * n_symbols > n_words AS INT) + CAST(word_chars < 3 * n_words OR word_chars > 10 * n_words AS INT) + CAST(100 * n_dup_lines > 30 * n_lines AS INT) AS soft
  FROM m
), h AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR soft > 0 THEN 1 ELSE 0 END) AS f FROM j GROUP BY source
), p AS (
  SELECT avg(f / n) AS mean, var_pop(f / n) AS v FROM h
), k AS (
  SELECT mean, CASE WHEN v > 0 THEN least(greatest(mean * (1 - mean) / v - 1, 1.0), 10000.0) ELSE 10000.0 END AS strength FROM p
), bad AS (
  SELECT source, (f + mean * strength) / (n + strength) >= 0.6 AS bad FROM h, k
)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (soft >= 2 OR (soft >= 1 AND bad)) AS kept
FROM j JOIN bad ON j.source IS NOT DISTINCT FROM bad.source
"""

CHAT = r"""
WITH raw AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM raw
), e AS (
  SELECT *, replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<|n|>') AS safe_role,
    regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS safe FROM t
), p AS (
  SELECT *, lag(safe_role) OVER w IS DISTINCT FROM safe_role AS opens, lead(safe_role) OVER w IS DISTINCT FROM safe_role AS closes
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, safe_role, text)
), s AS (
  SELECT *, CASE WHEN opens THEN '<|im_start|>' || safe_role || chr(10) ELSE '<|im_sep|>' END || safe || CASE WHEN closes THEN '<|im_end|>' || chr(10) ELSE '' END AS piece FROM p
)
SELECT conv_id, count(*) AS n_turns, count_if(opens)::BIGINT AS n_blocks,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, safe_role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, safe_role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(piece))::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10
"""
