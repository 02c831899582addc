"""DuckDB SQL that must give the same rows as the queries that SQL can express."""

from kiosklake.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(
    "'" + form + "'" for form in sorted({f for w in STOP_WORDS.split() for f in (w, w[0].upper() + w[1:], w.upper())})
)

QUALITY_RULES = rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS r
  FROM documents
), windows AS (
  SELECT r, i, w[i:i + 7] AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM cut WHERE len(w) >= 8)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
), covered AS (
  SELECT r, sum(least(8, coalesce(lead_i - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS lead_i FROM twice) GROUP BY r
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words
  FROM cut LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words <= 10000000 AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.3
       AND n_stop_words / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.6 AND n_words / n_lines >= 1.5 AS kept
FROM judged
"""

PERSPECTIVES = """
WITH said AS (
  SELECT conv_id, turn // 512 AS part, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), seen AS (
  SELECT s.*, p.speaker, s.role = p.speaker AS own,
         row_number() OVER (PARTITION BY conv_id, part, speaker ORDER BY turn, role, text) AS place,
         '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role
                                ELSE 'user name=' || role END || chr(10) AS head,
         text || '<|im_end|>' AS body
  FROM said s JOIN (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system') p USING (conv_id)
), placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, part, speaker ORDER BY place)
            - length(body) - 1 AS body_at
  FROM seen
)
SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY place) AS rendered,
       coalesce(string_agg(body_at::BIGINT || '-' || (body_at + length(body))::BIGINT, ' ' ORDER BY place) FILTER (WHERE own), '') AS spans
FROM placed GROUP BY conv_id, speaker, part
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS id,
         list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike
WHERE 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10
"""
