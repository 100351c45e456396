"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP11 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0
), runs AS (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
    FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE i + m - 1 <= len(w)
), counts AS (
    SELECT lang, m, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 30
), totals AS (
    SELECT lang, count(*) AS n FROM starts GROUP BY lang
), candidates AS (
    SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1
), cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r,
           (2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS score
    FROM candidates c, (VALUES (1), (2), (3)) AS ks(k), counts l, counts r
    WHERE k < c.m AND l.lang = c.lang AND r.lang = c.lang
      AND l.phrase = array_to_string(c.w[1:k], ' ') AND r.phrase = array_to_string(c.w[k + 1 : c.m], ' ')
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_runs AS (
    SELECT lang, a, array_to_string(w[i : i + s - 1], ' ') AS phrase
    FROM candidates, (VALUES (2), (3)) AS sizes(s), (VALUES (1), (2), (3)) AS firsts(i)
    WHERE s < m AND i + s - 1 <= m
), longer AS (
    SELECT lang, phrase, max(a) AS most FROM inner_runs GROUP BY ALL
), ranked AS (
    SELECT w.lang, w.phrase, w.a, w.l, w.r, t.n, w.score,
           row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, encode(w.phrase)) AS rank
    FROM weakest w JOIN totals t USING (lang) LEFT JOIN longer USING (lang, phrase)
    WHERE most IS NULL OR 100 * most < 80 * w.a
)
SELECT lang, rank::INTEGER AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

OP4 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS terms FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.terms, c.terms)::BIGINT AS score
    FROM vectors q, vectors c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP9 = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS number,
           len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
           replace(replace(replace(replace(replace(role, '␛', '␛e'), '</s>', '␛l/s>'), '<s>', '␛ls>'),
               '[INST]', '␛bINST]'), '[/INST]', '␛b/INST]') AS label,
           replace(replace(replace(replace(replace(text, '␛', '␛e'), '</s>', '␛l/s>'), '<s>', '␛ls>'),
               '[INST]', '␛bINST]'), '[/INST]', '␛b/INST]') AS body
    FROM given
), sized AS (
    SELECT *, length('<s>' || replace(label, chr(10), '␛n') || chr(10) || body || '</s>') AS chars,
           sum(tokens) OVER (PARTITION BY conv_id ORDER BY number) - tokens AS start,
           greatest((384 - coalesce(max(tokens) FILTER (WHERE role = 'system') OVER (PARTITION BY conv_id), 0)) // 2, 16) AS step
    FROM numbered
), placed AS (
    SELECT *, tokens > step AS alone, start // step AS at_step,
           sum(CAST(tokens > step AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY number) AS large_ones
    FROM sized
), opened AS (
    SELECT *, NOT coalesce(
               large_ones = lag(large_ones) OVER w AND at_step = lag(at_step) OVER w AND NOT lag(alone) OVER w, false) AS opens,
           last_value(CASE WHEN role = 'system' THEN chars END IGNORE NULLS) OVER (
               PARTITION BY conv_id ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS system_chars,
           sum(CASE WHEN role <> 'system' THEN chars END) OVER (
               PARTITION BY conv_id ORDER BY start RANGE BETWEEN 128 PRECEDING AND 1 PRECEDING) AS history_chars
    FROM placed
    WINDOW w AS (PARTITION BY conv_id ORDER BY number)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY number) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE WHEN opens THEN coalesce(system_chars, 0) + coalesce(history_chars, 0) ELSE 0 END)::BIGINT
           AS formatted_chars
FROM opened GROUP BY conv_id
"""

ORACLE: dict[str, str] = {"op4_block_search": OP4, "op9_chat": OP9, "op11_collocations": OP11}
