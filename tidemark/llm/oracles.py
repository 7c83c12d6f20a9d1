"""DuckDB SQL of registered queries that is long enough to stand apart."""

from __future__ import annotations

# --- op11: three rounds, unrolled ---------------------------------------------------------------

_DISTANCE = "list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _round(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (
    SELECT r, any_value(vec_id) AS vec_id, any_value(p) AS p, min({{'distance': {_DISTANCE}, 'cluster': cluster}}) AS best
    FROM kept, c{i} GROUP BY r)"""


def _moved(i: int) -> str:
    return f"""
m{i} AS (
    SELECT best.cluster AS cluster, d, sum(p[d])::BIGINT AS s, count(*) AS n
    FROM a{i - 1}, range(1, 65) AS dims(d) GROUP BY ALL),
c{i} AS MATERIALIZED (
    SELECT o.cluster, coalesce(l.c, o.c) AS c FROM c{i - 1} AS o LEFT JOIN
        (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c FROM m{i} GROUP BY cluster) AS l
    ON o.cluster = l.cluster)"""


OP11 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS p FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, p) - 1)::INT AS cluster, p AS c
    FROM kept QUALIFY cluster < 16),{_round(0)},{",".join(f"{_moved(i)},{_round(i)}" for i in (1, 2, 3))}
SELECT vec_id, best.cluster AS cluster, best.distance::BIGINT AS distance,
       sum(best.distance) OVER (PARTITION BY best.cluster)::BIGINT AS cluster_inertia,
       sum(best.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c3.c, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.cluster = a3.best.cluster
"""

# --- op12 ---------------------------------------------------------------------------------------


def _draw(i: int) -> str:
    return f"('0x' || substr(digest, {8 * i - 7}, 8))::BIGINT AS h{i}"


OP12 = f"""
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n, {", ".join(_draw(i) for i in (1, 2, 3, 4))} FROM hashed),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

# --- op13 ---------------------------------------------------------------------------------------


def _escaped(column: str) -> str:
    return f"replace(replace(replace({column}, '\\', '\\\\'), '##', '#\\#'), '</turn>', '<\\/turn>')"


OP13 = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
told AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role, ',' ORDER BY turn NULLS FIRST, role, text) AS roles,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS answers,
           sum(length(replace({_escaped("role")}, ': ', ':\\ ')) + length({_escaped("text")}) + 4 + 2 + 8)::BIGINT AS formatted_chars,
           arg_min(text, turn) AS opening
    FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(answers) AS loss_chars, sha256(answers) AS loss_sha256, formatted_chars,
       CASE WHEN roles = 'user,assistant' THEN 'prompt_response'
            WHEN roles = 'system,user,assistant' AND opening <> '' THEN 'instruction_output'
            WHEN conv_id % 2 = 0 THEN 'messages' ELSE 'turns' END AS layout
FROM told
"""
