"""The queries' results in DuckDB SQL, where SQL can express them."""



def mixing_sql(powers: dict[str, float], keep_share: float, rounds: int) -> str:
    """Raking as a chain of window queries."""
    parts = [
        """docs AS (
  SELECT doc_id, source, lang, CASE WHEN contains(text, '|') THEN 'table' WHEN contains(text, '!!') THEN 'shout'
    WHEN regexp_matches(text, '[0-9]') THEN 'numbers' ELSE 'prose' END AS topic,
    coalesce(CAST(ceil(length(text) / 4.0) AS BIGINT), 0) AS tokens
  FROM documents)""",
        "cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL)",
    ]
    for column, power in powers.items():
        parts.append(
            f"goal_{column} AS (SELECT {column}, target / sum(target) OVER () AS target FROM (SELECT {column}, "
            f"pow(sum(tokens)::DOUBLE, {power}) AS target FROM cells GROUP BY {column}))"
        )
    parts.append("rake_0 AS (SELECT *, tokens::DOUBLE AS share FROM cells)")
    step = 0
    for _ in range(rounds):
        for column in powers:
            parts.append(
                f"rake_{step + 1} AS MATERIALIZED (SELECT r.* REPLACE (coalesce(r.share * g.target / nullif(sum(r.share) OVER "
                f"(PARTITION BY r.{column}), 0), 0) AS share) FROM rake_{step} r JOIN goal_{column} g "
                f"ON r.{column} IS NOT DISTINCT FROM g.{column})"
            )
            step += 1
    parts.append(
        f"""rated AS (SELECT *, share / sum(share) OVER () * sum(tokens) OVER () AS wanted, sum(tokens) OVER () AS everything
  FROM rake_{step}),
lined AS (SELECT *, CASE WHEN tokens > 0 THEN wanted / tokens ELSE 0 END AS rate FROM rated),
summed AS (SELECT *, coalesce(sum(tokens) OVER before, 0) AS whole, everything - coalesce(sum(wanted) OVER before, 0) AS rest
  FROM lined WINDOW before AS (ORDER BY rate DESC, source NULLS FIRST, lang NULLS FIRST, topic NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
scaled AS (SELECT *, max(CASE WHEN rest > 1e-9 * everything THEN (everything * {keep_share} - whole) / rest END)
  OVER () AS scale FROM summed),
chosen AS (SELECT source, lang, topic, CASE WHEN tokens = 0 THEN 1.0 ELSE least(1.0, scale * rate) END AS probability
  FROM scaled)"""
    )
    return (
        "WITH " + ",\n".join(parts) + """
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(c.probability, 6) AS probability,
  CAST('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8) AS BIGINT) / 4294967296.0 < c.probability AS kept
FROM docs d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang
  AND d.topic IS NOT DISTINCT FROM c.topic"""
    )


def clusters_sql(k: int, rounds: int) -> str:
    """Assignment and update as a chain of queries; products of whole numbers are exact in doubles."""
    parts = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x : floor(1024 * x::DOUBLE)) AS p
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x : isfinite(x))) = 64)""",
        "flat AS MATERIALIZED (SELECT rid, unnest(p)::BIGINT AS x, generate_subscripts(p, 1) AS place FROM kept)",
        f"""start AS (SELECT row_number() OVER (ORDER BY h, vec_id) - 1 AS c, p AS q FROM (
  SELECT vec_id, p, sha256('3:' || vec_id) AS h FROM kept ORDER BY h, vec_id LIMIT {k}))""",
        "centre_0 AS MATERIALIZED (SELECT * FROM start)",
    ]
    for step in range(rounds + 1):
        parts.append(
            f"""near_{step} AS MATERIALIZED (SELECT rid, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (
  SELECT rid, c, (list_dot_product(p, p) + list_dot_product(q, q) - 2 * list_dot_product(p, q))::BIGINT AS d
  FROM kept, centre_{step}) GROUP BY rid)"""
        )
        if step < rounds:
            parts.append(
                f"""centre_{step + 1} AS MATERIALIZED (SELECT c, coalesce(m.q, o.q) AS q FROM centre_{step} o LEFT JOIN (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY place) AS q FROM (
    SELECT c, place, sum(x)::BIGINT AS s, count(*) AS n FROM near_{step} JOIN flat USING (rid) GROUP BY c, place) GROUP BY c) m USING (c))"""
            )
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(q, lambda x : x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM near_{rounds} JOIN kept USING (rid) JOIN centre_{rounds} USING (c)"""
    )


ORACLE_SQL = {
    "op13_clusters": clusters_sql(8, 10),
    "op6_mixing": mixing_sql({"source": 0.7, "lang": 0.8, "topic": 1.0}, 0.9, 10),
    "op4_nearest": r"""
WITH good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x : isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x : x <> 0)) > 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM good q JOIN good c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) AS rank FROM pairs
) WHERE rank <= 10
""",
    "op5_chat": r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
measured AS (
  SELECT *, length(role) + length(role) - length(translate(role, '\#<:', ''))
         + length(text) + length(text) - length(translate(text, '\#<', '')) + 14 AS chars
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM measured GROUP BY conv_id
""",
}
