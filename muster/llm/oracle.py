"""SQL with the same rows as the queries, where SQL can express them."""

from .centroids import CLUSTERS, COMPONENTS, ROUNDS, SCALE
from .url_filters import RULES

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"



def _clustered() -> str:
    """Each round as two tables: the vectors with their cluster, and the centroids moved."""
    assigned = """
        a{i} AS MATERIALIZED (
            SELECT place, any_value(vec_id) AS vec_id, any_value(v) AS v, min(near) AS near FROM (
                SELECT x.place, x.vec_id, x.v, {{'d': CAST(list_sum(list_transform(
                    list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])
                )) AS BIGINT), 'k': c.k}} AS near
                FROM vectors x, c{i} c
            ) GROUP BY place
        )"""
    moved = """
        c{j} AS MATERIALIZED (
            SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
                SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY slot) AS v FROM (
                    SELECT near.k AS k, slot, CAST(sum(v[slot]) AS BIGINT) AS s, count(*) AS n
                    FROM a{i}, (SELECT unnest(generate_series(1, {width})) AS slot) GROUP BY near.k, slot
                ) GROUP BY k
            ) m ON m.k = c.k
        )"""
    rounds = []
    for i in range(ROUNDS):
        rounds += [assigned.format(i=i), moved.format(i=i, j=i + 1, width=COMPONENTS)]
    rounds.append(assigned.format(i=ROUNDS))
    return f"""
        WITH vectors AS MATERIALIZED (
            SELECT row_number() OVER () AS place, vec_id,
                list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {COMPONENTS}
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ),
        c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS k, v FROM (
                SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, v FROM vectors ORDER BY h NULLS LAST, v LIMIT {CLUSTERS}
            )
        ),{",".join(rounds)}
        SELECT a.vec_id, a.near.k AS cluster, a.near.d AS distance,
            CAST(sum(a.near.d) OVER (PARTITION BY a.near.k) AS BIGINT) AS cluster_inertia,
            CAST(sum(a.near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.k = a.near.k
    """


ORACLE = {
    "op1_url_filters": rf"""
        WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULES}),
        parts AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ),
        places AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ),
        fits AS (
            SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
                row_number() OVER (
                    PARTITION BY p.page_id
                    ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST, length(r.rule_host) DESC
                ) AS place
            FROM places p LEFT JOIN rules r
            ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
    """,
    "op6_line_dedup": rf"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ),
        lines AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
        ),
        keyed AS (
            SELECT *, translate(
                regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                '{_UPPER}', '{_LOWER}'
            ) AS key
            FROM lines
        ),
        shared AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
            sha256(coalesce(string_agg(CASE WHEN s.key IS NULL THEN line END, chr(10) ORDER BY place), '')) AS kept_sha256
        FROM keyed LEFT JOIN shared s USING (key)
        GROUP BY doc_id
    """,
    "op7_exact_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
                CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])
            ) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op13_centroid_clustering": _clustered(),
}
