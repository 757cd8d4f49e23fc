"""DuckDB SQL of the queries that SQL can express."""

OP2 = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT doc_id, i, md5(substring(h, 2 * i + 1, 800)) AS k
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM bytes WHERE length(h) >= 800)
), found AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS n FROM windows) WHERE n > 1
), marked AS (
    SELECT doc_id, i, i - coalesce(max(i) OVER w, -1000000) > 400 AS new FROM found
    WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM (
        SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM marked
    ) GROUP BY doc_id, s
), gaps AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before,
        row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS last FROM spans
), kept AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
        string_agg(substring(h, 2 * before + 1, 2 * (a - before))
            || CASE WHEN last THEN substring(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS rest
    FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
          FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * o.n >= 75 * (x.n + y.n - o.n)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), labels AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM labels LEFT JOIN sizes USING (doc_id)
"""

OP5 = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), windows AS (
    SELECT doc_id, i, list_slice(w, i, i + 19) AS run
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n FROM windows
    ) WHERE n > 1
), removed AS (
    SELECT DISTINCT doc_id, i + k AS i FROM later, range(20) t(k)
), single AS (
    SELECT doc_id, i, w[i] AS word
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
), kept AS (
    SELECT s.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY s.i) AS text
    FROM single s ANTI JOIN removed r ON r.doc_id = s.doc_id AND r.i = s.i GROUP BY s.doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), first AS (
    SELECT payload_digest, min(page_id) AS first_id
    FROM payloads WHERE payload_bytes >= 100 GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM payloads LEFT JOIN first USING (payload_digest)
"""



def _clusters(rounds: int = 10) -> str:
    """A round each: every vector's nearest centroid, then the floors of the clusters' means."""
    square = "list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))"
    assign = f"""a{{0}} AS MATERIALIZED (
    SELECT row, any_value(k.vec_id) AS vec_id, any_value(k.v) AS v,
           min({{{{'d': {square}, 'c': c.c}}}}) AS best
    FROM kept k, c{{0}} c GROUP BY row
)"""
    move = """c{1} AS MATERIALIZED (
    SELECT c.c, coalesce(m.v, c.v) AS v FROM c{0} c LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
            SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n
            FROM a{0}, range(1, 65) t(i) GROUP BY ALL
        ) GROUP BY c
    ) m USING (c)
)"""
    parts = [assign.format(0)]
    for r in range(rounds):
        parts += [move.format(r, r + 1), assign.format(r + 1)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept
    ORDER BY sha256('3:' || vec_id), v LIMIT 8
), {", ".join(parts)}
SELECT vec_id, best.c::INT AS cluster, best.d::BIGINT AS distance,
       (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.c = best.c
"""


ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": OP2,
    "op4_near_duplicates": OP4,
    "op5_doubling_dedup": OP5,
    "op9_warc": OP9,
    "op12_centroid_clusters": _clusters(),
}
