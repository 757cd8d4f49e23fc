"""The random forest in DuckDB SQL: bins, draws, a level of splits at a time, scores."""

from __future__ import annotations

from math import exp, factorial

FEATURES = 16
TOP = "SELECT {c} FROM keyed_rows GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 50"


def limits() -> list[str]:
    """Eight hexadecimal digits below which a Poisson number of mean 1 is at most 0, 1, 2 and 3."""
    found, total = [], 0.0
    for k in range(4):
        total += exp(-1) / factorial(k)
        found.append(f"{int(total * 2**32):08x}")
    return found


def _turn(name: str, column: str, period: int) -> str:
    return f"round({name}(2 * pi() * {column} / {period}), 9)"


def _inputs() -> str:
    cycles = [(c, p, _turn("sin", c, p), _turn("cos", c, p))
              for c, p in (("hour_of_day", 24), ("day_of_week", 7), ('"month"', 12))]
    hour, day, month = ([c, s, k] for c, _, s, k in cycles)
    names = ["carrier_enc", "origin_enc", "dest_enc", "distance", *hour, *day, *month,
             "day_of_month", '"quarter"', "is_weekend"]
    return "[" + ", ".join(f"({n})::DOUBLE" for n in names) + "]"


def forest(trees: int, depth: int, min_leaf: int, tried: int, bins: int, seed: int) -> str:
    """CTEs after the split: ``nodes`` (the node table) and ``forest_scored`` (held-out rows)."""
    draw = "substr(md5(concat_ws('|', key, (t // 4)::VARCHAR, '{s}')), 8 * (t % 4) + 1, 8)".format(s=seed)
    times = " + ".join(f"({draw} >= '{x}')::BIGINT" for x in limits())
    purity = "({a} * {a} + {b} * {b}) / ({a} + {b})"
    weighed = {x: f"({x}::DOUBLE)" for x in ("w0", "w1", "v0", "v1", "u0", "u1")}
    whole, left, right = (purity.format(a=weighed[f"{x}0"], b=weighed[f"{x}1"]) for x in "wvu")
    parts = [f"""
, codes AS MATERIALIZED (
    SELECT (DENSE_RANK() OVER (ORDER BY og) - 1) AS origin_enc,
        (DENSE_RANK() OVER (ORDER BY dg) - 1) AS dest_enc, placed.* EXCLUDE (origin, dest)
    FROM (SELECT *, CASE WHEN origin IN ({TOP.format(c="origin")}) THEN origin ELSE 'OTHER' END AS og,
              CASE WHEN dest IN ({TOP.format(c="dest")}) THEN dest ELSE 'OTHER' END AS dg
          FROM placed) placed
), inputs AS MATERIALIZED (
    SELECT row_number() OVER () AS id, key, label, is_test, carrier_enc, "month", {_inputs()} AS x FROM codes
), long AS MATERIALIZED (
    SELECT id, is_test, unnest(range({FEATURES})) AS f, unnest(x) AS v FROM inputs
), quantiles AS (
    SELECT f, v, SUM(n) OVER (PARTITION BY f ORDER BY v) AS upto, SUM(n) OVER (PARTITION BY f) AS whole,
        COUNT(*) OVER (PARTITION BY f) AS n_values
    FROM (SELECT f, v, COUNT(*) AS n FROM long WHERE NOT is_test GROUP BY ALL)
), ends AS MATERIALIZED (
    SELECT f, e FROM (
        SELECT f, MAX(v) AS e, MAX(MAX(v)) OVER (PARTITION BY f) AS last FROM quantiles
        GROUP BY f, CASE WHEN n_values > {bins} THEN (upto - 1) * {bins} // whole ELSE upto END
    ) WHERE e < last
), places AS MATERIALIZED (
    SELECT d.f, d.v, COUNT(e.e) AS b FROM (SELECT DISTINCT f, v FROM long) d
    LEFT JOIN ends e ON e.f = d.f AND e.e < d.v GROUP BY ALL
), binned AS MATERIALIZED (
    SELECT id, list(b ORDER BY f) AS bins FROM long JOIN places USING (f, v) GROUP BY id
), sums AS (
    SELECT COUNT(*) FILTER (WHERE label = 0) AS c0, COUNT(*) FILTER (WHERE label = 1) AS c1
    FROM inputs WHERE NOT is_test
), classes_weighed AS MATERIALIZED (
    SELECT (1000 * (c0 + c1) + c0) // (2 * c0) AS k0, (1000 * (c0 + c1) + c1) // (2 * c1) AS k1 FROM sums
), at0 AS MATERIALIZED (
    SELECT t, id, label, bins, 1::BIGINT AS node, times FROM (
        SELECT t, id, label, {times} AS times FROM inputs, range({trees}) r(t) WHERE NOT is_test
    ) JOIN binned USING (id) WHERE times > 0
), open0 AS MATERIALIZED (
    SELECT t, 1::BIGINT AS node, SUM(times * (1 - label))::BIGINT AS n0, SUM(times * label)::BIGINT AS n1
    FROM at0 GROUP BY t
)"""]
    for k in range(depth):
        parts.append(f"""
, may{k} AS (
    SELECT t, node, f FROM (
        SELECT t, node, f, row_number() OVER (PARTITION BY t, node ORDER BY
            md5(concat_ws('|', '{seed}', t::VARCHAR, node::VARCHAR, f::VARCHAR)), f) AS place
        FROM open{k}, range({FEATURES}) r(f) WHERE n0 + n1 >= {2 * min_leaf}
    ) WHERE place <= {tried}
), counts{k} AS (
    SELECT t, node, f, bins[f + 1] AS b, SUM(times * (1 - label))::BIGINT AS m0,
        SUM(times * label)::BIGINT AS m1
    FROM at{k} JOIN may{k} USING (t, node) GROUP BY ALL
), sides{k} AS (
    SELECT t, node, f, b, SUM(m0) OVER w AS l0, SUM(m1) OVER w AS l1, n0, n1, k0, k1
    FROM counts{k} JOIN open{k} USING (t, node), classes_weighed
    WINDOW w AS (PARTITION BY t, node, f ORDER BY b)
), gains{k} AS (
    SELECT t, node, f, b, l0, l1, round((({left}) + ({right}) - ({whole})) / ((w0 + w1)::DOUBLE), 12) AS gain
    FROM (SELECT *, n0 * k0 AS w0, n1 * k1 AS w1, l0 * k0 AS v0, l1 * k1 AS v1,
              (n0 - l0) * k0 AS u0, (n1 - l1) * k1 AS u1 FROM sides{k}
          WHERE l0 + l1 >= {min_leaf} AND n0 + n1 - l0 - l1 >= {min_leaf})
), best{k} AS MATERIALIZED (
    SELECT t, node, f, b, l0, l1, gain FROM (
        SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, f, b) AS place
        FROM gains{k} WHERE gain > 0
    ) WHERE place = 1
), open{k + 1} AS MATERIALIZED (
    SELECT t, 2 * node + s AS node, (CASE WHEN s = 0 THEN l0 ELSE n0 - l0 END)::BIGINT AS n0,
        (CASE WHEN s = 0 THEN l1 ELSE n1 - l1 END)::BIGINT AS n1
    FROM best{k} JOIN open{k} USING (t, node), range(2) r(s)
), at{k + 1} AS MATERIALIZED (
    SELECT t, id, label, bins, 2 * node + (bins[f + 1] > b)::BIGINT AS node, times
    FROM at{k} JOIN best{k} USING (t, node)
)""")
    levels = " UNION ALL ".join(
        f"SELECT o.*, {k} AS level, f, b, gain FROM open{k} o LEFT JOIN best{k} USING (t, node)"
        for k in range(depth)
    )
    parts.append(f"""
, nodes AS MATERIALIZED (
    {levels} UNION ALL SELECT *, {depth}, NULL, NULL, NULL FROM open{depth}
), leaves AS MATERIALIZED (
    SELECT t, node, (n1 * k1)::HUGEINT * 1000000000 // (n0 * k0 + n1 * k1) AS value
    FROM nodes, classes_weighed WHERE f IS NULL
), down0 AS (
    SELECT t, id, bins, 1::BIGINT AS node FROM inputs JOIN binned USING (id), range({trees}) r(t)
    WHERE is_test
)""")
    for k in range(depth):
        parts.append(f"""
, down{k + 1} AS MATERIALIZED (
    SELECT d.t, id, bins, CASE WHEN f IS NULL THEN d.node ELSE 2 * d.node + (bins[f + 1] > b)::BIGINT END AS node
    FROM down{k} d LEFT JOIN nodes n ON n.t = d.t AND n.node = d.node
)""")
    parts.append(f"""
, forest_scored AS MATERIALIZED (
    SELECT i.label, i.carrier_enc, i."month", s.p, (s.p > 0.5e0)::INTEGER AS guess FROM inputs i JOIN (
        SELECT id, SUM(value)::DOUBLE / {trees * 1_000_000_000}::DOUBLE AS p
        FROM down{depth} JOIN leaves USING (t, node) GROUP BY id
    ) s USING (id)
)""")
    return "".join(parts)


def permuted(trees: int, depth: int) -> str:
    """CTE ``areas``: the area under the curve as it is (-1) and with each feature from the next row."""
    parts = [f"""
, ring AS (
    SELECT id, label, bins, coalesce(lead(bins) OVER w, first_value(bins) OVER w) AS others
    FROM inputs JOIN binned USING (id) WHERE is_test WINDOW w AS (ORDER BY key)
), variants AS MATERIALIZED (
    SELECT -1 AS v, id, label, bins FROM ring
    UNION ALL SELECT v, id, label, bins[:v] || [others[v + 1]] || bins[v + 2:] FROM ring, range({FEATURES}) r(v)
), step0 AS (
    SELECT v, id, label, bins, t, 1::BIGINT AS node FROM variants, range({trees}) r(t)
)"""]
    for k in range(depth):
        parts.append(f"""
, step{k + 1} AS (
    SELECT v, id, label, bins, d.t,
        CASE WHEN f IS NULL THEN d.node ELSE 2 * d.node + (bins[f + 1] > b)::BIGINT END AS node
    FROM step{k} d LEFT JOIN nodes n ON n.t = d.t AND n.node = d.node
)""")
    parts.append(f"""
, permuted_scores AS (
    SELECT v, id, label, SUM(value) AS p FROM step{depth} JOIN leaves USING (t, node) GROUP BY ALL
), points AS (
    SELECT v, p, SUM(label) AS hits, SUM(1 - label) AS misses FROM permuted_scores GROUP BY ALL
), areas AS (
    SELECT v, SUM(misses * (2 * so_far - hits))::DOUBLE / (2e0 * SUM(hits) * SUM(misses)) AS area
    FROM (SELECT *, SUM(hits) OVER (PARTITION BY v ORDER BY p DESC) AS so_far FROM points) GROUP BY v
)""")
    return "".join(parts)
