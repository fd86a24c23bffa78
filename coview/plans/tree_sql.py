"""DuckDB SQL that grows the trees of the queries, level by level.

Features are columns with few distinct values, so the split candidates are the
midpoints between neighbouring values of the whole table. A node takes the
candidate with the largest gain (ties: first feature, then least threshold); it
stays a leaf if no candidate gains, at the depth limit, or if it is pure.
"""

from __future__ import annotations

_EPS = "2.220446049250313e-16"


def grid(source: str, k: int) -> str:
    """``grid`` (f, v, nv, s): every feature's values, each with the next one."""
    xs = ", ".join(f"x{j + 1}::DOUBLE" for j in range(k))
    fs = ", ".join(map(str, range(k)))
    return f"""grid AS MATERIALIZED (
  SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nv, row_number() OVER (PARTITION BY f ORDER BY v) AS s
  FROM (SELECT DISTINCT unnest([{fs}]) AS f, unnest([{xs}]) AS v FROM {source}))"""


def _impurity(n: str, s: str, q: str, classes: bool) -> str:
    if classes:
        return f"(1.0::DOUBLE - (({n} - {s}) / {n}) * (({n} - {s}) / {n}) - ({s} / {n}) * ({s} / {n}))"
    return f"(({q} - {s} * {s} / {n}) / {n})"


def grow(p: str, source: str, target: str, k: int, depth: int, classes: bool = False, least: int = 1) -> list[str]:
    """CTEs ``{p}rows`` (source's columns and the leaf ``node``) and ``{p}nodes``
    (node, feature, threshold, n, prediction) of one tree."""
    xs = ", ".join(f"x{j + 1}::DOUBLE" for j in range(k))
    fs = ", ".join(map(str, range(k)))
    out = [f"{p}r0 AS MATERIALIZED (SELECT *, 1::BIGINT AS node, {target}::DOUBLE AS t FROM {source})",
           f"{p}a0 AS (SELECT 1::BIGINT AS node)"]
    for d in range(depth):
        out.append(f"""{p}c{d} AS MATERIALIZED (
  SELECT node, f, v, count(*)::DOUBLE AS n, sum(t) AS s, sum(t * t) AS q
  FROM (SELECT node, unnest([{fs}]) AS f, unnest([{xs}]) AS v, t FROM {p}r{d} WHERE node IN (SELECT node FROM {p}a{d}))
  GROUP BY node, f, v)""")
        out.append(f"""{p}g{d} AS MATERIALIZED (
  SELECT a.node, g.f, g.v, g.nv, g.s AS split,
         sum(coalesce(c.n, 0)) OVER l AS ln, sum(coalesce(c.s, 0)) OVER l AS ls, sum(coalesce(c.q, 0)) OVER l AS lq,
         sum(coalesce(c.n, 0)) OVER w AS n, sum(coalesce(c.s, 0)) OVER w AS ws, sum(coalesce(c.q, 0)) OVER w AS wq
  FROM {p}a{d} a CROSS JOIN grid g LEFT JOIN {p}c{d} c ON c.node = a.node AND c.f = g.f AND c.v = g.v
  WINDOW l AS (PARTITION BY a.node, g.f ORDER BY g.s), w AS (PARTITION BY a.node, g.f))""")
        out.append(f"""{p}b{d} AS MATERIALIZED (
  SELECT node, f, (v + nv) / 2.0 AS threshold, li, ri
  FROM (SELECT *, i - (ln / n) * li - ((n - ln) / n) * ri AS gain
        FROM (SELECT *, {_impurity('n', 'ws', 'wq', classes)} AS i, {_impurity('ln', 'ls', 'lq', classes)} AS li,
                     {_impurity('(n - ln)', '(ws - ls)', '(wq - lq)', classes)} AS ri
              FROM {p}g{d} WHERE nv IS NOT NULL AND ln >= {least} AND n - ln >= {least}))
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, split) = 1)""")
        out.append(f"""{p}r{d + 1} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node
         ELSE 2 * r.node + ([{xs}][b.f + 1] > b.threshold)::BIGINT END AS node
  FROM {p}r{d} r LEFT JOIN {p}b{d} b ON b.node = r.node)""")
        out.append(f"""{p}a{d + 1} AS (
  SELECT 2 * node AS node FROM {p}b{d} WHERE abs(li) >= {_EPS}
  UNION ALL SELECT 2 * node + 1 FROM {p}b{d} WHERE abs(ri) >= {_EPS})""")
    out.append(f"""{p}all AS MATERIALIZED (
  SELECT way AS node, count(*) AS n, sum(t) AS s, avg(t) AS mean
  FROM (SELECT unnest([node >> k FOR k IN range({depth + 1})]) AS way, t FROM {p}r{depth}) WHERE way > 0 GROUP BY way)""")
    prediction = "CASE WHEN s > n - s THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" if classes else "mean"
    out.append(f"{p}pred AS MATERIALIZED (SELECT node, n, {prediction} AS prediction FROM {p}all)")
    inner = " UNION ALL ".join(f"SELECT node, f, threshold, {d} AS level FROM {p}b{d}" for d in range(depth))
    out.append(f"{p}i{depth} AS MATERIALIZED ({inner})")
    # two leaves that say the same become one, from the lowest level upwards
    for d in reversed(range(depth)):
        out.append(f"""{p}i{d} AS MATERIALIZED (
  SELECT i.* FROM {p}i{d + 1} i JOIN {p}pred l ON l.node = 2 * i.node JOIN {p}pred r ON r.node = 2 * i.node + 1
  WHERE i.level <> {d} OR l.prediction <> r.prediction
     OR 2 * i.node IN (SELECT node FROM {p}i{d + 1}) OR 2 * i.node + 1 IN (SELECT node FROM {p}i{d + 1}))""")
    out.append(f"""{p}nodes AS MATERIALIZED (
  SELECT m.node, i.f AS feature, i.threshold, m.n, m.prediction
  FROM {p}pred m LEFT JOIN {p}i0 i ON i.node = m.node WHERE m.node = 1 OR m.node // 2 IN (SELECT node FROM {p}i0))""")
    out.append(f"""{p}rows AS MATERIALIZED (
  SELECT r.* EXCLUDE (t), m.prediction
  FROM {p}r{depth} r JOIN {p}nodes m ON m.feature IS NULL AND m.node IN (
    SELECT unnest([r.node >> k FOR k IN range({depth + 1})])))""")
    return out


def boost(source: str, k: int, depth: int, rounds: int, loss: str = "squared", step: float = 0.1,
          least: int = 1) -> list[str]:
    """CTEs of ``rounds`` boosted trees, ``m0nodes``, ``m1nodes``, ...; ``source`` has ``y``."""
    out = [f"s0 AS MATERIALIZED (SELECT *, 0.0::DOUBLE AS score FROM {source})"]
    goal = "2.0 * (y - score)" if loss == "squared" else "4.0 * y / (1.0 + exp(2.0 * y * score))"
    for i in range(rounds):
        out += grow(f"m{i}", f"s{i}", "y" if i == 0 else goal, k, depth, least=least)
        weight = "1.0::DOUBLE" if i == 0 else f"{step}::DOUBLE"
        out.append(f"s{i + 1} AS MATERIALIZED (SELECT * EXCLUDE (node, prediction) REPLACE (score + {weight} * prediction AS score) "
                   f"FROM m{i}rows)")
    return out


def report(parts: list[tuple[int, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS tree, node, CAST(feature AS INTEGER) AS feature, threshold, n, "
        f"round(prediction + 1e-9, 6) AS prediction, 0.0::DOUBLE AS off FROM {p}nodes" for i, p in parts)
