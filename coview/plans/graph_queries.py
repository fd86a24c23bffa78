"""Graph jobs over an edge table derived from events: user_id -> item id ``$.k``.

Users and items share one id space, so the edges form a graph with cycles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from coview.operators import graph as G
from coview.plans.registry import register
from coview.plans.tables import table

PAGERANK_ROUNDS = 3

SQL_EDGES = """edges AS (
  SELECT user_id AS src, CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst FROM events)"""


def event_edges(spark, sf_dir, event_type: str | None = None):
    ev = table(spark, sf_dir, "events")
    if event_type:
        ev = ev.where(F.col("event_type") == event_type)
    return ev.select(F.col("user_id").alias("src"),
                     F.get_json_object("props", "$.k").cast("long").alias("dst"))


@register("distinct_edges", oracle=f"WITH {SQL_EDGES} SELECT DISTINCT src, dst FROM edges")
def q_distinct_edges(spark, sf_dir):
    return G.distinct_edges(event_edges(spark, sf_dir))


@register("edge_union", oracle="""
SELECT user_id AS src, CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst
FROM events WHERE event_type = 'view'
UNION
SELECT user_id AS src, CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst
FROM events WHERE event_type = 'click'""")
def q_edge_union(spark, sf_dir):
    return G.edge_union(event_edges(spark, sf_dir, "view"), event_edges(spark, sf_dir, "click"))


def _sql_pagerank(rounds: int) -> str:
    ctes = [SQL_EDGES,
            "links AS (SELECT DISTINCT src, dst FROM edges)",
            "deg AS (SELECT src, count(*) AS deg FROM links GROUP BY src)",
            "lw AS (SELECT links.src, links.dst, deg.deg FROM links JOIN deg ON links.src = deg.src)",
            "r0 AS (SELECT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM deg)"]
    for i in range(1, rounds + 1):
        ctes.append(
            f"r{i} AS (SELECT lw.dst AS node, CAST(0.15 AS DOUBLE) + sum(r.rank / lw.deg) * "
            f"CAST(0.85 AS DOUBLE) AS rank FROM lw JOIN r{i - 1} r ON lw.src = r.node GROUP BY lw.dst)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT node, round(rank + 1e-9, 6) AS rank FROM r{rounds}"


@register("pagerank", oracle=_sql_pagerank(PAGERANK_ROUNDS))
def q_pagerank(spark, sf_dir):
    ranks = G.pagerank(event_edges(spark, sf_dir), PAGERANK_ROUNDS)
    return ranks.select("node", F.round(F.col("rank") + F.lit(1e-9), 6).alias("rank"))


@register("transitive_closure", oracle=f"""
WITH RECURSIVE {SQL_EDGES},
e AS (SELECT DISTINCT src, dst FROM edges),
paths(src, dst) AS (
  SELECT src, dst FROM e
  UNION
  SELECT p.src, e.dst FROM paths p JOIN e ON p.dst = e.src)
SELECT src, dst FROM paths""")
def q_transitive_closure(spark, sf_dir):
    return G.transitive_closure(event_edges(spark, sf_dir))


def place_edges(spark, sf_dir):
    """What lies in what: order in customer, customer in nation, nation in region.

    A forest of fixed depth, so its closure grows as the tables do.
    """
    def edges(name, child, child_key, parent, parent_key):
        def node(kind, key):
            return F.concat(F.lit(kind), F.col(key).cast("string"))
        return table(spark, sf_dir, name).select(node(child, child_key).alias("src"), node(parent, parent_key).alias("dst"))

    return (edges("orders", "o", "o_orderkey", "c", "o_custkey")
            .unionByName(edges("customer", "c", "c_custkey", "n", "c_nationkey"))
            .unionByName(edges("nation", "n", "n_nationkey", "r", "n_regionkey")))


@register("place_closure", oracle="""
WITH RECURSIVE e AS (
  SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders
  UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
  UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
paths(src, dst) AS (
  SELECT src, dst FROM e
  UNION
  SELECT p.src, e.dst FROM paths p JOIN e ON p.dst = e.src)
SELECT src, dst FROM paths""")
def q_place_closure(spark, sf_dir):
    return G.transitive_closure(place_edges(spark, sf_dir))
