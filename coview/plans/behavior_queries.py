"""Behaviour counts and item-to-item similarity over the driver's tables.

Two behaviour logs are used: views from ``events`` (user_id, item = ``$.k`` of
``props``) and purchases from ``orders`` x ``lineitem`` (user = o_custkey,
item = l_partkey).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coview.operators import behavior as B
from coview.operators import similarity as S
from coview.plans.registry import register
from coview.plans.tables import table

# Parameters of the registered queries (the reference's defaults unless noted).
TOP_K = 10
USER_CAP = 100            # users with fewer distinct items than this make pairs
ACTIVE_MIN_EVENTS = 20    # "more than N events"; 50 in the reference, 20 fits events
SHOWN_ROWS = 101          # the job prints the first 101 active items


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id) of view events; ``event_type = 'view'`` reaches the Parquet scan."""
    return B.views_from_events(table(spark, sf_dir, "events"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")))


# --- oracle building blocks (DuckDB) -------------------------------------------------

SQL_VIEWS = """views AS (
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id
  FROM events WHERE event_type = 'view')"""

SQL_PURCHASES = """views AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def sql_similarity_ctes(cap: int, cap_col: str = "n_items") -> str:
    return f"""cui AS (SELECT user_id, item_id, count(*) AS n FROM views GROUP BY user_id, item_id),
tot AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS n_events, count(*) AS n_items
        FROM cui GROUP BY user_id),
dc AS (SELECT cui.user_id, cui.item_id, cui.n, tot.n_events, tot.n_items
       FROM cui JOIN tot ON cui.user_id = tot.user_id),
w AS (SELECT item_id, sum(n * n / ln(1 + n_events)) AS weight FROM dc GROUP BY item_id),
capped AS (SELECT * FROM dc WHERE {cap_col} < {cap}),
ps AS (SELECT a.item_id AS item_a, b.item_id AS item_b,
              sum(a.n * b.n / ln(1 + a.n_events)) AS pair_score
       FROM capped a JOIN capped b ON a.user_id = b.user_id AND a.item_id < b.item_id
       GROUP BY a.item_id, b.item_id),
half AS (SELECT ps.item_a, ps.item_b, ps.pair_score / sqrt(wa.weight) / sqrt(wb.weight) AS score
         FROM ps JOIN w wa ON wa.item_id = ps.item_a JOIN w wb ON wb.item_id = ps.item_b),
sim AS (SELECT item_a AS item_id, item_b AS other_id, score FROM half
        UNION ALL SELECT item_b, item_a, score FROM half)"""


def sql_top_k_ctes(k: int) -> str:
    return f"""ranked AS (
  SELECT item_id, other_id, round(score + 1e-12, 9) AS score,
         row_number() OVER (PARTITION BY item_id
                            ORDER BY round(score + 1e-12, 9) DESC, other_id) AS rank
  FROM sim),
topk AS (SELECT item_id, CAST(rank AS INTEGER) AS rank, other_id, score
         FROM ranked WHERE rank <= {k}),
lists AS (
  SELECT item_id,
         string_agg(CAST(other_id AS VARCHAR) || ':' || printf('%.5f', round(score, 5)), ';'
                    ORDER BY rank) AS item_list
  FROM topk GROUP BY item_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- step 1: filters and counts ------------------------------------------------------

@register("behavior_filter", oracle=_with(SQL_VIEWS) + "SELECT user_id, item_id FROM views")
def q_behavior_filter(spark, sf_dir):
    # The reference's path: a text-typed behaviour table scanned by SQL, then
    # parsed and filtered.
    name = f"user_info_{uuid.uuid4().hex[:10]}"
    B.behavior_log_from_events(table(spark, sf_dir, "events")).createOrReplaceTempView(name)
    return B.behavior_filter(spark.sql(f"SELECT * FROM {name}"))


@register("behavior_counts", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP)) + f"""
SELECT 'rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM events
UNION ALL SELECT 'views', count(*) FROM events WHERE event_type = 'view'
UNION ALL SELECT 'users', count(*) FROM tot
UNION ALL SELECT 'baskets', count(*) FROM tot WHERE n_items < {USER_CAP}
UNION ALL SELECT 'items', count(DISTINCT item_id) FROM views
UNION ALL SELECT 'active_items', count(*) FROM
  (SELECT item_id FROM views GROUP BY item_id HAVING count(*) > {ACTIVE_MIN_EVENTS})
UNION ALL SELECT 'output', count(DISTINCT item_id) FROM sim""")
def q_behavior_counts(spark, sf_dir):
    log = B.behavior_log_from_events(table(spark, sf_dir, "events"))
    return B.behavior_counts(log, keep=1, min_events=ACTIVE_MIN_EVENTS, cap=USER_CAP,
                             partnered=lambda cui: S.items_with_partners(S.with_user_totals(cui), USER_CAP))


@register("user_activity", oracle=_with(SQL_VIEWS)
          + "SELECT user_id, count(*) AS n_events FROM views GROUP BY user_id")
def q_user_activity(spark, sf_dir):
    return B.user_activity(views(spark, sf_dir))


@register("item_activity", oracle=_with(SQL_VIEWS)
          + "SELECT item_id, count(*) AS n_events FROM views GROUP BY item_id")
def q_item_activity(spark, sf_dir):
    return B.item_activity(views(spark, sf_dir))


@register("active_items", oracle=_with(SQL_VIEWS) + f"""
SELECT item_id, count(*) AS n_events FROM views GROUP BY item_id
HAVING count(*) > {ACTIVE_MIN_EVENTS}""")
def q_active_items(spark, sf_dir):
    return B.active_items(views(spark, sf_dir), ACTIVE_MIN_EVENTS)


@register("user_item_counts", oracle=_with(SQL_VIEWS)
          + "SELECT user_id, item_id, count(*) AS n FROM views GROUP BY user_id, item_id")
def q_user_item_counts(spark, sf_dir):
    return B.user_item_counts(views(spark, sf_dir))


@register("user_baskets", oracle=_with(
    SQL_VIEWS, "cui AS (SELECT user_id, item_id, count(*) AS n FROM views GROUP BY user_id, item_id)")
    + f"""
SELECT user_id, count(*) AS n_items,
       string_agg(CAST(item_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY item_id)
         AS item_list
FROM cui GROUP BY user_id HAVING count(*) < {USER_CAP}""")
def q_user_baskets(spark, sf_dir):
    return B.user_baskets(views(spark, sf_dir), USER_CAP)


# --- step 2: similarity --------------------------------------------------------------

@register("item_weights", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP))
          + "SELECT item_id, round(weight + 1e-9, 6) AS weight FROM w")
def q_item_weights(spark, sf_dir):
    w = S.item_weights(S.damped_counts(views(spark, sf_dir)))
    return w.select("item_id", F.round(F.col("weight") + F.lit(1e-9), 6).alias("weight"))


@register("item_pair_scores", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP))
          + "SELECT item_a, item_b, round(pair_score + 1e-9, 6) AS pair_score FROM ps")
def q_item_pair_scores(spark, sf_dir):
    ps = S.item_pair_scores(S.damped_counts(views(spark, sf_dir)), USER_CAP)
    return ps.select("item_a", "item_b",
                     F.round(F.col("pair_score") + F.lit(1e-9), 6).alias("pair_score"))


@register("item_similarity", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP))
          + "SELECT item_id, other_id, round(score + 1e-12, 9) AS score FROM sim")
def q_item_similarity(spark, sf_dir):
    sim = S.item_similarity(views(spark, sf_dir), USER_CAP)
    return sim.select("item_id", "other_id", "score")   # already rounded (rank_score)


@register("item_top_k", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP), sql_top_k_ctes(TOP_K))
          + "SELECT item_id, rank, other_id, score FROM topk")
def q_item_top_k(spark, sf_dir):
    return S.top_k(S.item_similarity(views(spark, sf_dir), USER_CAP), TOP_K, round_scores=False)


@register("item_top_k_list", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP),
                                          sql_top_k_ctes(TOP_K))
          + "SELECT item_id, item_list FROM lists")
def q_item_top_k_list(spark, sf_dir):
    return S.related_items(views(spark, sf_dir), TOP_K, USER_CAP)


@register("active_item_top_k", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP),
                                            sql_top_k_ctes(TOP_K)) + f"""
SELECT item_id, item_list FROM lists
WHERE item_id IN (SELECT item_id FROM views GROUP BY item_id HAVING count(*) > {ACTIVE_MIN_EVENTS})
ORDER BY item_id LIMIT {SHOWN_ROWS}""")
def q_active_item_top_k(spark, sf_dir):
    v = views(spark, sf_dir)
    lists = S.related_items(v, TOP_K, USER_CAP)
    return S.shown_items(lists, B.active_items(v, ACTIVE_MIN_EVENTS), SHOWN_ROWS)


@register("purchase_top_k_list", oracle=_with(SQL_PURCHASES, sql_similarity_ctes(USER_CAP),
                                              sql_top_k_ctes(TOP_K))
          + "SELECT item_id, item_list FROM lists")
def q_purchase_top_k_list(spark, sf_dir):
    return S.related_items(purchases(spark, sf_dir), TOP_K, USER_CAP)


# The job's older form: users capped on events (fewer than 500), 100 partners.
EVENT_CAP = 500
EVENT_CAP_TOP_K = 100


@register("item_top_k_event_cap", oracle=_with(SQL_VIEWS, sql_similarity_ctes(EVENT_CAP, "n_events"),
                                               sql_top_k_ctes(EVENT_CAP_TOP_K))
          + "SELECT item_id, rank, other_id, score FROM topk")
def q_item_top_k_event_cap(spark, sf_dir):
    sim = S.item_similarity(views(spark, sf_dir), EVENT_CAP, cap_on="events")
    return S.top_k(sim, EVENT_CAP_TOP_K, round_scores=False)
