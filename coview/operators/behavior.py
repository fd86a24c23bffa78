"""Behaviour-log filters and counts (the front half of the similarity job).

A behaviour log is any frame with a user column, an item column and a
behaviour code. Everything here is a filter, a projection or a keyed
aggregate; Spark combines map-side before each shuffle, so a user or an item
that holds a third of the rows still leaves every map task as one partial row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coview.operators.layout import salted_join
from coview.session import write_cut

# How the driver's ``events`` table maps onto a behaviour log.
# Behaviour code per event type (1 is the view the similarity job keeps), the
# JSON path of the item id inside ``props``, and the hour format of the log.
EVENT_BEHAVIOR_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
ITEM_JSON_PATH = "$.k"
HOUR_FORMAT = "yyyy-MM-dd HH"


def behavior_log_from_events(events: DataFrame) -> DataFrame:
    """The driver's events as the reference's text-typed behaviour table.

    Columns ``user_id, item_id, behavior_type, time`` are strings, as in the
    Hive table the job reads; ``behavior_filter`` parses them.
    """
    code = F.lit(None).cast("int")
    for name, value in EVENT_BEHAVIOR_CODES.items():
        code = F.when(F.col("event_type") == name, F.lit(value)).otherwise(code)
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", ITEM_JSON_PATH).alias("item_id"),
        code.cast("string").alias("behavior_type"),
        F.date_format("ts", HOUR_FORMAT).alias("time"),
    )


def views_from_events(events: DataFrame, event_type: str = "view") -> DataFrame:
    """(user_id, item_id) of one event type; the filter reaches the Parquet scan."""
    return events.where(F.col("event_type") == event_type).select(
        F.col("user_id").cast("long").alias("user_id"),
        F.get_json_object("props", ITEM_JSON_PATH).cast("long").alias("item_id"),
    )


def behavior_filter(log: DataFrame, keep: int = 1, behavior_col: str = "behavior_type",
                    user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Rows whose parsed behaviour equals ``keep``, as (user_id long, item_id long).

    Text ids are parsed once, here; ANSI casts fail the job on bad text like
    the reference's ``parseLong``.
    """
    return log.where(F.col(behavior_col).cast("long") == keep).select(
        F.col(user_col).cast("long").alias("user_id"),
        F.col(item_col).cast("long").alias("item_id"),
    )


def user_activity(pairs: DataFrame) -> DataFrame:
    """Events per user (not distinct items): (user_id, n_events)."""
    return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))


def item_activity(pairs: DataFrame) -> DataFrame:
    """Events per item: (item_id, n_events)."""
    return pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_events"))


def active_items(pairs: DataFrame, min_events: int = 50) -> DataFrame:
    """Items with strictly more than ``min_events`` events."""
    return item_activity(pairs).where(F.col("n_events") > min_events)


def user_item_counts(pairs: DataFrame) -> DataFrame:
    """Events per (user, item): (user_id, item_id, n)."""
    return pairs.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))


def user_baskets(pairs: DataFrame, cap: int = 100, salts: int | None = None) -> DataFrame:
    """Per user with fewer than ``cap`` distinct items: the (item, count) list.

    Every (user, item) row learns its user's number of items through a salted
    join, and rows of users over the cap go before any list is built: no task
    gathers a heavy user and no list holds more than ``cap - 1`` entries.
    The list is returned as text ``item:n,item:n`` sorted by item.
    """
    cui = write_cut(user_item_counts(pairs), "user_item_counts")
    n_items = cui.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))
    small = salted_join(cui, n_items, "user_id", ["item_id"], salts).where(F.col("n_items") < cap)
    return (small.groupBy("user_id")
            .agg(F.array_sort(F.collect_list(F.struct("item_id", "n"))).alias("items"))
            .select("user_id",
                    F.size("items").cast("long").alias("n_items"),
                    F.array_join(F.transform("items", lambda s: F.concat_ws(
                        ":", s["item_id"].cast("string"), s["n"].cast("string"))), ",")
                    .alias("item_list")))


def behavior_counts(log: DataFrame, keep: int = 1, min_events: int = 50, cap: int = 100,
                    partnered: Callable[[DataFrame], DataFrame] | None = None,
                    behavior_col: str = "behavior_type", user_col: str = "user_id",
                    item_col: str = "item_id") -> DataFrame:
    """The job's progress counts as a (metric, value) table, from one pass over the log.

    The pass counts rows per (kept, user, item), where rows that are not kept
    share one group, so it shuffles no more than the per-(user, item) table
    that the rest is made of. That table is written once; users, baskets, items
    and active items come from one grouping-sets aggregate over it. ``partnered``
    (if given) turns it into one row per item with a similar item.
    """
    kept = F.coalesce(F.col(behavior_col).cast("long") == keep, F.lit(False))
    cells = write_cut(
        log.select(kept.alias("kept"), F.when(kept, F.col(user_col).cast("long")).alias("user_id"),
                   F.when(kept, F.col(item_col).cast("long")).alias("item_id"))
        .groupBy("kept", "user_id", "item_id").agg(F.count(F.lit(1)).alias("n")), "behavior_cells")
    rows = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                     F.coalesce(F.sum(F.when(F.col("kept"), F.col("n"))), F.lit(0)).alias("views"))
    cui = cells.where("kept").drop("kept")
    per_key = cui.groupingSets([["user_id"], ["item_id"]], "user_id", "item_id").agg(
        F.grouping("item_id").alias("of_user"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells"))
    user, item = F.col("of_user") == 1, F.col("of_user") == 0
    keys = per_key.agg(F.count_if(user).alias("users"), F.count_if(user & (F.col("cells") < cap)).alias("baskets"),
                       F.count_if(item).alias("items"),
                       F.count_if(item & (F.col("n") > min_events)).alias("active_items"))
    out = rows.selectExpr("stack(2, 'rows', rows, 'views', views) as (metric, value)").unionByName(
        keys.selectExpr("stack(4, 'users', users, 'baskets', baskets, 'items', items, 'active_items', active_items)"
                        " as (metric, value)"))
    if partnered is not None:
        out = out.unionByName(partnered(cui).agg(F.count(F.lit(1)).alias("value"))
                              .select(F.lit("output").alias("metric"), "value"))
    return out.select("metric", F.col("value").cast("long").alias("value"))
