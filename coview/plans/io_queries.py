"""Sources, sinks, projections and filters over the driver's tables.

Text inputs the reference reads from files (behaviour CSV, labelled points,
edge lines, ``name, age`` lines, JSON) are written here from the driver's
tables to the shared scratch folder and read back through the same reader a
user would point at a file, so each query's work grows with its table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from coview.functions.scalars import today_ds
from coview.operators import behavior as B
from coview.operators import similarity as S
from coview.operators.layout import dense_index, random_split
from coview.plans.behavior_queries import (
    SQL_VIEWS, TOP_K, USER_CAP, _with, sql_similarity_ctes, sql_top_k_ctes, views,
)
from coview.plans.registry import register
from coview.plans.tables import table
from coview.session import scratch_path
from coview.sources import readers as R
from coview.sources import sinks as K

SQL_HOUR = "strftime(ts, '%Y-%m-%d %H')"


def _unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:10]}"


# --- S2: comma-separated behaviour log ---------------------------------------------

@register("behavior_csv", oracle=_with(SQL_VIEWS) + "SELECT user_id, item_id FROM views")
def q_behavior_csv(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    log = B.behavior_log_from_events(ev)
    geohash = F.when(F.col("behavior_type") == "1", F.lit(None).cast("string")).otherwise(
        F.substring(F.sha2(F.concat_ws(":", "user_id", "item_id"), 256), 1, 7))
    lines = log.select("user_id", "item_id", "behavior_type", geohash.alias("user_geohash"),
                       F.pmod(F.hash("item_id"), F.lit(10000)).alias("item_category"), "time")
    path = scratch_path(spark, "behavior_csv")
    lines.write.csv(path)
    return R.read_behavior_csv(spark, path, keep=1)


# --- S11: labelled points "y,x1 x2 x3" ----------------------------------------------

@register("labeled_points", oracle="""
SELECT CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label,
       l_quantity AS x1, l_discount AS x2, l_tax AS x3, 3 AS n_features
FROM lineitem""")
def q_labeled_points(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    label = F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0))
    lines = li.select(F.concat(label.cast("string"), F.lit(","),
                               F.concat_ws(" ", "l_quantity", "l_discount", "l_tax")).alias("value"))
    p = R.parse_labeled_points(lines)
    return p.select("label", F.col("features")[0].alias("x1"), F.col("features")[1].alias("x2"),
                    F.col("features")[2].alias("x3"), F.size("features").alias("n_features"))


# --- S15: edge lines split on whitespace --------------------------------------------

@register("edge_lines", oracle="""
SELECT CAST(user_id AS VARCHAR) AS src, json_extract_string(props, '$.k') AS dst FROM events""")
def q_edge_lines(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    # Mixed separators on purpose: a tab, runs of spaces, a trailing field.
    sep = F.when(F.col("event_id") % 3 == 0, F.lit("\t")).otherwise(F.lit("   "))
    lines = ev.select(F.concat(F.col("user_id").cast("string"), sep,
                               F.get_json_object("props", B.ITEM_JSON_PATH), F.lit(" "),
                               F.col("event_type")).alias("value"))
    return R.parse_edge_lines(lines)


# --- S17: "name, age" lines ----------------------------------------------------------

@register("people_lines", oracle="SELECT c_name AS name, c_nationkey AS age FROM customer")
def q_people_lines(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "people_txt")
    K.write_text_lines(c, path, F.concat_ws(", ", "c_name", F.col("c_nationkey").cast("string")))
    return R.parse_people_lines(R.read_text(spark, path))


# --- F2, F5: range filter and labelled text -----------------------------------------

@register("range_filter", oracle="""
SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 13 AND p_size <= 19""")
def q_range_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(F.col("p_size").between(13, 19)).select("p_partkey", "p_name", "p_size")


@register("labelled_text", oracle="""
SELECT 'Name: ' || c_name AS line FROM customer WHERE c_nationkey >= 13 AND c_nationkey <= 19""")
def q_labelled_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return (c.where(F.col("c_nationkey").between(13, 19))
            .select(F.concat(F.lit("Name: "), F.col("c_name")).alias("line")))


# --- K1 + S6: Parquet round trip -----------------------------------------------------

@register("parquet_roundtrip", oracle="""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_parquet_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer_parquet")
    K.write_parquet(c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), path)
    return spark.read.parquet(path)


# --- S7: JSON file, inferred schema --------------------------------------------------

@register("json_roundtrip", oracle="""
SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS age FROM customer""")
def q_json_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "people_json")
    c.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")).write.json(path)
    return R.read_json(spark, path).select("name", "age")  # age comes back as bigint


# --- S8 + F4: JSON strings with a nested struct --------------------------------------

@register("json_nested_fields", oracle="""
SELECT c_name AS name, c_mktsegment AS city FROM customer""")
def q_json_nested_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    docs = c.select(F.to_json(F.struct(
        F.col("c_name").alias("name"),
        F.struct(F.col("c_mktsegment").alias("city"),
                 F.col("c_nationkey").cast("string").alias("state")).alias("address")))
        .alias("value"))
    people = R.infer_json_column(docs, "value")
    return people.select(F.col("value.name").alias("name"), F.col("value.address.city").alias("city"))


# --- K3 + F3: create table as select -------------------------------------------------

@register("click_table", oracle=f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id,
       {SQL_HOUR} AS t
FROM events WHERE event_type = 'view'""")
def q_click_table(spark, sf_dir):
    name = _unique("user_info")
    B.behavior_log_from_events(table(spark, sf_dir, "events")).createOrReplaceTempView(name)
    click = _unique("click")
    return K.create_table_as(
        spark, click,
        f"SELECT user_id, item_id, time AS t FROM {name} WHERE behavior_type = 1",
        scratch_path(spark, "click"))


# --- K4 + K5 + F14: one partition overwritten, the other left alone -------------------

@register("overwrite_partition", oracle=_with(SQL_VIEWS, sql_similarity_ctes(USER_CAP),
                                              sql_top_k_ctes(TOP_K)) + """
SELECT item_id, item_list, '2031-04-06' AS ds FROM lists
UNION ALL
SELECT item_id, CAST(count(*) AS VARCHAR) AS item_list, '2031-04-05' AS ds
FROM views GROUP BY item_id""")
def q_overwrite_partition(spark, sf_dir):
    t = _unique("related_result")
    K.create_partitioned_table(spark, t, "item_id BIGINT, item_list STRING", "ds",
                               scratch_path(spark, "related_result"))
    v = views(spark, sf_dir)
    lists = _unique("lists")
    S.related_items(v, TOP_K, USER_CAP).createOrReplaceTempView(lists)
    counts = _unique("counts")
    B.item_activity(v).createOrReplaceTempView(counts)
    K.insert_overwrite_partition(spark, t, "ds", "2031-04-05", "SELECT 7, 'yesterday'")
    K.insert_overwrite_partition(spark, t, "ds", "2031-04-06",
                                 f"SELECT item_id, item_list FROM {lists}")
    K.insert_overwrite_partition(spark, t, "ds", "2031-04-05",
                                 f"SELECT item_id, CAST(n_events AS STRING) FROM {counts}")
    return spark.table(t).select("item_id", "item_list", "ds")


# --- W3: ordered limit ---------------------------------------------------------------

@register("ordered_limit", oracle="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_ordered_limit(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return (o.select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10))


# --- F15: dense row index ------------------------------------------------------------

@register("row_index", oracle="""
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index, o_orderkey, o_custkey
FROM orders""")
def q_row_index(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dense_index(o, ["o_orderkey"]).select("row_index", "o_orderkey", "o_custkey")


# --- S10, S12, S13, S14: the parsers of training inputs -------------------------------

def _through_text(spark, name, lines):
    """A frame of one text column, written to the shared folder and read back."""
    path = scratch_path(spark, name)
    lines.write.text(path)
    return R.read_text(spark, path)


@register("ratings_lines", oracle="""
SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(o_orderkey AS INTEGER) AS item,
       CAST(o_totalprice AS DOUBLE) AS rating FROM orders""")
def q_ratings_lines(spark, sf_dir):
    path = scratch_path(spark, "ratings_csv")
    (table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("double"))
     .write.csv(path))
    return R.read_ratings(spark, path)


@register("dense_vector_lines", oracle="""
SELECT CAST(len(embedding) AS INTEGER) AS dims, CAST(embedding[1] AS DOUBLE) AS first,
       CAST(embedding[-1] AS DOUBLE) AS last FROM embeddings""")
def q_dense_vector_lines(spark, sf_dir):
    text = F.transform("embedding", lambda v: v.cast("double").cast("string"))
    lines = _through_text(spark, "vectors_txt", table(spark, sf_dir, "embeddings")
                          .select(F.array_join(text, " ").alias("value")))
    return R.parse_dense_vectors(lines).select(
        F.size("features").alias("dims"), F.element_at("features", 1).alias("first"),
        F.element_at("features", -1).alias("last"))


@register("label_first_lines", oracle="""
SELECT CAST(l_quantity AS DOUBLE) AS label, CAST(l_extendedprice AS DOUBLE) AS x1,
       CAST(l_discount AS DOUBLE) AS x2, CAST(l_tax AS DOUBLE) AS x3 FROM lineitem""")
def q_label_first_lines(spark, sf_dir):
    cols = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    lines = _through_text(spark, "label_first_txt", table(spark, sf_dir, "lineitem").select(
        F.concat_ws(" ", *[F.col(c).cast("double").cast("string") for c in cols]).alias("value")))
    return R.parse_label_first(lines, dims=3).select(
        "label", *[F.col("x")[i].alias(f"x{i + 1}") for i in range(3)])


@register("transaction_lines", oracle="""
SELECT CAST(o_custkey AS VARCHAR) || ',' || o_orderstatus AS items, CAST(3 AS INTEGER) AS n_read,
       CAST(2 AS INTEGER) AS n_items FROM orders""")
def q_transaction_lines(spark, sf_dir):
    """Baskets with a repeated item: read as they stand, counted once."""
    lines = _through_text(spark, "transactions_txt", table(spark, sf_dir, "orders").select(
        F.concat_ws(" ", F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderstatus").alias("value")))
    items = R.parse_transactions(lines).select("items", F.array_distinct("items").alias("kept"))
    return items.select(F.array_join("kept", ",").alias("items"), F.size("items").alias("n_read"),
                        F.size("kept").alias("n_items"))


# --- S9, K6, F16: LibSVM, a replaced view, the seeded random split -----------------------

@register("libsvm_lines", oracle="""
SELECT CAST(label AS DOUBLE) AS label, CAST(embedding[1] AS DOUBLE) AS first,
       CAST(embedding[-1] AS DOUBLE) AS last FROM embeddings""")
def q_libsvm_lines(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    pairs = F.transform("embedding", lambda v, i: F.concat_ws(
        ":", (i + 1).cast("string"), v.cast("double").cast("string")))
    path = scratch_path(spark, "points_libsvm")
    e = table(spark, sf_dir, "embeddings")
    e.select(F.concat_ws(" ", F.col("label").cast("string"), F.array_join(pairs, " ")).alias("value")).write.text(path)
    read = R.read_libsvm(spark, path).select("label", vector_to_array("features").alias("x"))
    return read.select("label", F.element_at("x", 1).alias("first"), F.element_at("x", -1).alias("last"))


@register("replaced_view", oracle="SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey")
def q_replaced_view(spark, sf_dir):
    """A view replaced under the same name answers from its new table."""
    K.replace_view(table(spark, sf_dir, "region"), "replaced_view_source")
    K.replace_view(table(spark, sf_dir, "nation"), "replaced_view_source")
    return spark.sql("SELECT n_regionkey, count(*) AS n FROM replaced_view_source GROUP BY n_regionkey")


@register("random_split_sides", oracle="""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS on_both, CAST(0 AS BIGINT) AS on_none, CAST(0 AS BIGINT) AS moved,
       TRUE AS share_near FROM orders""")
def q_random_split_sides(spark, sf_dir):
    """Every row is on one side, on the same one when split again, and the sides
    have their shares (within five standard deviations)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")

    def sides(name):
        train, test = random_split(o)
        return (train.withColumn(name, F.lit(1)).unionByName(test.withColumn(name, F.lit(2)))
                .groupBy("o_orderkey").agg(F.sum(name).alias(name), F.count(F.lit(1)).alias(f"{name}_n")))

    both = o.join(sides("side"), "o_orderkey", "left").join(sides("again"), "o_orderkey", "left")
    n = F.count(F.lit(1))
    off = F.abs(F.count_if(F.col("side") == 1) - n * F.lit(0.7))
    return both.agg(n.alias("n"), F.count_if(F.col("side_n") > 1).alias("on_both"), F.count_if(F.col("side_n").isNull()).alias("on_none"),
                    F.count_if(~F.col("side").eqNullSafe(F.col("again"))).alias("moved"),
                    (off < F.sqrt(n * F.lit(0.21)) * 5).alias("share_near"))


# --- K4, K5, X9: today's partition, written twice ---------------------------------------

@register("today_partition", oracle=_with(SQL_VIEWS) + """
SELECT item_id, CAST(count(*) AS BIGINT) AS n, 'today' AS day FROM views GROUP BY item_id
UNION ALL
SELECT user_id, count(*), '2031-04-05' FROM views GROUP BY user_id""")
def q_today_partition(spark, sf_dir):
    """The daily write: run twice on one day it replaces today's partition and
    leaves the older one as it was."""
    t = _unique("daily_counts")
    K.create_partitioned_table(spark, t, "item_id BIGINT, n BIGINT", "ds", scratch_path(spark, "daily_counts"))
    v = views(spark, sf_dir)
    today = spark.range(1).select(today_ds()).first()[0]
    older = B.user_activity(v).select(F.col("user_id").alias("item_id"), F.col("n_events").alias("n"))
    K.overwrite_partitions(older.withColumn("ds", F.lit("2031-04-05")), t)
    for part in (older, B.item_activity(v).select("item_id", F.col("n_events").alias("n"))):
        K.overwrite_partitions(part.withColumn("ds", F.lit(today)), t)
    return spark.table(t).select("item_id", "n", F.when(F.col("ds") == today, "today").otherwise(F.col("ds")).alias("day"))


# --- S4, K7: a database of its own, its tables and their schemas ------------------------

@register("table_listing", oracle="""
SELECT 'nation' AS table_name, 'n_nationkey bigint, n_name string' AS columns, count(*) AS n FROM nation
UNION ALL SELECT 'customer', 'c_custkey bigint, c_name string', count(*) FROM customer""")
def q_table_listing(spark, sf_dir):
    """Two tables made in a database that is then the current one, as its catalog
    lists them, with their columns and rows."""
    before, db = spark.catalog.currentDatabase(), _unique("listing")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'listing')}'")
    try:
        K.use_database(spark, db)
        for name, cols in (("nation", ("n_nationkey", "n_name")), ("customer", ("c_custkey", "c_name"))):
            key, text = cols
            view = _unique("rows")
            K.replace_view(table(spark, sf_dir, name).select(F.col(key).cast("long").alias(key), text), view)
            K.create_table_as(spark, name, f"SELECT * FROM {view}", scratch_path(spark, name))
        listed = [r["tableName"] for r in K.list_tables(spark, db).where("not isTemporary").collect()]
        out = None
        for name in listed:
            rows = spark.table(f"{db}.{name}")
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
            part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(columns).alias("columns"), "n")
            out = part if out is None else out.unionByName(part)
    finally:
        K.use_database(spark, before)
    return out
