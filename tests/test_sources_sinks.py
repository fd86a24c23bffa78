from decimal import Decimal
import os

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from coview.operators.layout import dense_index, hash_split
from coview.sources import readers as R
from coview.sources import sinks as K


def _write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_behavior_csv_all_columns(spark):
    df = R.read_behavior_csv(spark, os.path.join(DATA, "behaviour_sample.csv"), keep=None)
    assert df.count() == 20
    assert df.schema.simpleString().startswith("struct<user_id:bigint,item_id:bigint,behavior_type:int")
    assert df.where(F.col("behavior_type") != 1).count() == 2


def test_people_lines_and_range_filter(spark, scratch):
    path = scratch("people")
    _write_lines(spark, path, ["Michael", "Andy, 30", "Justin, 19"])
    people = R.parse_people_lines(R.read_text(spark, path))
    teen = people.where(F.col("age").between(13, 19)).select("name").collect()
    assert [r[0] for r in teen] == ["Justin"]


def test_json_inferred_and_nested(spark, scratch):
    path = scratch("people_json")
    _write_lines(spark, path, ['{"name":"Yin","address":{"city":"Columbus","state":"Ohio"}}',
                               '{"name":"Andy","age":30}'])
    df = R.read_json(spark, path)
    assert [f.name for f in df.schema.fields] == ["address", "age", "name"]  # sorted by name
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)["age"] == "bigint"
    got = {r["name"]: r["city"] for r in df.select("name", F.col("address.city").alias("city")).collect()}
    assert got == {"Yin": "Columbus", "Andy": None}


def test_parse_json_column(spark):
    df = spark.createDataFrame([('{"a": {"b": 3}}',)], "j string")
    out = R.parse_json_column(df, "j", "a struct<b: int>")
    assert out.select("j.a.b").first()[0] == 3


def test_libsvm(spark, scratch):
    path = scratch("libsvm")
    _write_lines(spark, path, ["1 1:0.5 3:2.0", "0 2:1.0"])
    df = R.read_libsvm(spark, path, num_features=3)
    rows = df.orderBy("label").collect()
    assert [r["label"] for r in rows] == [0.0, 1.0]
    assert rows[1]["features"].toArray().tolist() == [0.5, 0.0, 2.0]


def test_label_first_points(spark):
    lines = spark.createDataFrame([("1 " + " ".join(str(i) for i in range(12)),)], "value string")
    got = R.parse_label_first(lines, dims=10).first()
    assert got["label"] == 1.0 and got["x"] == [float(i) for i in range(10)]
    short = spark.createDataFrame([("1 2 3",)], "value string")
    assert R.parse_label_first(short, dims=10, on_bad="drop").count() == 0
    with pytest.raises(Exception):
        R.parse_label_first(short, dims=10).collect()


def test_text_parsers(spark):
    lp = R.parse_labeled_points(spark.createDataFrame([("1,0.5 2",)], "value string")).first()
    assert lp["label"] == 1.0 and lp["features"] == [0.5, 2.0]
    dv = R.parse_dense_vectors(spark.createDataFrame([(" 1 2 ",)], "value string"), trim=True).first()
    assert dv["features"] == [1.0, 2.0]
    tx = R.parse_transactions(spark.createDataFrame([("r z h",)], "value string")).first()
    assert tx["items"] == ["r", "z", "h"]
    ed = R.parse_edge_lines(spark.createDataFrame([("a\t b  c",)], "value string")).first()
    assert (ed["src"], ed["dst"]) == ("a", "b")


def test_ratings_fail_on_bad_text(spark, scratch):
    path = scratch("ratings")
    _write_lines(spark, path, ["1,2,5.0", "x,2,1.0"])
    with pytest.raises(Exception):
        R.read_ratings(spark, path).collect()


def test_parquet_write_fails_if_exists(spark, scratch):
    path = scratch("pq")
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    K.write_parquet(df, path)
    with pytest.raises(Exception):
        K.write_parquet(df, path)
    assert spark.read.parquet(path).count() == 1


def test_partition_overwrite_keeps_other_partitions(spark, scratch):
    K.create_partitioned_table(spark, "related_result_t", "item_id BIGINT, item_list STRING", "ds",
                               scratch("related_result"))
    K.insert_overwrite_partition(spark, "related_result_t", "ds", "2031-04-05",
                                 "SELECT 7, 'yesterday'")
    K.insert_overwrite_partition(spark, "related_result_t", "ds", "2031-04-06", "SELECT 1, 'x'")
    K.insert_overwrite_partition(spark, "related_result_t", "ds", "2031-04-05", "SELECT 2, 'y'")
    got = sorted(tuple(r) for r in spark.table("related_result_t").collect())
    assert got == [(1, "x", "2031-04-06"), (2, "y", "2031-04-05")]


def test_daily_overwrite_replaces_only_its_day(spark, scratch):
    K.create_partitioned_table(spark, "daily_t", "item_id BIGINT, n BIGINT", "ds", scratch("daily"))

    def day(rows):
        return spark.createDataFrame(rows, "item_id long, n long, ds string")

    K.overwrite_partitions(day([(1, 1, "a"), (2, 2, "b")]), "daily_t")
    K.overwrite_partitions(day([(3, 3, "b")]), "daily_t")
    K.overwrite_partitions(day([(3, 3, "b")]), "daily_t")
    assert sorted(tuple(r) for r in spark.table("daily_t").collect()) == [(1, 1, "a"), (3, 3, "b")]
    K.overwrite_partitions(day([]), "daily_t")
    assert spark.table("daily_t").count() == 2


def test_json_schema_of_a_column(spark):
    rows = [('{"b": 1, "a": {"c": "x", "n": null}, "l": [1, 2]}',), ('{"b": 2, "d": 1.5}',), (None,)]
    df = spark.createDataFrame(rows, "v string")
    got = R.infer_json_column(df, "v").select("v.a.c", "v.a.n", "v.b", "v.d", "v.l").collect()
    assert [tuple(r) for r in got] == [("x", None, 1, None, [1, 2]), (None, None, 2, Decimal("1.5"), None), (None,) * 5] or (
        [tuple(r) for r in got] == [("x", None, 1, None, [1, 2]), (None, None, 2, 1.5, None), (None,) * 5])
    assert R.infer_json_column(df.where("false"), "v").count() == 0


def test_access_log_in_one_run(spark):
    line = '10.1.2.3 id me [03/May/2022:10:00:00 +0000] "GET /a b HTTP/1.1" 200 12 "r" "agent" rest'
    rows = [(line,), (line.replace(" 12 ", " - "),), ("no match at all",), ("",), (None,), (line + "\nnext line",)]
    got = [tuple(r) for r in R.parse_access_log(spark.createDataFrame(rows, "value string")).collect()]
    hit = (True, "10.1.2.3", "me", "GET /a b HTTP/1.1", 12)
    assert got == [hit, (*hit[:4], 0), (False, "", "", "", 0), (False, "", "", "", 0), (None, None, None, None, 0), hit]


def test_create_table_as_if_not_exists(spark, scratch):
    loc = scratch("ctas")
    spark.createDataFrame([(1, 1), (2, 2)], "user_id int, b int").createOrReplaceTempView("ui_t")
    t = K.create_table_as(spark, "click_t", "SELECT user_id FROM ui_t WHERE b = 1", loc)
    assert t.count() == 1
    t2 = K.create_table_as(spark, "click_t", "SELECT user_id FROM ui_t", loc)
    assert t2.count() == 1  # left as it was


def test_views_catalog_and_database(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(1,), (2,)], "x int")
    K.replace_view(a, "people_v")
    K.replace_view(b, "people_v")
    assert spark.table("people_v").count() == 2
    names = [r["tableName"] for r in K.list_tables(spark).collect()]
    assert "people_v" in names
    spark.sql("CREATE DATABASE IF NOT EXISTS behavior_db")
    K.use_database(spark, "behavior_db")
    assert spark.catalog.currentDatabase() == "behavior_db"
    K.use_database(spark, "default")


def test_text_sink_vector_format(spark, scratch):
    path = scratch("factors")
    df = spark.createDataFrame([(7, [1.0, 0.5])], "id int, features array<float>")
    K.write_text_lines(df, path, K.vector_text("id", "features"))
    assert [r[0] for r in spark.read.text(path).collect()] == ["7,[1.0, 0.5]"]


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("k"))
    got = dense_index(df, ["k"], num_partitions=7).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(5000))
    ks = [r["k"] for r in got]
    assert ks == sorted(ks)


def test_hash_split_repeatable(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "key")
    tr, te = hash_split(df, "key")
    tr2, _ = hash_split(df, "key")
    assert tr.count() + te.count() == 1000
    assert sorted(r[0] for r in tr.collect()) == sorted(r[0] for r in tr2.collect())
    assert 600 <= tr.count() <= 800


def test_dense_index_hot_equal_key(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"))
    got = dense_index(df, ["k"], num_partitions=6).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(3000))
    ks = [r["k"] for r in got]
    assert ks == sorted(ks)


def test_random_split_seeded(spark):
    from coview.operators.layout import random_split
    df = spark.range(0, 2000)
    a1, b1 = random_split(df, seed=7)
    a2, _ = random_split(df, seed=7)
    assert a1.count() + b1.count() == 2000
    assert sorted(r[0] for r in a1.collect()) == sorted(r[0] for r in a2.collect())


def test_widen_only_spreads_narrow_inputs(spark):
    from coview.operators.layout import widen
    target = spark.sparkContext.defaultParallelism
    narrow = spark.range(0, 100, numPartitions=1)
    assert widen(narrow).rdd.getNumPartitions() == target
    wide = spark.range(0, 100, numPartitions=target + 3)
    assert widen(wide) is wide


def test_unset_checkpoint_folder_is_an_error_on_a_cluster():
    from coview.session import _own_folder
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _own_folder(master)
    assert _own_folder("local[4]")
