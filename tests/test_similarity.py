import os

from conftest import DATA
from coview.operators import behavior as B
from coview.operators import similarity as S
from coview.sources.readers import read_behavior_csv


def _lists(df):
    return {r["item_id"]: r["item_list"] for r in df.collect()}


def test_tiny_triples_expected_lists(spark):
    pairs = read_behavior_csv(spark, os.path.join(DATA, "tiny_triples.csv"), keep=1)
    got = _lists(S.related_items(pairs, k=10, cap=100))
    assert got == {1: "2:0.57735", 2: "3:0.70711;1:0.57735", 3: "2:0.70711"}


def test_behavior_sample_four_mutual_pairs(spark):
    pairs = read_behavior_csv(spark, os.path.join(DATA, "behaviour_sample.csv"), keep=1)
    assert pairs.count() == 18
    got = _lists(S.related_items(pairs))
    assert got == {
        601: "602:1.00000",
        602: "601:1.00000",
        603: "604:1.00000",
        604: "603:1.00000",
    }


def test_weights_use_all_users_pairs_only_capped(spark):
    # user 1: items 1,2 (2 distinct); user 2: items 1,2,3 (3 distinct, over cap=3)
    rows = [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3)]
    pairs = spark.createDataFrame(rows, "user_id long, item_id long")
    dc = S.damped_counts(pairs)
    w = {r["item_id"]: r["weight"] for r in S.item_weights(dc).collect()}
    import math
    assert abs(w[1] - (1 / math.log(3) + 1 / math.log(4))) < 1e-12
    ps = S.item_pair_scores(dc, cap=3).collect()
    assert [(r["item_a"], r["item_b"]) for r in ps] == [(1, 2)]
    assert abs(ps[0]["pair_score"] - 1 / math.log(3)) < 1e-12


def test_properties_on_events(spark):
    from coview.plans.behavior_queries import views
    from conftest import SF_SMALL
    v = views(spark, SF_SMALL)
    sim = S.item_similarity(v, cap=100).collect()
    d = {(r["item_id"], r["other_id"]): r["score"] for r in sim}
    assert d, "no pairs"
    for (a, b), s in d.items():
        assert a != b and s > 0 and s <= 1 + 1e-9
        assert abs(d[(b, a)] - s) < 1e-12          # symmetric
    ranked = S.top_k(S.item_similarity(v, cap=100), k=3)
    per = {}
    for r in ranked.collect():
        per.setdefault(r["item_id"], []).append(r["rank"])
    for ranks in per.values():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))   # 1..k, no gaps
        assert len(ranks) <= 3


def test_behavior_counts_long_format(spark):
    log = spark.createDataFrame(
        [("1", "10", "1", "t"), ("1", "11", "1", "t"), ("2", "10", "1", "t"), ("2", "10", "2", "t")],
        "user_id string, item_id string, behavior_type string, time string")
    got = {r["metric"]: r["value"] for r in B.behavior_counts(log, min_events=1, cap=100).collect()}
    assert got == {"rows": 4, "views": 3, "users": 2, "baskets": 2, "items": 2, "active_items": 1}


def test_shown_items_limit_and_semi_join(spark):
    lists = spark.createDataFrame([(i, f"x{i}") for i in range(300)], "item_id long, item_list string")
    active = spark.createDataFrame([(i, 99) for i in range(0, 300, 2)], "item_id long, n_events long")
    got = S.shown_items(lists, active, n=101).collect()
    assert len(got) == 101 and all(r["item_id"] % 2 == 0 for r in got)
    assert [r["item_id"] for r in got] == list(range(0, 202, 2))


def test_user_baskets_respects_cap(spark):
    rows = [(1, i) for i in range(5)] + [(2, 1), (2, 1), (2, 2)]
    pairs = spark.createDataFrame(rows, "user_id long, item_id long")
    got = {r["user_id"]: r["item_list"] for r in B.user_baskets(pairs, cap=5).collect()}
    assert got == {2: "1:2,2:1"}


def test_lists_do_not_depend_on_salts(spark):
    from coview.plans.behavior_queries import views
    from conftest import SF_SMALL
    v = views(spark, SF_SMALL)
    base = _lists(S.related_items(v))
    for salts in (1, 2, 50):
        assert _lists(S.related_items(v, salts=salts)) == base


def _hot(spark):
    from pyspark.sql import functions as F
    big = spark.range(0, 3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    big = big.unionByName(spark.range(0, 6000).select(F.lit(3).cast("long").alias("k"), F.col("id").alias("v")))
    big = big.unionByName(spark.createDataFrame([(None, 1), (99, 2)], "k long, v long"))
    return big, spark.range(0, 8).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))


def test_salted_join_matches_plain_join(spark):
    from coview.operators.layout import salted_join
    big, small = _hot(spark)
    want = sorted(tuple(r) for r in big.join(small, "k").collect())
    for salts in (None, 1, 16):
        assert sorted(tuple(r) for r in salted_join(big, small, "k", ["v"], salts).collect()) == want


def test_salted_join_spreads_a_hot_key(spark):
    from coview.operators.layout import salted_join
    from pyspark.sql import functions as F
    big, small = _hot(spark)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                           "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        joined = salted_join(big, small, "k", ["v"])
        per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    # 71 % of the rows have one key; dealt by the key alone they would be one task's
    assert sum(per_task) == 9000 and len(per_task) >= 28 and max(per_task) < 900
    assert "Broadcast" not in plan


def test_one_user_with_a_third_of_all_rows(spark):
    rows = [(1, i) for i in range(400)] + [(u, u % 37 + j) for u in range(2, 202) for j in range(4)]
    pairs = spark.createDataFrame(rows, "user_id long, item_id long")
    calm = spark.createDataFrame([r for r in rows if r[0] != 1], "user_id long, item_id long")
    baskets = {r["user_id"]: r["item_list"] for r in B.user_baskets(pairs, cap=100).collect()}
    assert 1 not in baskets and baskets == {r["user_id"]: r["item_list"] for r in B.user_baskets(calm, cap=100).collect()}
    # the heavy user makes no pairs but counts in the weights
    got = {(r["item_a"], r["item_b"]) for r in S.item_pair_scores(S.damped_counts(pairs), 100).collect()}
    assert got == {(a, b) for _, a in rows for b in range(a + 1, a + 4) if any(
        (u, a) in set(rows) and (u, b) in set(rows) for u in range(2, 202))}


def test_pair_tasks_follow_the_pairs(spark):
    from coview.operators.layout import spread_by_pairs
    df = spark.range(10).withColumnRenamed("id", "user_id")
    assert spread_by_pairs(df, "user_id", 1000, least=1, per_task=100).rdd.getNumPartitions() == 10
    assert spread_by_pairs(df, "user_id", 0, least=3).rdd.getNumPartitions() == 3


def test_behavior_counts_scan_the_log_once(spark, tmp_path):
    log = spark.createDataFrame(
        [("1", "10", "1", "t"), ("1", None, "1", "t"), (None, "10", "1", "t"), ("2", "10", None, "t"), ("2", "x", "2", "t")],
        "user_id string, item_id string, behavior_type string, time string")
    log.write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    out = B.behavior_counts(log, min_events=1, cap=2, partnered=lambda cui: S.items_with_partners(S.with_user_totals(cui), 3))
    assert f"{tmp_path}/log" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["metric"]: r["value"] for r in out.collect()} == {
        "rows": 5, "views": 3, "users": 2, "baskets": 1, "items": 2, "active_items": 1, "output": 2}


def test_items_with_partners_equals_items_in_similarity(spark):
    from coview.plans.behavior_queries import views
    from conftest import SF_SMALL
    v = views(spark, SF_SMALL)
    for cap in (3, 5, 100):
        a = {r[0] for r in S.items_with_partners(S.damped_counts(v), cap).collect()}
        b = {r[0] for r in S.item_similarity(v, cap).select("item_id").distinct().collect()}
        assert a == b


def test_event_cap_variant(spark):
    pairs = read_behavior_csv(spark, os.path.join(DATA, "tiny_triples.csv"), keep=1)
    # users 2 and 3 have 3 events each: an event cap of 3 leaves no pairs,
    # an event cap of 4 gives the item-cap result.
    assert S.related_items(pairs, cap=3, cap_on="events").count() == 0
    got = _lists(S.related_items(pairs, cap=4, cap_on="events"))
    assert got == {1: "2:0.57735", 2: "3:0.70711;1:0.57735", 3: "2:0.70711"}


def _basket_log(spark):
    """A hot item, users over the cap, repeats, equal scores and nulls."""
    rows = [(u, i) for u in range(60) for i in (7, u % 13 + 100, (u * u) % 17 + 200, u % 5 + 300, u % 5 + 300)]
    rows += [(900, i) for i in range(400)] + [(901, 1), (None, 7), (902, None), (902, 7), (902, -4)]
    return spark.createDataFrame(rows, "user_id long, item_id long")


def test_best_partners_in_parts_and_rounds(spark):
    pairs = _basket_log(spark)
    want = _lists(S.top_k_list(S.top_k(S.item_similarity(pairs, 100), 4, round_scores=False)))
    assert len(want) == 29
    # one part; many parts in many rounds; some items hot; all items hot
    for part_pairs, round_pairs in ((1 << 20, None), (20, 50), (60, 100), (1, None)):
        got = _lists(S.related_items(pairs, 4, part_pairs=part_pairs, round_pairs=round_pairs))
        assert got == want, (part_pairs, round_pairs)
    texts = pairs.selectExpr("user_id", "concat('i', item_id) as item_id")
    assert _lists(S.related_items(texts, 4)) == _lists(S.top_k_list(S.top_k(S.item_similarity(texts, 100), 4)))


def test_rounds_shuffle_baskets_and_not_all_pairs(spark):
    import glob
    from coview.session import checkpoint_root
    parts = f"{checkpoint_root(spark).removeprefix('file:')}/coview/partners-*"
    before = set(glob.glob(parts))
    S.related_items(_basket_log(spark), 2, part_pairs=60, round_pairs=200).count()
    made = [spark.read.parquet(p) for p in set(glob.glob(parts)) - before]
    assert len(made) == 3
    # a round returns the best two of its own items and no pair more
    items = [{r["item_id"] for r in m.collect()} for m in made]
    assert sum(map(len, items)) == len(set().union(*items))
    assert all(m.count() <= 2 * len(own) for m, own in zip(made, items, strict=True))
