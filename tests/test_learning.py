from pyspark.sql import functions as F

from conftest import SF_SMALL
from coview.operators import cluster as C
from coview.operators import evaluate as EV
from coview.operators import mining as M
from coview.operators import trees as T


def test_graph_clusters_fixture(spark):
    rows = [(0, 1, 0.9), (1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.1), (4, 5, 0.9)]
    e = spark.createDataFrame(rows, "src long, dst long, weight double")
    got = {r["id"]: r["cluster"] for r in C.power_iteration_clusters(e, k=2, max_iter=10).collect()}
    groups = {}
    for i, c in got.items():
        groups.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == [[0, 1, 2, 3], [4, 5]]


def test_frequent_itemsets_small(spark):
    tx = spark.createDataFrame([(["r", "z", "h"],), (["z", "y"],), (["z", "r"],), (["x"],)],
                               "items array<string>")
    got = {r["itemset"]: r["freq"] for r in M.frequent_itemsets(tx, min_support=0.5).collect()}
    assert got == {"z": 3, "r": 2, "r,z": 2}


def _itemsets(rows, min_support):
    """All itemsets of at least ceil(min_support * n) baskets, by brute force."""
    import math
    from itertools import combinations
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    counts = {}
    least = max(1, math.ceil(min_support * len(baskets)))
    often = {i for i in set().union(*baskets.values()) if sum(i in items for items in baskets.values()) >= least}
    for items in baskets.values():
        items = sorted(items & often)
        for size in range(1, len(items) + 1):
            for c in combinations(items, size):
                counts[c] = counts.get(c, 0) + 1
    return {(",".join(c), len(c), n) for c, n in counts.items() if n >= least}


def test_vertical_itemsets_against_brute_force(spark):
    import random
    rnd = random.Random(5)
    rows = [(f"b{b}", i) for b in range(300) for i in "abcdefgh" if rnd.random() < 0.6 - 0.05 * "abcdefgh".index(i)]
    rows += [("big", f"x{i}") for i in range(400)] + [("b1", "a"), ("b1", "a"), (None, "a"), ("b2", None)]
    df = spark.createDataFrame(rows, "basket string, item string")
    for support in (0.5, 0.1, 0.02):
        got = {tuple(r) for r in M.vertical_itemsets(df, "basket", "item", support).collect()}
        assert got == _itemsets(rows, support)
    assert max(s for _, s, _ in got) >= 4
    tx = M.transactions(df.dropna(), "basket", "item")
    assert {tuple(r) for r in M.frequent_itemsets(tx, min_support=0.1).collect()} == _itemsets(rows, 0.1)


def test_vertical_itemsets_over_several_chunks(spark):
    n = (1 << 15) + 500     # more baskets than one bitmap holds
    rows = spark.range(n).select("id", F.explode(F.array(
        F.lit("a"), F.when(F.col("id") % 2 == 0, "b"), F.when(F.col("id") % 3 == 0, "c"))).alias("item"))
    got = {r["itemset"]: r["freq"] for r in M.vertical_itemsets(rows, "id", "item", 0.01).collect()}
    two, three, six = (len(range(0, n, k)) for k in (2, 3, 6))
    assert got == {"a": n, "b": two, "c": three, "a,b": two, "a,c": three, "b,c": six, "a,b,c": six}


def test_vertical_itemsets_of_nothing(spark):
    assert M.vertical_itemsets(spark.createDataFrame([], "b long, i string"), "b", "i").count() == 0


def test_transactions_dedupe(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "o long, t string")
    tx = M.transactions(rows, "o", "t").first()
    assert sorted(tx["items"]) == ["a", "b"]


def test_als_factor_shapes(spark):
    rows = [(u, i, float((u + i) % 5 + 1)) for u in range(10) for i in range(8) if (u * i) % 3 != 1]
    r = spark.createDataFrame(rows, "user int, item int, rating double")
    users, items = M.als_factors(r, rank=3, iterations=5)
    assert users.count() == 10 and items.count() == 8
    assert users.select(F.size("features")).first()[0] == 3


def test_kmeans_two_blobs(spark):
    pts = spark.createDataFrame([([0.0, 0.0],), ([0.1, 0.0],), ([10.0, 10.0],), ([10.1, 10.0],)],
                                "v array<double>")
    centers, cost = C.kmeans(C.as_vectors(pts, "v"), k=2, runs=2)
    got = sorted(tuple(round(x, 2) for x in r["center"]) for r in centers.collect())
    assert got == [(0.05, 0.0), (10.05, 10.0)]
    assert cost < 0.1


def test_lda_topic_matrix_complete(spark):
    docs = spark.createDataFrame([(0, "apple banana apple"), (1, "car bus car"), (2, "apple bus")],
                                 "doc_id long, text string")
    topics = C.lda_topics(C.term_counts(C.tokens(docs)), k=2, rounds=5)
    assert topics.count() == 2 * 4   # every term under every topic
    sums = [r[1] for r in topics.groupBy("topic").agg(F.sum("weight")).collect()]
    assert all(abs(s - 1.0) < 1e-6 for s in sums)


def test_lda_in_blocks_equals_em_by_edge(spark):
    """Edges of null and of repeated ids, several blocks: the rounds done edge by edge."""
    from coview.operators.topics import lda_topics
    k, alpha, eta = 3, 50.0 / 3, 1.1 - 1.0
    texts = [(i % 11 if i % 9 else None, " ".join("w" * ((i * j) % 7 + 1) + "abcd"[(i + j) % 4] for j in range(i % 13)))
             for i in range(40)] + [(-5, "Gr\u00fc\u00dfe w"), (None, "alone alone"), (3, None)]
    counts = C.term_counts(C.tokens(spark.createDataFrame(texts, "doc_id long, text string")))
    edges = [(r["doc"], r["term"], r["n"]) for r in counts.collect()]
    for rounds in (0, 3):
        share = {}
        for d, t, _ in edges:
            own = None if d is None else (d + len(t)) % k
            share[d, t] = [0.6 if own == x else 0.2 for x in range(k)]
        live = edges
        for turn in range(rounds + 1):
            w, by_doc = {}, {}
            for d, t, n in live:
                for key, sums in ((t, w), (d, by_doc)):
                    old = sums.setdefault(key, [0.0] * k)
                    for x in range(k):
                        old[x] += n * share[d, t][x]
            total = [sum(v[x] for v in w.values()) for x in range(k)]
            if turn == rounds:
                break
            live = [e for e in edges if e[0] is not None]
            for d, t, _ in live:
                raw = [(w[t][x] + eta) * (by_doc[d][x] + alpha) / (total[x] + len(w) * eta) for x in range(k)]
                share[d, t] = [r / sum(raw) for r in raw]
        got = {(r["topic"], r["term"]): r["weight"] for r in lda_topics(counts, k, rounds, block_edges=40).collect()}
        assert got.keys() == {(x, t) for t in w for x in range(k)}
        assert all(abs(got[x, t] - w[t][x] / total[x]) < 1e-12 for x, t in got)
        assert ("alone" in w) == (rounds == 0)
    assert lda_topics(counts.limit(0), k, 2).isEmpty()


def test_trees_beat_constant_predictor(spark):
    from coview.plans.learning_queries import _price_points
    data = _price_points(spark, SF_SMALL)
    model, metrics = T.tree_regressor(data)
    mse = {r["metric"]: r["value"] for r in metrics.collect()}["train_mse"]
    var = data.agg(F.var_pop("label")).first()[0]
    assert 0 <= mse < var
    assert "DecisionTreeRegressionModel" in T.model_text(model, full=False)
    assert "If (feature" in T.model_text(model, full=True)


def test_error_measures(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (2.0, 0.0)], "p double, y double")
    assert abs(EV.mean_squared_error(df, "p", "y").first()[0] - 5 / 3) < 1e-12
    assert abs(EV.error_rate(df, "p", "y").first()[0] - 2 / 3) < 1e-12
    assert EV.class_count(df, "y").first()[0] == 2
    assert EV.mean_squared_error(df.where("p > 5"), "p", "y").first()[0] is None


def test_als_rmse_bound(spark):
    # Ratings from a rank-2 structure: the factors must reproduce them closely.
    rows = [(u, i, float(1 + (u % 3) + 2 * (i % 2))) for u in range(20) for i in range(12)]
    r = spark.createDataFrame(rows, "user int, item int, rating double")
    users, items = M.als_factors(r, rank=4, iterations=15, reg=0.01)
    pred = (r.join(users.withColumnRenamed("id", "user").withColumnRenamed("features", "uf"), "user")
             .join(items.withColumnRenamed("id", "item").withColumnRenamed("features", "itf"), "item")
             .select("rating", F.aggregate(F.zip_with("uf", "itf", lambda a, b: a * b), F.lit(0.0),
                                           lambda acc, v: acc + v).alias("p")))
    rmse = pred.agg(F.sqrt(F.avg(F.pow(F.col("p") - F.col("rating"), 2)))).first()[0]
    assert rmse < 0.1


# --- keyed factorisation, k-means and power iteration -----------------------------

def _solve(a, b):
    import numpy as np
    return np.linalg.solve(np.array(a), np.array(b))


def test_als_rounds_against_numpy(spark):
    import hashlib
    import numpy as np
    from coview.operators import factors as FA
    rows = [(f"u{u}", f"é{i}", float((u * i) % 5 + 1)) for u in range(14) for i in range(9) if (u + i) % 3]
    rows += [("u0", "hot", 2.0), ("u0", "hot", 4.0)] + [(f"v{k}", "hot", 1.0 + k % 4) for k in range(60)]
    bad = [(None, "é1", 1.0), ("u1", None, 1.0), ("u1", "é1", None)]
    df = spark.createDataFrame(rows + bad, "user string, item string, rating double")
    rank, reg = 3, 0.07
    users, items = FA.alternating_least_squares(df, rank, 2, reg)

    def start(key):
        return [0.1 + int(hashlib.md5(f"{key}:{j}".encode()).hexdigest()[:6], 16) / (1 << 24) for j in range(rank)]

    want_u = {u: np.array(start(u)) for u, _, _ in rows}
    for _ in range(2):
        want_i = {}
        for key, side, other in (("i", 1, 0), ("u", 0, 1)):
            fixed = want_u if key == "i" else want_i
            solved = {}
            for k in {r[side] for r in rows}:
                own = [(fixed[r[other]], r[2]) for r in rows if r[side] == k]
                a = sum(np.outer(v, v) for v, _ in own) + reg * len(own) * np.eye(rank)
                solved[k] = _solve(a, sum(v * x for v, x in own))
            if key == "i":
                want_i = solved
            else:
                want_u = solved
    for got, want, key in ((users, want_u, "user"), (items, want_i, "item")):
        found = {r[key]: [r[f"f{j}"] for j in range(rank)] for r in got.collect()}
        assert found.keys() == want.keys()
        assert all(np.allclose(found[k], want[k], rtol=1e-8, atol=1e-10) for k in want)
    sums = FA.gram_sums(df.dropna(), items, "user", "item", "rating", rank)
    off = FA.residuals(sums, users, "user", rank, reg)
    assert off.agg(F.max("residual")).first()[0] < 1e-9
    wrong = users.withColumn("f0", F.col("f0") + 0.01)
    assert FA.residuals(sums, wrong, "user", rank, reg).agg(F.min("residual")).first()[0] > 1e-6


def test_als_packs_a_long_key_in_parts(spark):
    from coview.operators import factors as FA
    rows = [("hot", f"i{k}", float(k % 5)) for k in range(200)] + [("u", "i1", 1.0), (None, "i1", 3.0)]
    df = spark.createDataFrame(rows, "user string, item string, rating double")
    pack = FA.packed(df, "user", "item", "rating", 20).collect()
    held = {"hot": [], "u": []}
    for r in pack:
        held[r["user"]].append([tuple(e) for e in r["_entries"]])
    assert len(held["hot"]) > 5 and max(map(len, held["hot"])) < 60 and len(held["u"]) == 1
    assert sorted(e for c in held["hot"] for e in c) == sorted((i, x) for u, i, x in rows if u == "hot")
    one, many = (FA.gram_sums(df, spark.createDataFrame([("hot", 2.0), ("u", 3.0)], "user string, f0 double"),
                              "item", "user", "rating", 1, c).orderBy("item").collect() for c in (1000, 20))
    assert one == many and len(one) == 200 and one[1]["n"] == 2 and one[1]["g0_0"] == 13.0


def test_points_of_one_file_are_dealt_by_rows(spark):
    from coview.operators.layout import deal
    rows = spark.range(5000).coalesce(1)
    dealt = deal(rows, "dealt", 250)
    assert dealt.rdd.getNumPartitions() == 20
    assert dealt.agg(F.sum("id"), F.count("id")).first() == (5000 * 4999 // 2, 5000)


def test_boosting_report_is_one_pass(spark):
    data = _grid_points(spark)
    model, _ = T.gbt_regressor(data, rounds=2, max_depth=2)
    plan = T.boosting_report(model, data)._jdf.queryExecution().executedPlan().toString()
    # one join with the report's nodes, none for the walk
    assert plan.count("Join") == 1 and plan.count("Generate") == 2


def test_kmeans_rounds_are_means_of_nearest(spark):
    import random
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(10 * (i % 3), 1), rnd.gauss(-5 * (i % 3), 1)]) for i in range(150)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, point array<double>")
    centers, points = C.kmeans_rounds(df, 3, 8)
    by = {}
    for r in centers.collect():
        by.setdefault(r["cluster"], {})[r["dim"]] = (r["value"], r["n"])
    got = {r["id"]: (r["cluster"], r["cost"]) for r in points.collect()}
    assert set(got) == set(range(150))
    for i, p in rows[:150]:
        costs = {c: sum((p[d] - v[d][0]) ** 2 for d in v) for c, v in by.items()}
        assert got[i][0] == min(costs, key=costs.get) and abs(got[i][1] - min(costs.values())) < 1e-9
    for c, dims in by.items():        # the rounds have settled: centers are the means of their points
        own = [p for i, p in rows[:150] if got[i][0] == c]
        assert all(abs(sum(p[d] for p in own) / len(own) - dims[d][0]) < 1e-9 and dims[d][1] == len(own) for d in dims)


def test_power_rounds_against_plain_arithmetic(spark):
    rows = [(0, 1, 0.9), (1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.1), (4, 5, 0.9), (5, 5, 7.0)]
    df = spark.createDataFrame(rows, "src long, dst long, weight double")
    w = {}
    for a, b, x in rows:
        if a != b:
            w[a, b] = w[b, a] = x
    deg = {i: sum(x for (a, _), x in w.items() if a == i) for i in range(6)}
    v = {i: d / sum(deg.values()) for i, d in deg.items()}
    for _ in range(10):
        v = {i: sum(x * v[b] for (a, b), x in w.items() if a == i) / deg[i] for i in v}
        v = {i: x / sum(v.values()) for i, x in v.items()}
    got = {r["id"]: r["value"] for r in C.power_rounds(df, 10).collect()}
    assert got.keys() == v.keys() and all(abs(got[i] - v[i]) < 1e-12 for i in v)
    # a loose tolerance ends the iteration after its second round
    early = {r["id"]: r["value"] for r in C.power_rounds(df, 10, tolerance=10.0).collect()}
    two = {r["id"]: r["value"] for r in C.power_rounds(df, 2).collect()}
    assert early == two
    found = {r["id"]: r["cluster"] for r in C.power_clusters(df, 2, 10).collect()}
    assert len({found[i] for i in range(4)}) == 1 and found[4] == found[5] != found[0]


# --- fitted trees as tables --------------------------------------------------------

def _grid_points(spark, n=900, noise=3):
    rows = [(float(i % 7), float(i % 5), float((i * i) % 11), 2.0 * (i % 7 > 3) + (i % 5) * 0.5 + (i * 37 % noise)) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    return T.assemble(df, ["a", "b", "c"], "y")


def test_walk_scores_as_the_model_does(spark):
    data = _grid_points(spark)
    for model in (T.tree_regressor(data, 4)[0], T.forest_regressor(data, data, 3, 3, bootstrap=False)[0]):
        keyed = data.withColumn("row", F.monotonically_increasing_id())
        walked = T.walk(keyed, T.node_table(model), T.tree_depth(model)).groupBy("row").agg(F.avg("prediction").alias("w"))
        both = model.transform(keyed).join(walked, "row")
        assert both.where(F.abs(F.col("w") - F.col("prediction")) > 1e-9).count() == 0 and both.count() == 900


def test_stump_is_the_best_split(spark):
    data = _grid_points(spark)
    rows = [(r["features"].toArray().tolist(), r["label"]) for r in data.collect()]

    def sse(ys):
        m = sum(ys) / len(ys)
        return sum((y - m) ** 2 for y in ys)

    best = None
    for f in range(3):
        values = sorted({x[f] for x, _ in rows})
        for lo, hi in zip(values, values[1:]):
            cut = (lo + hi) / 2
            left, right = [y for x, y in rows if x[f] <= cut], [y for x, y in rows if x[f] > cut]
            got = sse(left) + sse(right)
            if best is None or got < best[0] - 1e-9:
                best = (got, f, cut, left, right)
    report = {r["node"]: r for r in T.node_report(data, T.tree_regressor(data, 1)[0]).collect()}
    assert (report[1]["feature"], report[1]["threshold"], report[1]["n"]) == (best[1], best[2], 900)
    for node, ys in ((2, best[3]), (3, best[4])):
        assert report[node]["feature"] is None and report[node]["n"] == len(ys)
        assert abs(report[node]["prediction"] - sum(ys) / len(ys)) < 1e-9


def test_every_node_says_the_mean_of_its_rows(spark):
    data = _grid_points(spark)
    model, _ = T.gbt_regressor(data, rounds=3, max_depth=3)
    report = T.boosting_report(model, data).collect()
    assert {r["tree"] for r in report} == {0, 1, 2}
    assert all(abs(r["mean"] - r["prediction"]) < 1e-9 for r in report)
    binary = data.withColumn("label", (F.col("label") > 2).cast("double"))
    model, _ = T.gbt_classifier(binary, rounds=3, max_depth=2)
    report = T.boosting_report(model, binary, "logistic").collect()
    assert all(abs(r["mean"] - r["prediction"]) < 1e-9 for r in report)
    model, _ = T.forest_classifier(binary, binary, 3, 3, bootstrap=False)
    audit = T.forest_audit(model, binary, binary, "classification").collect()
    assert [(r["n"], r["leaves_off"], r["rows_off"]) for r in audit] == [(900, 0, 0)] * 3
    # a model fitted on other rows is caught
    half = binary.where(F.rand(3) < 0.3)
    model, _ = T.forest_classifier(half, half, 3, 3, bootstrap=False)
    assert sum(r["leaves_off"] for r in T.forest_audit(model, binary, binary, "regression").collect()) > 0


def test_boosting_learns_cells_as_rows(spark):
    """The trees that Spark ML grows on the rows, one weighted row for those of equal features."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor
    data = _grid_points(spark)
    binary = data.withColumn("label", (F.col("label") > 2).cast("double"))
    held = T.cells(data)
    assert held.count() == data.select("features").distinct().count() == 210
    assert held.agg(F.sum("n")).first()[0] == 900
    for rows, kept, fit, est, loss, kind in (
            (data, held, T.gbt_regressor, GBTRegressor, "squared", {"lossType": "squared"}),
            (binary, T.cells(binary, True), T.gbt_classifier, GBTClassifier, "logistic", {})):
        # 40 rows on either side are far more than 40 cells would be
        plain = est(maxIter=3, maxDepth=3, seed=1, minInstancesPerNode=40, **kind).fit(rows)
        want = sorted((r["tree"], r["node"], r["feature"], r["threshold"], r["n"], round(r["prediction"], 9))
                      for r in T.boosting_report(plain, rows, loss).collect())
        model, metrics = fit(kept, rounds=3, max_depth=3, min_rows=40)
        report = T.boosting_report(model, kept, loss).collect()
        assert sorted((r["tree"], r["node"], r["feature"], r["threshold"], r["n"], round(r["prediction"], 9)) for r in report) == want
        assert all(abs(r["mean"] - r["prediction"]) < 1e-9 for r in report)
        off = F.avg((F.col("label") - F.col("prediction")) ** 2)   # for classes the share of wrong ones
        assert abs(metrics.first()["value"] - plain.transform(rows).agg(off).first()[0]) < 1e-9
    few = data.limit(30)
    assert T.gbt_regressor(few, rounds=1, max_depth=3, min_rows=20)[0].trees[0].depth == 0
    test_model, test_metrics = T.gbt_regressor(held, data, rounds=1, max_depth=2)
    want = test_model.transform(data).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert test_metrics.first()["metric"] == "test_mse" and abs(test_metrics.first()["value"] - want) < 1e-9


def test_gbt_classifier_runs_all_rounds_on_cells(spark, monkeypatch):
    """Ten rounds of depth 5, as the reference's runner and the regressor; the rows are read for the cells only."""
    from coview.operators import trees
    from coview.plans import learning_queries as L
    from coview.plans.registry import oracle_sql
    dealt, real = [], trees.deal
    monkeypatch.setattr(trees, "deal", lambda df, name, *a: dealt.append(name) or real(df, name, *a))
    got = L.q_gbt_classifier(spark, SF_SMALL).collect()
    assert dealt == ["boost_cells"]
    assert {r["tree"] for r in got} == set(range(10)) and max(r["node"] for r in got) >= 32
    assert "m9nodes" in oracle_sql()["gbt_classifier"] and "m0r5 " in oracle_sql()["gbt_classifier"]


def test_lda_query_runs_all_rounds(spark, monkeypatch):
    """Twenty rounds, the default of the reference's LDA, in the query and its SQL."""
    from coview.operators import cluster
    from coview.plans import learning_queries as L
    from coview.plans.registry import oracle_sql
    asked = []
    real = spark.createDataFrame([(0, "a", 1.0)], "topic int, term string, weight double")
    monkeypatch.setattr(cluster, "lda_topics", lambda counts, k, rounds: asked.append((k, rounds)) or real)
    L.q_lda_topics(spark, SF_SMALL)
    assert asked == [(3, 20)]
    assert "w20_" in oracle_sql()["lda_topics"]
