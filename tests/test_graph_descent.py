import math

from coview.operators import descent as D
from coview.operators import graph as G


def _edges(spark, rows):
    return spark.createDataFrame(rows, "src long, dst long")


def test_closure_triangle_includes_self_pairs(spark):
    got = {tuple(r) for r in G.transitive_closure(_edges(spark, [(1, 2), (2, 3), (3, 1)])).collect()}
    assert got == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3)}


def test_closure_long_chain_and_idempotence(spark):
    n = 12   # needs as many rounds as the chain is long
    tc = G.transitive_closure(_edges(spark, [(i, i + 1) for i in range(n)]))
    assert tc.count() == n * (n + 1) // 2
    assert G.transitive_closure(tc).count() == n * (n + 1) // 2


def test_closure_of_nothing_and_of_loops(spark):
    assert G.transitive_closure(_edges(spark, [])).count() == 0
    got = {tuple(r) for r in G.transitive_closure(_edges(spark, [(1, 1), (1, 2), (None, 2), (2, None)])).collect()}
    assert got == {(1, 1), (1, 2)}   # an edge without both ends is none


def test_closure_of_a_hub(spark):
    # a third of all edges enter one node, which has three ways on
    rows = [(i, 0) for i in range(1, 60)] + [(0, -1), (0, -2), (0, -3), (-3, -4)] + [(100 + i, 101 + i) for i in range(0, 60, 2)]
    want = set(rows) | {(i, j) for i in range(1, 60) for j in (-1, -2, -3, -4)} | {(0, -4)}
    for salts in (1, 7):
        assert {tuple(r) for r in G.transitive_closure(_edges(spark, rows), salts=salts).collect()} == want


def test_closure_round_moves_only_what_it_finds(spark):
    import re
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    state = None
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        state = G.ClosureState(_edges(spark, [(i, i + 1) for i in range(12)]))
        assert state.advance() and state.advance()
        plan = state.found()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
        if state:
            state.close()
    assert len(re.findall(r"\bExchange ", plan)) == 1 and plan.count("Bucketed: true") == 3


def test_pagerank_by_hand(spark):
    e = _edges(spark, [(1, 2), (1, 2), (2, 3), (3, 2)])  # a=1, b=2, c=3
    r1 = {r["node"]: r["rank"] for r in G.pagerank(e, 1).collect()}
    assert set(r1) == {2, 3}
    assert math.isclose(r1[2], 1.85) and math.isclose(r1[3], 1.0)
    r2 = {r["node"]: r["rank"] for r in G.pagerank(e, 2).collect()}
    assert math.isclose(r2[2], 1.0) and math.isclose(r2[3], 1.7225)
    r0 = {r["node"]: r["rank"] for r in G.pagerank(e, 0).collect()}
    assert r0 == {1: 1.0, 2: 1.0, 3: 1.0}


def test_pagerank_cut_every_round_same_result(spark):
    e = _edges(spark, [(1, 2), (2, 3), (3, 1), (3, 2), (4, 1)])
    a = {r["node"]: r["rank"] for r in G.pagerank(e, 7, cut_every=1).collect()}
    b = {r["node"]: r["rank"] for r in G.pagerank(e, 7, cut_every=100).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k]) for k in a)


def test_edge_union_distinct(spark):
    u = G.edge_union(_edges(spark, [(1, 2), (1, 2)]), _edges(spark, [(1, 2), (2, 1)]))
    assert sorted(tuple(r) for r in u.collect()) == [(1, 2), (2, 1)]


def test_sgd_two_points(spark):
    pts = spark.createDataFrame([(1.0, 1.0, 0.0), (0.0, 0.0, 1.0)], "y double, a double, b double")
    w = D.logistic_sgd(pts, ["a", "b"], "y", iterations=3, step=1.0)
    assert round(w[0], 4) == 0.5203 and round(w[1], 4) == -0.5203
    w_l2 = D.logistic_sgd(pts, ["a", "b"], "y", iterations=3, step=1.0, reg=0.01)
    assert round(w_l2[0], 5) == 0.51634 and round(w_l2[1], 5) == -0.51634


def test_gradient_descent_matches_local_formula(spark):
    rows = [(1.0, 0.5, -1.0), (-1.0, 0.2, 0.3), (1.0, -0.4, 0.9)]
    pts = spark.createDataFrame(rows, "y double, a double, b double")
    w = [0.1, -0.2]
    for _ in range(2):
        g = [0.0, 0.0]
        for y, a, b in rows:
            d = a * w[0] + b * w[1]
            m = (1 / (1 + math.exp(-y * d)) - 1) * y
            g[0] += m * a
            g[1] += m * b
        w = [w[0] - g[0], w[1] - g[1]]
    got = D.logistic_gd(pts, ["a", "b"], "y", [0.1, -0.2], 2)
    assert all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(got, w))


def test_pagerank_hot_sources_same_result(spark):
    rows = [(1, d) for d in range(2, 40)] + [(d, 1) for d in range(2, 40, 3)] + [(2, 3), (3, 2)]
    e = _edges(spark, rows)
    a = {r["node"]: r["rank"] for r in G.pagerank(e, 4).collect()}
    b = {r["node"]: r["rank"] for r in G.pagerank(e, 4, links_per_salt=5).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k]) for k in a)
