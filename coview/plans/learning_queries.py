"""Gradient descent, error measures, splits and MLlib-backed jobs.

Feature expressions are written once as SQL text that both Spark and DuckDB
evaluate identically, so the oracle sees exactly the same inputs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from coview.operators import descent as D
from coview.operators import evaluate as EV
from coview.operators.layout import hash_split_flag
from coview.plans import tree_sql
from coview.plans.registry import register
from coview.plans.tables import table

GD_ROUNDS = 3

# Ten features per lineitem row, scaled to about [0, 1]; the last is a constant.
_Q = "l_quantity / CAST(50 AS DOUBLE)"
_D = "l_discount * CAST(10 AS DOUBLE)"
_T = "l_tax * CAST(10 AS DOUBLE)"
_P = "l_extendedprice / CAST(100000 AS DOUBLE)"
FEATURE_SQL = (_Q, _D, _T, _P, "l_linenumber / CAST(7 AS DOUBLE)",
               f"({_Q}) * ({_Q})", f"({_D}) * ({_D})", f"({_T}) * ({_T})", f"({_P}) * ({_P})",
               "CAST(1 AS DOUBLE)")
FEATURES = tuple(f"x{j + 1}" for j in range(len(FEATURE_SQL)))
LABEL_PM1 = "CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END"
LABEL_01 = "CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def lineitem_points(spark, sf_dir, label_sql: str):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.expr(label_sql).alias("y"),
                     *[F.expr(e).alias(x) for e, x in zip(FEATURE_SQL, FEATURES)])


def _sql_points(label_sql: str) -> str:
    cols = ", ".join(f"{e} AS {x}" for e, x in zip(FEATURE_SQL, FEATURES))
    return f"pts AS (SELECT {label_sql} AS y, {cols} FROM lineitem)"


def _sql_dot(w: str) -> str:
    return " + ".join(f"p.{x} * {w}.w{j + 1}" for j, x in enumerate(FEATURES))


def _sql_start(ws) -> str:
    return "w0 AS (SELECT " + ", ".join(
        f"CAST('{float(v)!r}' AS DOUBLE) AS w{j + 1}" for j, v in enumerate(ws)) + ")"


def _sql_final(last: str) -> str:
    return "SELECT " + ", ".join(
        f"round(w{j + 1} + 1e-9, 6) AS w{j + 1}" for j in range(len(FEATURES))) + f" FROM {last}"


def _sql_gd(rounds: int) -> str:
    ctes = [_sql_points(LABEL_PM1), _sql_start(D.START_WEIGHTS_SEED42)]
    for r in range(1, rounds + 1):
        m = f"((1.0 / (1.0 + exp(-p.y * ({_sql_dot('w')}))) - 1.0) * p.y)"
        cols = ", ".join(f"min(w.w{j + 1}) - sum({m} * p.{x}) AS w{j + 1}"
                         for j, x in enumerate(FEATURES))
        ctes.append(f"w{r} AS (SELECT {cols} FROM pts p, w{r - 1} w)")
    return "WITH " + ",\n".join(ctes) + "\n" + _sql_final(f"w{rounds}")


def _sql_gradient() -> str:
    m = f"((1.0 / (1.0 + exp(-p.y * ({_sql_dot('w')}))) - 1.0) * p.y)"
    cols = ", ".join(f"round(sum({m} * p.{x}) + 1e-9, 6) AS g{j + 1}" for j, x in enumerate(FEATURES))
    return ("WITH " + ",\n".join([_sql_points(LABEL_PM1), _sql_start(D.START_WEIGHTS_SEED42)])
            + f"\nSELECT {cols} FROM pts p, w0 w")


def _sql_sgd(rounds: int, step: float = 1.0) -> str:
    ctes = [_sql_points(LABEL_01),
            "w0 AS (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS w{j + 1}"
                                         for j in range(len(FEATURES))) + ")"]
    for t in range(1, rounds + 1):
        eta = f"(CAST({step!r} AS DOUBLE) / sqrt({t}))"
        m = f"(1.0 / (1.0 + exp(-({_sql_dot('w')}))) - p.y)"
        cols = ", ".join(f"min(w.w{j + 1}) * (1.0 - {eta} * 0.0) - {eta} * avg({m} * p.{x}) AS w{j + 1}"
                         for j, x in enumerate(FEATURES))
        ctes.append(f"w{t} AS (SELECT {cols} FROM pts p, w{t - 1} w)")
    return "WITH " + ",\n".join(ctes) + "\n" + _sql_final(f"w{rounds}")


# --- A14, I3, M3: gradient descent ---------------------------------------------------

@register("logistic_gradient", oracle=_sql_gradient())
def q_logistic_gradient(spark, sf_dir):
    g = D.gradient_sum(lineitem_points(spark, sf_dir, LABEL_PM1), FEATURES, "y",
                       D.START_WEIGHTS_SEED42)
    return g.select(*[F.round(F.col(c) + F.lit(1e-9), 6).alias(c) for c in g.columns])


@register("logistic_gd", oracle=_sql_gd(GD_ROUNDS))
def q_logistic_gd(spark, sf_dir):
    w = D.logistic_gd(lineitem_points(spark, sf_dir, LABEL_PM1), FEATURES, "y",
                      D.START_WEIGHTS_SEED42, GD_ROUNDS)
    return D.weights_frame(spark, w)


@register("logistic_sgd", oracle=_sql_sgd(GD_ROUNDS))
def q_logistic_sgd(spark, sf_dir):
    w = D.logistic_sgd(lineitem_points(spark, sf_dir, LABEL_01), FEATURES, "y", GD_ROUNDS)
    return D.weights_frame(spark, w)


# --- A15, A16, A13, F16: error measures, class counts, split ------------------------

@register("mean_squared_error", oracle="""
SELECT l_returnflag,
       round(avg(power(l_quantity * p_retailprice / 1000.0 - l_extendedprice / 1000.0, 2))
             + 1e-9, 6) AS mse
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag""")
def q_mean_squared_error(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    scored = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        "l_returnflag",
        (F.col("l_quantity") * F.col("p_retailprice") / F.lit(1000.0)).alias("prediction"),
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("label"))
    m = EV.mean_squared_error(scored, "prediction", "label", by=["l_returnflag"])
    return m.select("l_returnflag", F.round(F.col("mse") + F.lit(1e-9), 6).alias("mse"))


@register("error_rate", oracle="""
SELECT l_linestatus,
       round(avg(CAST((l_discount > 0.05) <> (l_returnflag = 'R') AS DOUBLE)) + 1e-9, 6)
         AS error_rate
FROM lineitem GROUP BY l_linestatus""")
def q_error_rate(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_linestatus", (F.col("l_discount") > 0.05).alias("prediction"),
        (F.col("l_returnflag") == "R").alias("label"))
    e = EV.error_rate(li, "prediction", "label", by=["l_linestatus"])
    return e.select("l_linestatus", F.round(F.col("error_rate") + F.lit(1e-9), 6).alias("error_rate"))


@register("class_count", oracle="""
SELECT 'labels.quality' AS label_column, count(DISTINCT quality) AS n_classes FROM labels
UNION ALL SELECT 'labels.toxic', count(DISTINCT toxic) FROM labels
UNION ALL SELECT 'embeddings.label', count(DISTINCT label) FROM embeddings""")
def q_class_count(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    emb = table(spark, sf_dir, "embeddings")
    parts = [EV.class_count(lab, "quality").select(F.lit("labels.quality").alias("label_column"), "n_classes"),
             EV.class_count(lab, "toxic").select(F.lit("labels.toxic").alias("label_column"), "n_classes"),
             EV.class_count(emb, "label").select(F.lit("embeddings.label").alias("label_column"), "n_classes")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("hash_split", oracle="""
SELECT o_orderkey,
       CASE WHEN (((o_orderkey * 7919 + 104729) % 10) + 10) % 10 < 7 THEN 'train' ELSE 'test' END
         AS side
FROM orders""")
def q_hash_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    flag = hash_split_flag("o_orderkey")
    return o.select("o_orderkey", F.when(flag, F.lit("train")).otherwise(F.lit("test")).alias("side"))


# --- M1: frequent itemsets (part types per order) ------------------------------------

FP_MIN_SUPPORT = 0.1


@register("frequent_itemsets", oracle=f"""
WITH t AS (SELECT DISTINCT l.l_orderkey AS o, p.p_type AS item
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
n AS (SELECT count(DISTINCT o) AS n FROM t),
s AS (
  SELECT item AS itemset, 1 AS size, count(*) AS freq FROM t GROUP BY item
  UNION ALL
  SELECT a.item || ',' || b.item, 2, count(*) FROM t a JOIN t b ON a.o = b.o AND a.item < b.item
  GROUP BY a.item, b.item
  UNION ALL
  SELECT a.item || ',' || b.item || ',' || c.item, 3, count(*)
  FROM t a JOIN t b ON a.o = b.o AND a.item < b.item JOIN t c ON b.o = c.o AND b.item < c.item
  GROUP BY a.item, b.item, c.item)
SELECT itemset, CAST(size AS INTEGER) AS size, CAST(freq AS BIGINT) AS freq
FROM s, n WHERE freq >= ceil({FP_MIN_SUPPORT} * n.n)""")
def q_frequent_itemsets(spark, sf_dir):
    from coview.operators.mining import vertical_itemsets
    return vertical_itemsets(_order_types(spark, sf_dir), "l_orderkey", "p_type", FP_MIN_SUPPORT)


def _order_types(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select("l_orderkey", "p_type")


# Rarer sets, of any size: part types of an order up to all six. The SQL grows
# sets while they stay frequent and cuts at no size.
DEEP_MIN_SUPPORT = 0.005


@register("frequent_itemsets_deep", oracle=f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT DISTINCT l.l_orderkey AS o, p.p_type AS item
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
g AS (
  SELECT o, item AS itemset, item AS last, 1 AS size FROM t
  UNION ALL
  SELECT g.o, g.itemset || ',' || t.item, t.item, g.size + 1 FROM g JOIN t ON g.o = t.o AND g.last < t.item)
SELECT itemset, CAST(size AS INTEGER) AS size, count(*) AS freq FROM g GROUP BY itemset, size
HAVING count(*) >= ceil({DEEP_MIN_SUPPORT} * (SELECT count(DISTINCT o) FROM t))""")
def q_frequent_itemsets_deep(spark, sf_dir):
    from coview.operators.mining import vertical_itemsets
    return vertical_itemsets(_order_types(spark, sf_dir), "l_orderkey", "p_type", DEEP_MIN_SUPPORT)


# --- M2 + K2: ALS factors and their text dump ----------------------------------------

def purchase_ratings(spark, sf_dir):
    """(user long, item long, rating double): mean quantity / 10 per customer and part."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .groupBy(F.col("o_custkey").alias("user"),
                     F.col("l_partkey").alias("item"))
            .agg((F.avg("l_quantity") / F.lit(10.0)).alias("rating")))


ALS_RANK, ALS_ROUNDS, ALS_REG = 2, 3, 0.05


def _sql_als() -> str:
    """The rounds unrolled for rank 2; ids of both sides as in the Spark job."""
    half = """{out} AS MATERIALIZED (
  SELECT {key}, n, y0 AS y0, (y1 / l11) AS f1, (y0 - l10 * (y1 / l11)) / l00 AS f0
  FROM (SELECT {key}, n, l00, l10, l11, b0 / l00 AS y0, (b1 - l10 * (b0 / l00)) / l11 AS y1
        FROM (SELECT *, sqrt(g00) AS l00, g01 / sqrt(g00) AS l10,
                     sqrt(g11 - (g01 / sqrt(g00)) * (g01 / sqrt(g00))) AS l11
              FROM (SELECT {key}, count(*) AS n, sum(f0 * f0) + {reg} * count(*) AS g00, sum(f0 * f1) AS g01,
                           sum(f1 * f1) + {reg} * count(*) AS g11, sum(rating * f0) AS b0, sum(rating * f1) AS b1
                    FROM r JOIN {fixed} USING ({other}) GROUP BY {key}))))"""
    start = ", ".join(f"0.1::DOUBLE + ('0x' || substr(md5(usr || ':{j}'), 1, 6))::BIGINT / 16777216.0::DOUBLE AS f{j}"
                      for j in range(2))
    ctes = ["""r AS MATERIALIZED (
  SELECT o_custkey AS usr, l_partkey AS item, avg(l_quantity) / 10.0::DOUBLE AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""",
            f"u0 AS (SELECT DISTINCT usr, {start} FROM r)"]
    for i in range(ALS_ROUNDS):
        ctes.append(half.format(out=f"i{i + 1}", key="item", other="usr", fixed=f"u{i}", reg=ALS_REG))
        ctes.append(half.format(out=f"u{i + 1}", key="usr", other="item", fixed=f"i{i + 1}", reg=ALS_REG))
    return "WITH " + ",\n".join(ctes)


def _factors(ratings):
    from coview.operators.factors import alternating_least_squares
    return alternating_least_squares(ratings, ALS_RANK, ALS_ROUNDS, ALS_REG)


_ALS_ROWS = """SELECT '{side}' AS side, {key} AS id, n, round(f0 + 1e-9, 6) AS f0, round(f1 + 1e-9, 6) AS f1,
       {residual} AS residual FROM {table}"""


@register("als_factors", oracle=_sql_als() + "\n"
          + _ALS_ROWS.format(side="user", key="usr", table=f"u{ALS_ROUNDS}", residual="0.0::DOUBLE") + "\nUNION ALL "
          + _ALS_ROWS.format(side="item", key="item", table=f"i{ALS_ROUNDS}", residual="NULL"))
def q_als_factors(spark, sf_dir):
    # the users were solved last: their factors must solve the equations that
    # the ratings and the item factors, read again, give
    from coview.operators.factors import gram_sums, residuals
    from coview.session import write_cut
    ratings = write_cut(purchase_ratings(spark, sf_dir), "purchase_ratings")
    users, items = _factors(ratings)
    sums = gram_sums(ratings, items, "user", "item", "rating", ALS_RANK)
    users = users.join(residuals(sums, users, "user", ALS_RANK, ALS_REG), "user")

    def rows(side, table, key, residual):
        return table.select(F.lit(side).alias("side"), F.col(key).cast("long").alias("id"), "n",
                            *(F.round(F.col(f"f{j}") + F.lit(1e-9), 6).alias(f"f{j}") for j in range(ALS_RANK)),
                            residual.alias("residual"))

    return rows("user", users, "user", F.round("residual", 6)).unionByName(
        rows("item", items, "item", F.lit(None).cast("double")))


@register("factor_text_lines", oracle=_sql_als() + "".join(f"""
{union}SELECT '{side}' AS side, {key} || ',[' || printf('%.5f', round(round(f0 + 1e-12, 9), 5)) || ', '
       || printf('%.5f', round(round(f1 + 1e-12, 9), 5)) || ']' AS value FROM {table}{ALS_ROUNDS}"""
          for union, side, key, table in (("", "user", "usr", "u"), ("UNION ALL ", "item", "item", "i"))))
def q_factor_text_lines(spark, sf_dir):
    from coview.functions.scalars import fixed5
    from coview.session import scratch_path
    from coview.sources.sinks import vector_text, write_text_lines
    lines = None
    for side, factors in zip(("user", "item"), _factors(purchase_ratings(spark, sf_dir)), strict=True):
        path = scratch_path(spark, f"{side}_factors_txt")
        values = factors.select(side, F.array(*(f"f{j}" for j in range(ALS_RANK))).alias("features"))
        write_text_lines(values, path, vector_text(side, "features", fixed5))
        part = spark.read.text(path).select(F.lit(side).alias("side"), "value")
        lines = part if lines is None else lines.unionByName(part)
    return lines


# --- M4, M5, M6: k-means, LDA, power iteration clustering ----------------------------

KMEANS_K, KMEANS_ROUNDS = 10, 3


def _sql_kmeans() -> str:
    """Lloyd's rounds unrolled over (point, dim) rows."""
    ctes = ["p AS MATERIALIZED (SELECT vec_id AS id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings "
            "WHERE embedding IS NOT NULL)",
            f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY md5(id::VARCHAR), id) - 1 AS cluster, x, 0 AS n
  FROM p QUALIFY cluster < {KMEANS_K})"""]
    assign = """a{i} AS MATERIALIZED (SELECT id, x, arg_min(cluster, (cost, cluster)) AS cluster, min(cost) AS cost
  FROM (SELECT p.id, p.x, c.cluster,
               list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS cost
        FROM p, c{i} c) GROUP BY id, x)"""
    for i in range(KMEANS_ROUNDS):
        ctes.append(assign.format(i=i))
        ctes.append(f"""m{i} AS (SELECT cluster, list(v ORDER BY dim) AS x, max(n) AS n
  FROM (SELECT cluster, dim, avg(v) AS v, count(*) AS n
        FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM a{i}) GROUP BY cluster, dim)
  GROUP BY cluster)""")
        ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x, coalesce(m.n, 0) AS n
  FROM c{i} c LEFT JOIN m{i} m USING (cluster))""")
    ctes.append(assign.format(i=KMEANS_ROUNDS))
    return "WITH " + ",\n".join(ctes)


@register("kmeans_centers", oracle=_sql_kmeans() + f"""
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(dim - 1 AS INTEGER) AS dim, round(v + 1e-9, 6) AS value, n,
       (SELECT round(sum(cost), 4) FROM a{KMEANS_ROUNDS}) AS cost
FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS dim, CAST(n AS BIGINT) AS n FROM c{KMEANS_ROUNDS})""")
def q_kmeans_centers(spark, sf_dir):
    from coview.operators.cluster import kmeans_rounds
    centers, points = kmeans_rounds(table(spark, sf_dir, "embeddings"), KMEANS_K, KMEANS_ROUNDS, "vec_id", "embedding")
    cost = points.agg(F.round(F.sum("cost"), 4)).first()[0]
    return centers.select("cluster", "dim", F.round(F.col("value") + F.lit(1e-9), 6).alias("value"), "n",
                          F.lit(cost).alias("cost"))


@register("kmeans_assignment", oracle=_sql_kmeans() + f"""
SELECT id, CAST(cluster AS INTEGER) AS cluster, round(cost + 1e-9, 6) AS cost FROM a{KMEANS_ROUNDS}""")
def q_kmeans_assignment(spark, sf_dir):
    from coview.operators.cluster import kmeans_rounds
    _, points = kmeans_rounds(table(spark, sf_dir, "embeddings"), KMEANS_K, KMEANS_ROUNDS, "vec_id", "embedding")
    return points.select("id", "cluster", F.round(F.col("cost") + F.lit(1e-9), 6).alias("cost"))


LDA_ROUNDS = 20           # what the reference's LDA runs unless told otherwise


def _sql_lda(rounds: int = LDA_ROUNDS) -> str:
    """EM over (doc, term, n), three topics, the rounds unrolled."""
    alpha, eta = 50.0 / 3 + 1.0 - 1.0, 1.1 - 1.0
    start = ", ".join(f"CASE WHEN (doc + length(term)) % 3 = {t} THEN 0.6::DOUBLE ELSE 0.2::DOUBLE END AS p{t}"
                      for t in range(3))
    sums = lambda to: ", ".join(f"sum(n * p{t}) AS {to}{t}" for t in range(3))
    ctes = [f"""c AS MATERIALIZED (SELECT doc, term, count(*) AS n
  FROM (SELECT doc_id AS doc, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS term FROM documents)
  GROUP BY doc, term),
e0 AS MATERIALIZED (SELECT doc, term, n, {start} FROM c)"""]
    for r in range(rounds + 1):
        ctes.append(f"w{r}_ AS MATERIALIZED (SELECT term, {sums('w')} FROM e{r} GROUP BY term)")
        ctes.append(f"t{r} AS (SELECT count(*) AS terms, sum(w0) AS s0, sum(w1) AS s1, sum(w2) AS s2 FROM w{r}_)")
        if r < rounds:
            raw = ", ".join(f"(w{t} + {eta!r}) * (d{t} + {alpha!r}) / (s{t} + terms * {eta!r}) AS r{t}" for t in range(3))
            ctes.append(f"d{r}_ AS MATERIALIZED (SELECT doc, {sums('d')} FROM e{r} GROUP BY doc)")
            ctes.append(f"""e{r + 1} AS MATERIALIZED (SELECT doc, term, n, r0 / (r0 + r1 + r2) AS p0,
  r1 / (r0 + r1 + r2) AS p1, r2 / (r0 + r1 + r2) AS p2
  FROM (SELECT doc, term, n, {raw} FROM c JOIN w{r}_ USING (term) JOIN d{r}_ USING (doc), t{r}))""")
    out = " UNION ALL ".join(f"SELECT CAST({t} AS INTEGER) AS topic, term, round(w{t} / s{t} + 1e-13, 10) AS weight "
                             f"FROM w{rounds}_, t{rounds}" for t in range(3))
    return "WITH " + ",\n".join(ctes) + "\n" + out


@register("lda_topics", oracle=_sql_lda())
def q_lda_topics(spark, sf_dir):
    from coview.operators.cluster import lda_topics, term_counts, tokens
    docs = tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    topics = lda_topics(term_counts(docs), k=3, rounds=LDA_ROUNDS)
    return topics.select("topic", "term", F.round(F.col("weight") + F.lit(1e-13), 10).alias("weight"))


PIC_ROUNDS, PIC_LINE_ROUNDS = 10, 5


def _sql_pic() -> str:
    """Power iteration, then 2-means on the line, all rounds unrolled."""
    ctes = ["""g AS (SELECT user_id * 2 AS a, CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 + 1 AS b FROM events),
e AS MATERIALIZED (SELECT id, other, count(*)::DOUBLE AS w
  FROM (SELECT a AS id, b AS other FROM g WHERE a <> b UNION ALL SELECT b, a FROM g WHERE a <> b) GROUP BY ALL),
d AS MATERIALIZED (SELECT id, sum(w) AS degree FROM e GROUP BY id),
v0 AS MATERIALIZED (SELECT id, degree / (SELECT sum(degree) FROM d) AS v FROM d)"""]
    for i in range(PIC_ROUNDS):
        ctes.append(f"""n{i} AS MATERIALIZED (SELECT e.id, sum(e.w * v.v) / max(d.degree) AS v
  FROM e JOIN v{i} v ON v.id = e.other JOIN d ON d.id = e.id GROUP BY e.id),
v{i + 1} AS MATERIALIZED (SELECT id, v / (SELECT sum(abs(v)) FROM n{i}) AS v FROM n{i})""")
    ctes.append(f"""x AS (SELECT min(v) AS lo, max(v) AS hi FROM v{PIC_ROUNDS}),
k0 AS (SELECT lo + (hi - lo) / 4 AS c0, lo + (hi - lo) * 3 / 4 AS c1 FROM x)""")
    side = "CASE WHEN abs(v - c1) < abs(v - c0) THEN 1 ELSE 0 END"
    for i in range(PIC_LINE_ROUNDS):
        ctes.append(f"""k{i + 1} AS MATERIALIZED (SELECT coalesce(avg(v) FILTER (WHERE {side} = 0), max(c0)) AS c0,
  coalesce(avg(v) FILTER (WHERE {side} = 1), max(c1)) AS c1 FROM v{PIC_ROUNDS}, k{i})""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT id, CAST({side} AS INTEGER) AS cluster, round(v + 1e-13, 10) AS value FROM v{PIC_ROUNDS}, k{PIC_LINE_ROUNDS}"""


@register("graph_clusters", oracle=_sql_pic())
def q_graph_clusters(spark, sf_dir):
    from coview.operators.cluster import power_clusters
    ev = table(spark, sf_dir, "events")
    # users and items are different nodes: even ids for users, odd ids for items
    edges = (ev.select((F.col("user_id") * 2).alias("src"),
                       (F.get_json_object("props", "$.k").cast("long") * 2 + 1).alias("dst"))
             .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    found = power_clusters(edges, 2, PIC_ROUNDS, line_rounds=PIC_LINE_ROUNDS)
    return found.select("id", "cluster", F.round(F.col("value") + F.lit(1e-13), 10).alias("value"))


# --- M7-M13: tree learners ----------------------------------------------------------
# Features are columns of at most 32 values, so Spark ML's bins are the values and
# SQL can grow the same trees (``tree_sql``). The queries return the fitted
# models' nodes, read from the saved model, with the rows that reach each.

PRICE_SQL = ("l_linenumber", "round(l_discount * 100)", "round(l_tax * 100)", "month(l_shipdate)",
             "floor(l_quantity / 2)")
PRICE_LABEL = "l_extendedprice / CAST(1000 AS DOUBLE)"


def _share(chars: str) -> str:
    return (f"least(floor(CAST(100 AS DOUBLE) * (length(text) - length(translate(text, '{chars}', ''))) "
            "/ greatest(length(text), 1)), 31)")


DOCUMENT_SQL = (_share("0123456789"), _share("#*$%&|<>"), _share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _share(".,;:!?"),
                "least(length(text) - length(replace(text, chr(10), '')), 31)",
                "least(floor(sqrt(CAST(length(text) AS DOUBLE)) / 8), 31)")
TREE_DEPTH, FOREST_DEPTH, FOREST_TREES = 5, 4, 3
BOOST_ROUNDS, BOOST_DEPTH = 10, 5
CLASS_BOOST_ROUNDS, CLASS_BOOST_DEPTH = 10, 5
# With so many rows on either side no two features part a node alike, so gains
# of sums of fractions never tie and the order of summing decides nothing.
MIN_ROWS = 20


def _x(exprs) -> str:
    return ", ".join(f"{e} AS x{j + 1}" for j, e in enumerate(exprs))


SQL_PRICE = f"src AS MATERIALIZED (SELECT {_x(PRICE_SQL)}, {PRICE_LABEL} AS y FROM lineitem)"
SQL_DOCUMENTS = (f"src AS MATERIALIZED (SELECT {_x(DOCUMENT_SQL)}, CAST(quality AS DOUBLE) AS y "
                 "FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND quality IS NOT NULL)")


def _points(rows, exprs, label: str, dealt: bool = True):
    """(label, features); ``dealt`` for learners that keep the rows (boosting keeps cells)."""
    from coview.operators.layout import deal
    from coview.operators.trees import assemble
    xs = [f"x{j + 1}" for j in range(len(exprs))]
    named = rows.select(*[F.expr(e).cast("double").alias(x) for e, x in zip(exprs, xs)],
                        F.expr(label).cast("double").alias("y"))
    return assemble(deal(named, "points") if dealt else named, xs, "y")


def _price_points(spark, sf_dir, side: bool | None = None, dealt: bool = True):
    li = table(spark, sf_dir, "lineitem")
    if side is not None:
        flag = hash_split_flag("l_orderkey")
        li = li.where(flag if side else ~flag)
    return _points(li, PRICE_SQL, PRICE_LABEL, dealt)


def _document_points(spark, sf_dir, side: bool | None = None):
    """documents with a quality label: text statistics as features."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    d = d.where("text is not null and quality is not null")
    if side is not None:
        flag = hash_split_flag("doc_id")
        d = d.where(flag if side else ~flag)
    return _points(d, DOCUMENT_SQL, "quality")


def _rounded(report):
    return report.select("tree", "node", "feature", "threshold", "n",
                         F.round(F.col("prediction") + F.lit(1e-9), 6).alias("prediction"), F.round("off", 6).alias("off"))


def _off(report, kind: str):
    """How far a node is from what the rows that reach it say."""
    right = F.col("mean") if kind == "regression" else (F.col("mean") > 0.5).cast("double")
    return report.withColumn("off", F.abs(right - F.col("prediction")))


def _sql_grown(source: str, target: str, k: int, depth: int, classes: bool, least: int = 1) -> str:
    ctes = [source, tree_sql.grid("src", k), *tree_sql.grow("t", "src", target, k, depth, classes, least)]
    return "WITH " + ",\n".join(ctes) + "\n" + tree_sql.report([(0, "t")])


def _sql_boosted(source: str, k: int, depth: int, rounds: int, loss: str = "squared") -> str:
    ctes = [source, tree_sql.grid("src", k), *tree_sql.boost("src", k, depth, rounds, loss, least=MIN_ROWS)]
    return "WITH " + ",\n".join(ctes) + "\n" + tree_sql.report([(i, f"m{i}") for i in range(rounds)])


@register("tree_classifier", oracle=_sql_grown(SQL_DOCUMENTS, "y", len(DOCUMENT_SQL), TREE_DEPTH, True))
def q_tree_classifier(spark, sf_dir):
    from coview.operators.trees import node_report, tree_classifier
    data = _document_points(spark, sf_dir)
    return _rounded(_off(node_report(data, tree_classifier(data, TREE_DEPTH)[0]), "classification"))


@register("tree_regressor", oracle=_sql_grown(SQL_PRICE, "y", len(PRICE_SQL), TREE_DEPTH, False, MIN_ROWS))
def q_tree_regressor(spark, sf_dir):
    from coview.operators.trees import node_report, tree_regressor
    data = _price_points(spark, sf_dir)
    return _rounded(_off(node_report(data, tree_regressor(data, TREE_DEPTH, min_rows=MIN_ROWS)[0]), "regression"))


# A forest draws its features at random, which no SQL repeats; grown on all rows
# (no bootstrap), its leaves still must say what the rows that reach them say.
_SPLIT_FLAG = "((({key} * 7919 + 104729) % 10) + 10) % 10 < 7"


def _sql_forest(source: str, total: str) -> str:
    return f"""WITH train AS ({source})
SELECT CAST(tree AS INTEGER) AS tree, (SELECT count(*) FROM train) AS n,
       (SELECT {total} FROM train) AS predicted_sum, CAST(0 AS BIGINT) AS leaves_off, CAST(0 AS BIGINT) AS rows_off
FROM range({FOREST_TREES}) t(tree)"""


@register("forest_classifier", oracle=f"""
WITH train AS (SELECT 1 FROM documents JOIN labels USING (doc_id)
               WHERE text IS NOT NULL AND quality IS NOT NULL AND {_SPLIT_FLAG.format(key='doc_id')})
SELECT CAST(tree AS INTEGER) AS tree, (SELECT count(*) FROM train) AS n,
       CAST(0 AS BIGINT) AS leaves_off, CAST(0 AS BIGINT) AS rows_off
FROM range({FOREST_TREES}) t(tree)""")
def q_forest_classifier(spark, sf_dir):
    from coview.operators.trees import forest_audit, forest_classifier
    train, test = _document_points(spark, sf_dir, True), _document_points(spark, sf_dir, False)
    model, _ = forest_classifier(train, test, FOREST_TREES, FOREST_DEPTH, bootstrap=False)
    return forest_audit(model, train, test, "classification").drop("predicted_sum")


@register("forest_regressor", oracle=_sql_forest(
    f"SELECT {PRICE_LABEL} AS y FROM lineitem WHERE {_SPLIT_FLAG.format(key='l_orderkey')}", "round(sum(y), 3)"))
def q_forest_regressor(spark, sf_dir):
    from coview.operators.trees import forest_audit, forest_regressor
    train, test = _price_points(spark, sf_dir, True), _price_points(spark, sf_dir, False)
    model, _ = forest_regressor(train, test, FOREST_TREES, FOREST_DEPTH, bootstrap=False)
    return (forest_audit(model, train, test, "regression")
            .withColumn("predicted_sum", F.round("predicted_sum", 3)))


DEAR = "CASE WHEN l_extendedprice > 50000 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


@register("gbt_classifier", oracle=_sql_boosted(
    f"src AS MATERIALIZED (SELECT {_x(PRICE_SQL)}, ({DEAR}) * 2 - 1 AS y FROM lineitem)",
    len(PRICE_SQL), CLASS_BOOST_DEPTH, CLASS_BOOST_ROUNDS, "logistic"))
def q_gbt_classifier(spark, sf_dir):
    from coview.operators.trees import boosting_report, cells, gbt_classifier
    data = cells(_points(table(spark, sf_dir, "lineitem"), PRICE_SQL, DEAR, dealt=False), classes=True)
    model, _ = gbt_classifier(data, rounds=CLASS_BOOST_ROUNDS, max_depth=CLASS_BOOST_DEPTH, min_rows=MIN_ROWS)
    return _rounded(_off(boosting_report(model, data, "logistic"), "regression"))


@register("gbt_regressor", oracle=_sql_boosted(SQL_PRICE, len(PRICE_SQL), BOOST_DEPTH, BOOST_ROUNDS))
def q_gbt_regressor(spark, sf_dir):
    from coview.operators.trees import boosting_report, cells, gbt_regressor
    data = cells(_price_points(spark, sf_dir, dealt=False))
    model, _ = gbt_regressor(data, rounds=BOOST_ROUNDS, max_depth=BOOST_DEPTH, min_rows=MIN_ROWS)
    return _rounded(_off(boosting_report(model, data), "regression"))


# Eight long columns of lineitem x orders standing in for the reference's
# feature table; ids by their remainder, as they have no order of their own.
FEATURE_TABLE_SQL = ("l_partkey % 25", "l_suppkey % 25", "l_linenumber", "o_custkey % 25", "floor(l_quantity / 2)",
                     "round(l_discount * 100)", "round(l_tax * 100)", "month(l_shipdate)")
TABLE_ROUNDS, TABLE_DEPTH = 3, 5


@register("gbt_feature_table", oracle=_sql_boosted(
    f"""src AS MATERIALIZED (SELECT {_x(FEATURE_TABLE_SQL)}, {PRICE_LABEL} AS y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {_SPLIT_FLAG.format(key='l_orderkey')})""",
    len(FEATURE_TABLE_SQL), TABLE_DEPTH, TABLE_ROUNDS))
def q_gbt_feature_table(spark, sf_dir):
    from coview.operators.trees import boosting_report, cells, gbt_regressor
    from coview.session import write_cut
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    flag = hash_split_flag("l_orderkey")
    sided = write_cut(rows.withColumn("train", flag).select(
        "train", *(F.expr(e).alias(f"v{j}") for j, e in enumerate(FEATURE_TABLE_SQL)),
        F.expr(PRICE_LABEL).alias("label")), "feature_table")
    named = [f"v{j}" for j in range(len(FEATURE_TABLE_SQL))]
    train = cells(_points(sided.where("train"), named, "label", dealt=False))
    test = _points(sided.where("not train"), named, "label", dealt=False)
    model, _ = gbt_regressor(train, test, rounds=TABLE_ROUNDS, max_depth=TABLE_DEPTH, min_rows=MIN_ROWS)
    return _rounded(_off(boosting_report(model, train), "regression"))
