"""Clustering and topic jobs: k-means and power iteration clustering, by Spark ML
and as keyed rounds, and the terms for LDA."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, PowerIterationClustering
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coview.operators.layout import salted_join, widen
from coview.operators.topics import lda_topics  # noqa: F401
from coview.session import write_cut


def as_vectors(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """``array<float|double>`` to an ML dense vector column."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def kmeans(points: DataFrame, k: int, max_iter: int = 20, runs: int = 1, seed: int = 1,
           features: str = "features") -> tuple[DataFrame, float]:
    """k-means with the k-means|| start; ``runs`` fits with seeds seed..seed+runs-1 and
    keeps the lowest cost. Returns (centers as (cluster, center array<double>), cost)."""
    best = None
    for r in range(max(1, runs)):
        model = KMeans(k=k, maxIter=max_iter, initMode="k-means||", seed=seed + r,
                       featuresCol=features).fit(points)
        cost = model.summary.trainingCost
        if best is None or cost < best[1]:
            best = (model, cost)
    model, cost = best
    spark = points.sparkSession
    # k centers of fixed dimension: bounded by the k the caller chose.
    centers = spark.createDataFrame(
        [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())],
        "cluster int, center array<double>")
    return centers, float(cost)


def _squared_distance(point: str, center: list[float]) -> Column:
    there = F.array(*(F.lit(float(v)) for v in center))
    return F.aggregate(F.zip_with(point, there, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)


def nearest(points: DataFrame, centers: list[list[float]], point: str = "point") -> DataFrame:
    """``points`` with ``cluster`` and ``cost``: the nearest center (the first of
    several) and its squared distance."""
    options = F.array(*(F.struct(_squared_distance(point, c).alias("cost"), F.lit(i).alias("cluster"))
                        for i, c in enumerate(centers)))
    best = F.array_min(options)
    return points.withColumn("best", best).select("*", "best.cluster", "best.cost").drop("best")


def kmeans_rounds(points: DataFrame, k: int, rounds: int, id_col: str = "id",
                  array_col: str = "point") -> tuple[DataFrame, DataFrame]:
    """Lloyd's rounds as keyed means: (centers, assignment).

    ``centers`` is (cluster, dim, value, n), ``assignment`` (id, cluster, cost) by
    these centers. The start is the ``k`` points with the least ``md5(id)``. A
    round assigns every point against the ``k`` centers, which are literals of
    the plan, and averages the exploded coordinates per (cluster, dim): partial
    sums of k x dimensions rows leave a task, whatever the size of a cluster. The
    driver holds k centers; a center without points stays where it was. Points
    without a vector are left out.
    """
    pts = points.select(F.col(id_col).alias("id"), F.col(array_col).cast("array<double>").alias("point"))
    pts = write_cut(pts.where("point is not null"), "kmeans_points")
    first = pts.orderBy(F.md5(F.col("id").cast("string")), "id").limit(k).collect()
    centers, sizes = [r["point"] for r in first], [0] * len(first)
    if not centers:
        raise ValueError("no points")
    for _ in range(rounds):
        cells = nearest(pts, centers).select("cluster", F.posexplode("point").alias("dim", "x"))
        means = cells.groupBy("cluster", "dim").agg(F.avg("x").alias("value"), F.count(F.lit(1)).alias("n")).collect()
        centers, sizes = [list(c) for c in centers], [0] * len(centers)
        for r in means:
            centers[r["cluster"]][r["dim"]] = r["value"]
            sizes[r["cluster"]] = r["n"]
    rows = [(i, j, float(v), sizes[i]) for i, c in enumerate(centers) for j, v in enumerate(c)]
    table = points.sparkSession.createDataFrame(rows, "cluster int, dim int, value double, n long")
    return table, nearest(pts, centers).select("id", "cluster", "cost")


def tokens(docs: DataFrame, text_col: str = "text", out: str = "words") -> DataFrame:
    """Lower-cased runs of letters (any script) per document."""
    words = F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")
    return widen(docs).withColumn(out, F.filter(words, lambda w: w != F.lit("")))


def term_counts(docs: DataFrame, doc_col: str = "doc_id", words_col: str = "words") -> DataFrame:
    """(doc, term, n): the edges of the document-term graph; every term has rows."""
    return (docs.select(F.col(doc_col).alias("doc"), F.explode(words_col).alias("term"))
            .groupBy("doc", "term").agg(F.count(F.lit(1)).alias("n")))


def power_iteration_clusters(edges: DataFrame, k: int = 2, max_iter: int = 10,
                             init_mode: str = "degree", src: str = "src", dst: str = "dst",
                             weight: str = "weight") -> DataFrame:
    """(id, cluster) by power iteration clustering on a weighted, undirected graph.

    An affinity of a node with itself is not part of the graph, so self-loops
    are left out of the affinity matrix.
    """
    g = edges.where(F.col(src) != F.col(dst))
    pic = PowerIterationClustering(k=k, maxIter=max_iter, initMode=init_mode, srcCol=src,
                                   dstCol=dst, weightCol=weight)
    return pic.assignClusters(g).select(F.col("id").cast("long").alias("id"),
                                        F.col("cluster").cast("int").alias("cluster"))


def power_rounds(edges: DataFrame, rounds: int = 10, tolerance: float = 0.0, src: str = "src", dst: str = "dst",
                 weight: str = "weight", salts: int | None = None) -> DataFrame:
    """(id, value): power iteration on the row-normalised affinity.

    Edges are undirected and count both ways; self-loops are left out. The start
    is each node's share of all weight. A round multiplies by the affinity (a
    salted join of the edges with the vector, a keyed sum) and divides by the
    total, and the iteration stops early when the change of the vector changes
    by less than ``tolerance`` anywhere. Each round's vector is written; the
    driver sees two numbers a round.
    """
    one = edges.where(F.col(src) != F.col(dst)).select(F.col(src).alias("id"), F.col(dst).alias("other"),
                                                       F.col(weight).cast("double").alias("w"))
    both = write_cut(one.unionByName(one.select(F.col("other").alias("id"), F.col("id").alias("other"), "w"))
                     .groupBy("id", "other").agg(F.sum("w").alias("w")), "power_edges")
    degree = write_cut(both.groupBy("id").agg(F.sum("w").alias("degree")), "power_degree")
    total = degree.agg(F.sum("degree")).first()[0]
    state = degree.select("id", "degree", (F.col("degree") / F.lit(total)).alias("value"), F.lit(0.0).alias("step"))
    for turn in range(rounds):
        vector = state.select(F.col("id").alias("other"), "value")
        product = (salted_join(both, vector, "other", ["id"], salts)
                   .groupBy("id").agg(F.sum(F.col("w") * F.col("value")).alias("sum")))
        product = write_cut(product.join(degree, "id").select("id", (F.col("sum") / F.col("degree")).alias("next")), "power_product")
        norm = product.agg(F.sum(F.abs("next"))).first()[0]
        moved = product.select("id", (F.col("next") / F.lit(norm)).alias("next")).join(state, "id")
        step = F.abs(F.col("next") - F.col("value"))
        state = write_cut(moved.select("id", "degree", F.col("next").alias("value"), step.alias("step"),
                                       F.abs(step - F.col("step")).alias("turn")), "power_vector")
        if tolerance and turn and state.agg(F.max("turn")).first()[0] < tolerance:
            break
        state = state.drop("turn")
    return state.select("id", "value")


def line_clusters(values: DataFrame, k: int, rounds: int, id_col: str = "id", value_col: str = "value") -> DataFrame:
    """(id, cluster): k-means on a line, clusters numbered upwards.

    Centers start evenly between the least and the largest value; each round is
    one aggregate of ``k`` rows.
    """
    v = F.col(value_col)
    low, high = values.agg(F.min(v), F.max(v)).first()
    if low is None:
        return values.select(F.col(id_col).alias("id"), F.lit(0).alias("cluster"))
    centers = [low + (high - low) * (2 * j + 1) / (2 * k) for j in range(k)]

    def cluster() -> Column:
        return F.array_min(F.array(*(F.struct(F.abs(v - F.lit(c)).alias("d"), F.lit(j).alias("cluster"))
                                     for j, c in enumerate(centers))))["cluster"]

    for _ in range(rounds):
        for r in values.groupBy(cluster().alias("cluster")).agg(F.avg(v).alias("mean")).collect():
            centers[r["cluster"]] = r["mean"]
    return values.select(F.col(id_col).alias("id"), cluster().alias("cluster"))


def power_clusters(edges: DataFrame, k: int = 2, rounds: int = 10, tolerance: float = 0.0, line_rounds: int = 5,
                   **names) -> DataFrame:
    """(id, cluster, value): power iteration clustering as keyed rounds."""
    values = power_rounds(edges, rounds, tolerance, **names)
    return values.join(line_clusters(values, k, line_rounds), "id").select("id", "cluster", "value")
