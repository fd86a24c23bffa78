"""Tree learners on feature tables (Spark ML): trees, forests, boosted trees.

Each job trains on Spark (distributed histogram aggregation per level),
scores with ``model.transform`` and reduces the error with one aggregate.
Results come back as (metric, value) rows so that callers get a DataFrame.

A fitted model is also a table: ``node_table`` reads the nodes it saves as
Parquet, ``walk`` scores rows by joining them with their node level by level, and
``node_report`` and ``tree_audit`` hold what the nodes say against the rows that
reach them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coview.operators.evaluate import error_rate, mean_squared_error
from coview.operators.layout import deal
from coview.session import scratch_path, write_cut


def assemble(df: DataFrame, inputs: Sequence[str], label: str, out: str = "features") -> DataFrame:
    """(label double, features vector) from numeric columns (positional rows made named)."""
    va = VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid="error")
    return va.transform(df.select(*[F.col(c).cast("double").alias(c) for c in inputs],
                                  F.col(label).cast("double").alias("label"))).select("label", out)


def _metrics(spark: SparkSession, model, measure: DataFrame, name: str) -> DataFrame:
    value = measure.first()[0]
    rows = [(name, None if value is None else float(value))]
    if hasattr(model, "depth"):
        rows += [("depth", float(model.depth)), ("num_nodes", float(model.numNodes))]
    if hasattr(model, "getNumTrees"):
        rows += [("num_trees", float(model.getNumTrees))]
    return spark.createDataFrame(rows, "metric string, value double")


def _fit_score(est, train: DataFrame, test: DataFrame, measure: str):
    model = est.fit(train)
    scored = model.transform(test)
    m = (error_rate(scored, "prediction", "label") if measure == "error"
         else mean_squared_error(scored, "prediction", "label"))
    return model, m


def tree_classifier(data: DataFrame, max_depth: int = 5, max_bins: int = 32,
                    impurity: str = "gini", min_rows: int = 1):
    """Decision tree classifier; training error."""
    est = DecisionTreeClassifier(maxDepth=max_depth, maxBins=max_bins, impurity=impurity, minInstancesPerNode=min_rows)
    model, m = _fit_score(est, data, data, "error")
    return model, _metrics(data.sparkSession, model, m, "train_error")


def tree_regressor(data: DataFrame, max_depth: int = 5, max_bins: int = 32, min_rows: int = 1):
    """Decision tree regressor (variance); training MSE."""
    est = DecisionTreeRegressor(maxDepth=max_depth, maxBins=max_bins, impurity="variance", minInstancesPerNode=min_rows)
    model, m = _fit_score(est, data, data, "mse")
    return model, _metrics(data.sparkSession, model, m, "train_mse")


def forest_classifier(train: DataFrame, test: DataFrame, num_trees: int = 3, max_depth: int = 4,
                      max_bins: int = 32, seed: int = 12345, subset: str = "auto", bootstrap: bool = True):
    """Random forest classifier (gini); held-out error."""
    est = RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, bootstrap=bootstrap,
                                 impurity="gini", featureSubsetStrategy=subset, seed=seed)
    model, m = _fit_score(est, train, test, "error")
    return model, _metrics(train.sparkSession, model, m, "test_error")


def forest_regressor(train: DataFrame, test: DataFrame, num_trees: int = 3, max_depth: int = 4,
                     max_bins: int = 32, seed: int = 12345, subset: str = "auto", bootstrap: bool = True):
    """Random forest regressor (variance); held-out MSE."""
    est = RandomForestRegressor(numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, bootstrap=bootstrap,
                                impurity="variance", featureSubsetStrategy=subset, seed=seed)
    model, m = _fit_score(est, train, test, "mse")
    return model, _metrics(train.sparkSession, model, m, "test_mse")


def cells(data: DataFrame, classes: bool = False, label: str = "label") -> DataFrame:
    """(features, label, n, squares): one row for the rows of equal features, dealt by cells.

    Boosting parts rows by their features only, and a round's goal is linear in
    the label (or a function of the class, ``classes=True``: one row per features
    and label). So ``n`` rows learn as one row of their mean label with weight
    ``n``: sums, gains and leaves are those of the rows, as the variance within a
    cell is on either side of the gain. ``squares`` is the sum of squared labels.
    Features of few values have few cells however many rows there are; if all
    rows differ, there is a cell for each. A missing label stays missing.
    """
    y = F.col(label)
    found = data.groupBy("features", *([label] if classes else [])).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y * y).alias("squares"),
        F.when(F.count(y) == F.count(F.lit(1)), F.avg(y)).alias("mean"))
    return deal(found.select("features", (y if classes else F.col("mean")).alias(label), F.col("n").cast("double").alias("n"),
                             "squares"), "boost_cells")


def _weighted(est, train: DataFrame, min_rows: int):
    """``est`` fitted on cells, with at least ``min_rows`` rows, and not cells, on either side of a split."""
    rows = train.agg(F.sum("n")).first()[0] or 0.0
    if rows < 2 * min_rows:     # no split has so many
        est.setMinInstancesPerNode(min_rows)
    elif min_rows > 1:
        est.setMinWeightFractionPerNode((min_rows - 0.5) / rows)
    return est.setWeightCol("n").fit(train)


def gbt_classifier(data: DataFrame, rounds: int = 10, max_depth: int = 5, seed: int = 1, min_rows: int = 1):
    """Boosted trees classifier (two classes only); training error. ``data`` are rows or their ``cells`` by class."""
    data = data if "n" in data.columns else cells(data, True)
    model = _weighted(GBTClassifier(maxIter=rounds, maxDepth=max_depth, seed=seed), data, min_rows)
    wrong = F.sum(F.when(F.col("prediction") != F.col("label"), F.col("n")).otherwise(0.0))
    return model, _metrics(data.sparkSession, model, model.transform(data).agg(wrong / F.sum("n")), "train_error")


def gbt_regressor(train: DataFrame, test: DataFrame | None = None, rounds: int = 10,
                  max_depth: int = 5, seed: int = 1, min_rows: int = 1):
    """Boosted trees regressor (squared loss); MSE on ``test`` (training data if None).
    ``train`` are rows or their ``cells``, ``test`` are rows."""
    train = train if "n" in train.columns else cells(train)
    model = _weighted(GBTRegressor(maxIter=rounds, maxDepth=max_depth, seed=seed, lossType="squared"), train, min_rows)
    if test is None:
        n, p = F.col("n"), F.col("prediction")
        off = F.col("squares") - F.lit(2.0) * n * F.col("label") * p + n * p * p
        return model, _metrics(train.sparkSession, model, model.transform(train).agg(F.sum(off) / F.sum(n)), "train_mse")
    measure = mean_squared_error(model.transform(test), "prediction", "label")
    return model, _metrics(train.sparkSession, model, measure, "test_mse")


def model_text(model, full: bool = True) -> str:
    """The model as text: the whole tree dump, or the one-line summary."""
    return model.toDebugString if full else str(model)


# --- a fitted model as a table ------------------------------------------------

def _members(model) -> list:
    return list(model.trees) if hasattr(model, "trees") else [model]


def tree_depth(model) -> int:
    """The depth of a tree, or of an ensemble's deepest."""
    return max(t.depth for t in _members(model))


def node_table(model) -> DataFrame:
    """(tree, node, feature, threshold, prediction, stats): the saved model's nodes.

    ``node`` numbers a tree like a heap (root 1, children 2n and 2n + 1), so a
    number is also the way to the node. Leaves have no feature. ``stats`` holds
    what the node counted: rows per class, or rows, sum and sum of squares. At
    most ``trees * 2^(depth + 1)`` rows; continuous features only.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "tree_model")
    model.save(path)
    data = spark.read.parquet(f"{path}/data")
    data = data.select("treeID", "nodeData.*") if "treeID" in data.columns else data.withColumn("treeID", F.lit(0))
    inner = F.col("leftChild") >= 0
    nodes = data.select(
        F.col("treeID").cast("int").alias("tree"), "id", "leftChild", "rightChild", F.col("prediction").alias("prediction"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.col("impurityStats").alias("stats"))
    nodes = write_cut(nodes, "tree_nodes")
    level = nodes.where("id = 0").withColumn("node", F.lit(1).cast("long"))
    out = level
    for _ in range(tree_depth(model)):
        child = F.explode(F.array(F.struct(F.col("leftChild").alias("id"), (F.col("node") * 2).alias("node")),
                                  F.struct(F.col("rightChild").alias("id"), (F.col("node") * 2 + 1).alias("node"))))
        below = level.where("leftChild >= 0").select("tree", child.alias("c")).select("tree", "c.id", "c.node")
        level = nodes.join(below, ["tree", "id"])
        out = out.unionByName(level)
    return write_cut(out.select("tree", "node", "feature", "threshold", "prediction", "stats"), "tree_nodes")


def walk(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features") -> DataFrame:
    """``rows`` once per tree with ``tree``, the leaf ``node`` they reach, its
    ``prediction`` and ``stats``.

    One join with the node table per level; a row goes left where its value is
    at most the threshold. The node table is bounded by the model (see
    ``node_table``), which is what makes these joins map-side ones.
    """
    trees = [r["tree"] for r in nodes.select("tree").distinct().collect()]
    x = rows.withColumn("_x", vector_to_array(features))
    at = x.withColumn("tree", F.explode(F.array(*map(F.lit, sorted(trees))))).withColumn("node", F.lit(1).cast("long"))
    split = nodes.where("feature is not null").select("tree", "node", "feature", "threshold")
    for _ in range(depth):
        right = (F.get("_x", F.col("feature")) > F.col("threshold")).cast("long")
        at = at.join(split, ["tree", "node"], "left").withColumn(
            "node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.col("node") * 2 + right)).drop("feature", "threshold")
    return at.drop("_x").join(nodes.select("tree", "node", "prediction", "stats"), ["tree", "node"])


def node_report(data: DataFrame, model, label: str = "label") -> DataFrame:
    """(tree, node, feature, threshold, n, mean, prediction): every node with the
    rows of ``data`` that pass through it and the mean of their labels."""
    nodes, depth = node_table(model), tree_depth(model)
    reached = walk(data.select(label, "features"), nodes, depth).groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("sum"))
    ways = F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda k: F.call_function("shiftright", F.col("node"), k)))
    through = (reached.select("tree", ways.alias("node"), "n", "sum").where("node > 0")
               .groupBy("tree", "node").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")))
    return nodes.join(through, ["tree", "node"], "left").select(
        "tree", "node", "feature", "threshold", F.coalesce("n", F.lit(0)).alias("n"),
        (F.col("sum") / F.col("n")).alias("mean"), "prediction")


def _forest_prediction(kind: str) -> Column:
    """An ensemble's answer from its trees' leaves: the mean, or the class with
    the largest sum of class shares."""
    if kind == "regression":
        return F.avg("prediction")
    share = F.col("stats")[1] / (F.col("stats")[0] + F.col("stats")[1])
    return (F.avg(share) > 0.5).cast("double")


def forest_audit(model, train: DataFrame, test: DataFrame, kind: str, label: str = "label") -> DataFrame:
    """Per tree of a forest that was grown on all rows of ``train``: (tree, n,
    predicted_sum, leaves_off, rows_off).

    ``leaves_off`` counts leaves whose prediction is not the mean (or majority) of
    the training rows that reach them, ``predicted_sum`` is the sum of what the
    training rows are told, and ``rows_off`` counts ``test`` rows for which the
    walk and ``model.transform`` differ.
    """
    nodes, depth = node_table(model), tree_depth(model)
    leaves = walk(train.select(label, "features"), nodes, depth).groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean"), F.first("prediction").alias("prediction"))
    right = F.col("mean") if kind == "regression" else (F.col("mean") > 0.5).cast("double")
    off = F.count_if(F.abs(right - F.col("prediction")) > 1e-9 * (F.abs("prediction") + 1))
    per_tree = leaves.groupBy("tree").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("prediction")).alias("predicted_sum"),
                                          off.alias("leaves_off"))
    keyed = write_cut(test.select("features").withColumn("row", F.monotonically_increasing_id()), "tree_rows")
    walked = walk(keyed, nodes, depth).groupBy("row").agg(_forest_prediction(kind).alias("walked"))
    told = model.transform(keyed).select("row", "prediction").join(walked, "row")
    rows_off = told.agg(F.count_if(F.abs(F.col("walked") - F.col("prediction")) > 1e-9 * (F.abs("prediction") + 1)).alias("rows_off"))
    return per_tree.withColumn("rows_off", F.lit(rows_off.first()[0]).cast("long"))


def _leaf(nodes: Sequence, value) -> list:
    """``value(node)`` of a tree's nodes by heap number (0 unused)."""
    by = {r["node"]: r for r in nodes}
    return [value(by[i]) if i in by else None for i in range(max(by) + 1)]


def boosting_report(model, data: DataFrame, loss: str = "squared", label: str = "label") -> DataFrame:
    """(tree, node, feature, threshold, n, mean, prediction) of boosted trees; ``data``
    are rows or their ``cells``.

    ``mean`` is the mean of what that round had to learn, computed from the
    trees before it by walking them: the label at first, then the pseudo-residual
    ``2 (y - F)`` (``loss="squared"``) or ``4 y / (1 + exp(2 y F))``
    (``"logistic"``, labels 0 and 1 as y = -1 and 1). The trees are literals of
    the plan (bounded by the model, see ``node_table``), so one pass over the
    rows walks them all, level by level, and nothing is written or shuffled but
    partial sums per node.
    """
    nodes, depth = node_table(model), tree_depth(model)
    weights = [float(w) for w in model.treeWeights]
    trees = [[] for _ in weights]
    for r in nodes.collect():
        trees[r["tree"]].append(r)
    y = F.col(label) * 2 - 1 if loss == "logistic" else F.col(label)
    held = F.col("n").cast("long") if "n" in data.columns else F.lit(1)
    at = data.select(y.cast("double").alias("y"), vector_to_array("features").alias("_x"), held.alias("_held"),
                     *(F.lit(1).alias(f"_n{i}") for i in range(len(trees))))
    feature = [F.array(*(F.lit(v).cast("int") for v in _leaf(t, lambda r: r["feature"]))) for t in trees]
    threshold = [F.array(*(F.lit(v).cast("double") for v in _leaf(t, lambda r: r["threshold"]))) for t in trees]
    told = [F.array(*(F.lit(v).cast("double") for v in _leaf(t, lambda r: r["prediction"]))) for t in trees]
    for _ in range(depth):
        step = []
        for i in range(len(trees)):
            node = F.col(f"_n{i}")
            own = F.get(feature[i], node)
            right = (F.get("_x", own) > F.get(threshold[i], node)).cast("int")
            step.append(F.when(own.isNull(), node).otherwise(node * 2 + right).alias(f"_n{i}"))
        at = at.select("y", "_x", "_held", *step)
    at = at.select("y", "_held", *(f"_n{i}" for i in range(len(trees))),
                   *((F.lit(w) * F.get(told[i], F.col(f"_n{i}"))).alias(f"_p{i}") for i, w in enumerate(weights)))
    score, goals = F.lit(0.0), []
    for i in range(len(trees)):
        goal = (F.col("y") if not i else F.lit(2.0) * (F.col("y") - score) if loss == "squared"
                else F.lit(4.0) * F.col("y") / (F.lit(1.0) + F.exp(F.lit(2.0) * F.col("y") * score)))
        goals.append(F.struct(F.lit(i).alias("tree"), F.col(f"_n{i}").cast("long").alias("node"), goal.alias("goal")))
        score = score + F.col(f"_p{i}")
    sums = at.select("_held", F.explode(F.array(*goals)).alias("r")).groupBy("r.tree", "r.node").agg(
        F.sum("_held").alias("n"), F.sum(F.col("_held") * F.col("r.goal")).alias("sum"))
    ways = F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda k: F.call_function("shiftright", F.col("node"), k)))
    through = (sums.select("tree", ways.alias("node"), "n", "sum").where("node > 0")
               .groupBy("tree", "node").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")))
    return nodes.join(through, ["tree", "node"], "left").select(
        "tree", "node", "feature", "threshold", F.coalesce("n", F.lit(0)).alias("n"),
        (F.col("sum") / F.col("n")).alias("mean"), "prediction")
