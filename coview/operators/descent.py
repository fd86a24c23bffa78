"""Logistic regression by batch gradient descent, one aggregate per round.

The data stays on the executors; each round is a single ``agg`` with one sum
per dimension (partial sums per task, combined once), and only the D weights
travel to the driver and back into the next round's expressions as literals.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coview.functions.scalars import dot, sigmoid

# The start weights of the 10-dimension descent, the first ten
# draws of 2*nextDouble()-1 from java.util.Random(42).
START_WEIGHTS_SEED42 = (
    0.4551273600657362, 0.36644694351969087, -0.38256108933468047, -0.4458430198517267,
    0.33109790358914726, 0.8067445293443565, -0.2624341731773887, -0.44850386111659524,
    -0.07269284838169332, 0.5658035575800715,
)


def gradient_sum(points: DataFrame, features: Sequence[str], label: str,
                 weights: Sequence[float]) -> DataFrame:
    """One row ``g1..gD``: sum over points of ``(sigmoid(y w.x) - 1) y x_j`` (labels -1/+1)."""
    y = F.col(label)
    m = (F.lit(1.0) / (F.lit(1.0) + F.exp(-y * dot(features, weights))) - F.lit(1.0)) * y
    # The multiplier is computed once per row, then D sums share it.
    scaled = points.select(m.alias("_m"), *features)
    return scaled.agg(*[F.sum(F.col("_m") * F.col(x)).alias(f"g{j + 1}")
                        for j, x in enumerate(features)])


def logistic_gd(points: DataFrame, features: Sequence[str], label: str,
                start: Sequence[float], iterations: int) -> list[float]:
    """Weights after ``iterations`` rounds of ``w -= summed gradient`` (step 1, no intercept)."""
    w = list(start)
    data = points.select(label, *features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(iterations):
            g = gradient_sum(data, features, label, w).first()
            w = [wj - g[j] for j, wj in enumerate(w)]
    finally:
        data.unpersist()
    return w


def mean_gradient(points: DataFrame, features: Sequence[str], label: str,
                  weights: Sequence[float]) -> DataFrame:
    """One row ``g1..gD``: mean of ``(sigmoid(w.x) - y) x_j`` (labels 0/1)."""
    m = sigmoid(dot(features, weights)) - F.col(label)
    scaled = points.select(m.alias("_m"), *features)
    return scaled.agg(*[F.avg(F.col("_m") * F.col(x)).alias(f"g{j + 1}")
                        for j, x in enumerate(features)])


def logistic_sgd(points: DataFrame, features: Sequence[str], label: str, iterations: int,
                 step: float = 1.0, reg: float = 0.0,
                 start: Sequence[float] | None = None) -> list[float]:
    """Full-batch SGD as the old MLlib trainer runs it: zero start, step ``step/sqrt(t)``,
    mean gradient, optional L2 (``w *= 1 - eta*reg`` before the step), no intercept."""
    w = list(start) if start is not None else [0.0] * len(features)
    data = points.select(label, *features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for t in range(1, iterations + 1):
            g = mean_gradient(data, features, label, w).first()
            eta = step / math.sqrt(t)
            w = [wj * (1.0 - eta * reg) - eta * g[j] for j, wj in enumerate(w)]
    finally:
        data.unpersist()
    return w


def weights_frame(spark: SparkSession, w: Sequence[float], places: int = 6) -> DataFrame:
    """The D weights as one row ``w1..wD``, rounded with a 1e-9 bias."""
    cols = [f"w{j + 1}" for j in range(len(w))]
    df = spark.createDataFrame([tuple(float(x) for x in w)], cols)
    return df.select(*[F.round(F.col(c) + F.lit(1e-9), places).alias(c) for c in cols])
