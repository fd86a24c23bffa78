"""Error measures and label counts, each a single aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_squared_error(df: DataFrame, prediction: str, label: str,
                       by: Sequence[str] = ()) -> DataFrame:
    """``avg((p - y)^2)`` (NULL on an empty input), optionally per group."""
    e = F.avg(F.pow(F.col(prediction) - F.col(label), 2)).alias("mse")
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def error_rate(df: DataFrame, prediction: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction differs from the label."""
    e = F.avg((F.col(prediction) != F.col(label)).cast("double")).alias("error_rate")
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def class_count(df: DataFrame, label: str) -> DataFrame:
    """Number of distinct label values (``countByValue().size()``)."""
    return df.agg(F.countDistinct(label).alias("n_classes"))
