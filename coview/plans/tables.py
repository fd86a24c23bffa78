"""Access to the driver's tables (one Parquet file each below ``sf_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy scan; column pruning and filters reach the Parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
