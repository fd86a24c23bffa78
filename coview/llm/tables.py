"""Inputs of the queries: the tables below ``sf_dir`` and the tokenizer files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies; the same on driver and executors."""
    import public_tokenizers
    return str(public_tokenizers.path(name))
