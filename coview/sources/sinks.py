"""Sinks and catalog operations: Parquet, text, tables, partitions, views.

Tables are created with an explicit location (the session catalog is
in-memory; no Hive is needed), so their files live in the shared folder the
caller names, not on a machine's local disk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] = ()) -> None:
    """Parquet write; by default it fails if the path exists."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def vector_text(id_col: str, values_col: str, value=lambda v: v.cast("double").cast("string")) -> "F.Column":
    """``id,[v1, v2, ...]`` as a text line (the factor dump format); ``value`` turns
    one number into text."""
    vals = F.transform(F.col(values_col), value)
    return F.concat(F.col(id_col).cast("string"), F.lit(",["), F.array_join(vals, ", "), F.lit("]"))


def write_text_lines(df: DataFrame, path: str, line, mode: str = "errorifexists") -> None:
    """One text line per row, built by the column expression ``line``."""
    df.select(line.alias("value")).write.mode(mode).text(path)


def create_table_as(spark: SparkSession, name: str, select_sql: str, location: str) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS name ... AS select``; an existing table is left as it is."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{location}' "
              f"AS {select_sql}")
    return spark.table(name)


def create_partitioned_table(spark: SparkSession, name: str, columns_ddl: str,
                             partition_col: str, location: str) -> None:
    """An external Parquet table partitioned by one string column (e.g. ``ds``)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}, {partition_col} STRING) "
              f"USING parquet PARTITIONED BY ({partition_col}) LOCATION '{location}'")


def insert_overwrite_partition(spark: SparkSession, name: str, partition_col: str,
                               value: str, select_sql: str) -> None:
    """``INSERT OVERWRITE TABLE name PARTITION (col='value') select``.

    The static partition spec replaces that one partition and leaves the
    others alone (no dynamic-overwrite setting needed).
    """
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({partition_col}='{value}') {select_sql}")


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace exactly the partitions of ``name`` that ``df`` has rows for.

    Dynamic overwrite, which file tables take from the session: it is set for
    this write alone. Columns are matched by position, the partition column
    last. A second run of the same day replaces the first instead of adding to
    it; older partitions are not read, let alone written.
    """
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, None)
    spark.conf.set(mode, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(name)
    finally:
        if before is None:
            spark.conf.unset(mode)
        else:
            spark.conf.set(mode, before)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temp view; registering the same name again replaces it."""
    df.createOrReplaceTempView(name)
    return df


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The catalog's tables and views as a DataFrame (``SHOW TABLES``)."""
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def use_database(spark: SparkSession, name: str) -> None:
    """Make ``name`` the current database (``USE name``)."""
    spark.catalog.setCurrentDatabase(name)
