"""Readers: files and text columns to typed DataFrames.

Each ``parse_*`` takes a frame with a text column (``value`` by default, as
``spark.read.text`` gives it) so the same projection serves a file, a table
column or a stream. Parsing is built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.functions.scalars import java_split

BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("behavior_type", T.IntegerType()),
    T.StructField("user_geohash", T.StringType()),
    T.StructField("item_category", T.IntegerType()),
    T.StructField("time", T.StringType()),
])

RATING_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
])

# The access-log pattern of the log roll-up (nine groups: ip,
# identity, user, time, request, status, bytes, referrer, agent).
ACCESS_LOG_PATTERN = r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) ([\d\-]+) "([^"]+)" "([^"]+)".*'


def _guard(value, ok, on_bad: str, what: str):
    """``value`` where ``ok``; otherwise fail the job (``fail``) or give NULL (``drop``,
    with the row removed by the caller). The check sits inside an output column,
    so column pruning cannot remove it."""
    if on_bad == "fail":
        return F.when(ok, value).otherwise(F.raise_error(F.lit(f"bad {what} line")))
    if on_bad == "drop":
        return value
    raise ValueError(f"on_bad must be 'fail' or 'drop', not {on_bad!r}")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value`` (one row per line, any of \\n, \\r, \\r\\n)."""
    return spark.read.text(path)


def read_behavior_csv(spark: SparkSession, path: str, keep: int | None = 1) -> DataFrame:
    """The comma-separated behaviour log; with ``keep``, (user_id, item_id) of that behaviour."""
    df = spark.read.csv(path, schema=BEHAVIOR_SCHEMA, mode="FAILFAST")
    if keep is None:
        return df
    return df.where(F.col("behavior_type") == keep).select("user_id", "item_id")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``user,item,rating`` lines."""
    return spark.read.csv(path, schema=RATING_SCHEMA, mode="FAILFAST")


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LibSVM rows (label, sparse 1-based ``i:v``) as (label, features vector)."""
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; the schema is inferred (fields sorted by name, integers as bigint) unless given."""
    return spark.read.json(path, schema=schema) if schema is not None else spark.read.json(path)


def parse_json_column(df: DataFrame, col: str, schema: T.StructType | str) -> DataFrame:
    """A JSON text column to a struct column of the same name."""
    return df.withColumn(col, F.from_json(F.col(col), schema))


def json_column_schema(df: DataFrame, col: str) -> str:
    """The schema of a JSON text column as a type string, without writing it.

    Each text becomes a VARIANT and the schemas are merged by an aggregate (one
    row per task is shuffled). As with JSON files, objects are structs with
    fields by name, whole numbers are bigint, and a field that is always null
    is a string. An empty table has an empty struct.
    """
    merged = df.select(F.schema_of_variant_agg(F.parse_json(col))).first()[0]
    if merged == "VOID":
        return "STRUCT<>"
    return merged.replace("OBJECT<", "STRUCT<").replace(": VOID", ": STRING").replace("<VOID>", "<STRING>")


def infer_json_column(df: DataFrame, col: str) -> DataFrame:
    """A JSON text column to a struct column of the same name, its schema inferred."""
    return parse_json_column(df, col, json_column_schema(df, col))


def parse_labeled_points(lines: DataFrame, col: str = "value") -> DataFrame:
    """``y,x1 x2 ... xn`` to (label double, features array<double>)."""
    parts = F.split(F.col(col), ",")
    xs = java_split(parts.getItem(1), " ")
    return lines.select(parts.getItem(0).cast("double").alias("label"),
                        F.transform(xs, lambda x: x.cast("double")).alias("features"))


def parse_dense_vectors(lines: DataFrame, col: str = "value", trim: bool = False) -> DataFrame:
    """Space-separated numbers to ``features array<double>`` (LDA trims first, k-means does not)."""
    c = F.trim(F.col(col)) if trim else F.col(col)
    return lines.select(F.transform(java_split(c, " "), lambda x: x.cast("double")).alias("features"))


def parse_label_first(lines: DataFrame, dims: int = 10, col: str = "value",
                      on_bad: str = "fail") -> DataFrame:
    """Label, then exactly ``dims`` values; extra tokens ignored, too few is an error."""
    toks = java_split(F.col(col), " ")
    df = lines.select(toks.alias("_t"))
    ok = F.size("_t") >= dims + 1
    if on_bad == "drop":
        df = df.where(ok)
    return df.select(_guard(F.col("_t").getItem(0).cast("double"), ok, on_bad, "point").alias("label"),
                     F.transform(F.slice("_t", 2, dims), lambda x: x.cast("double")).alias("x"))


def parse_transactions(lines: DataFrame, col: str = "value") -> DataFrame:
    """Items split on a space: ``items array<string>``."""
    return lines.select(java_split(F.col(col), " ").alias("items"))


def parse_edge_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``src<ws>dst ...`` lines: the first two whitespace-separated fields as strings."""
    parts = F.split(F.col(col), r"\s+")
    return lines.select(parts.getItem(0).alias("src"), parts.getItem(1).alias("dst"))


def parse_people_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``name, age`` to (name string, age int); the age is trimmed first.

    A line without an age gives a NULL age (so a range filter drops it).
    """
    parts = F.split(F.col(col), ",")
    return lines.select(parts.getItem(0).alias("name"),
                        F.trim(F.get(parts, 1)).cast("int").alias("age"))


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Access-log lines to (matched, ip, user, request, bytes).

    One regex run a line: a matching line is replaced by its ip, bytes, user and
    request, which are apart at the first three spaces as only the request may
    hold one; a line that does not match stays as it is, and a match never
    does. Texts of a line without a match are ''. Bytes ``-`` (the pattern allows
    it) become 0.
    """
    found = F.regexp_replace(F.col(col), ACCESS_LOG_PATTERN + r"[\s\S]*", "$1 $7 $3 $5")
    parts = lines.select((found != F.col(col)).alias("matched"), F.split(found, " ", 4).alias("_p"))
    text = lambda i: F.when(F.col("matched"), F.get("_p", i)).when(~F.col("matched"), "")
    nbytes = F.when(~F.col("matched"), F.lit(0).cast("long")).otherwise(
        F.coalesce(F.expr("try_cast(_p[1] AS BIGINT)"), F.lit(0).cast("long")))
    return parts.select("matched", text(0).alias("ip"), text(2).alias("user"), text(3).alias("request"),
                        nbytes.alias("bytes"))
