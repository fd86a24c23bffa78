"""Access-log roll-up: request count and bytes per (ip, user, request)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coview.operators.layout import widen
from coview.sources.readers import parse_access_log


def log_rollup(lines: DataFrame, col: str = "value") -> DataFrame:
    """(ip, user, request, n, bytes) per key.

    A line that matches and whose user is not ``-`` (any case) keys on
    (ip, user, request); the user keeps its quotes. A matching line with user
    ``-`` goes to the all-NULL key with its bytes; a line that does not match
    goes there with 0 bytes. Counts and byte sums are 64-bit.
    """
    p = parse_access_log(widen(lines), col)
    keep = F.col("matched") & (F.lower(F.col("user")) != F.lit("-"))
    key = lambda c: F.when(keep, F.col(c))  # noqa: E731  NULL otherwise
    return (p.select(key("ip").alias("ip"), key("user").alias("user"),
                     key("request").alias("request"), "bytes")
            .groupBy("ip", "user", "request")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").cast("long").alias("bytes")))
