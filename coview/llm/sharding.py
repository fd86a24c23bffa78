"""Sharding by extendible hashing.

Every row has a 62-bit hash of its key; a directory indexed by the first bits
starts at ``first_bits``, and only buckets over the byte limit split, one more
bit at a time, until each shard fits. The bytes of the directory's slots come
from aggregations (combined before their shuffle); a pass looks ``step_bits``
deeper, and only into the slots still over the limit, so what the driver holds
is the directory, whose size follows bytes / limit.

The lowest 30 bits are a hash of the row's position in the scan, so a key that
holds a large share of the rows also splits. A single row over the limit is a
shard of its own and marked ``oversized``.

Cases: a null key is a key like any other; a null or empty text has no bytes
but is placed; repeated rows are placed one by one; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 62
SHARD_BYTES = 1 << 20


def _hashed(docs: DataFrame, key_col: str, text_col: str, overhead: int) -> DataFrame:
    key = F.shiftright(F.xxhash64(F.col(key_col)), 0).bitwiseAND(F.lit((1 << 32) - 1))
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 30) - 1))
    return docs.select(F.col(key_col).alias("key"),
                       (F.shiftleft(key, 30) + place).alias("hash"),
                       (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(overhead))
                       .cast("long").alias("bytes"))


def directory(rows: DataFrame, limit: int, first_bits: int = 8, step_bits: int = 6) -> list[tuple]:
    """Shards ``(bits, prefix, bytes)``: every hash has exactly one prefix here."""
    shards: list[tuple] = []
    open_at: list[int] | None = None
    bits = 0
    while open_at is None or open_at:
        deeper = min(HASH_BITS, bits + (first_bits if open_at is None else step_bits))
        part = rows
        if open_at:
            prefixes = rows.sparkSession.createDataFrame([(p,) for p in open_at], "prefix long")
            part = rows.join(prefixes, F.shiftright("hash", HASH_BITS - bits) == F.col("prefix"), "left_semi")
        slots = {r["slot"]: r["bytes"] for r in
                 part.groupBy(F.shiftright("hash", HASH_BITS - deeper).alias("slot"))
                 .agg(F.sum("bytes").alias("bytes")).collect()}
        still_open = []
        for start in (open_at or [0]):
            todo = [(bits, start)]
            while todo:
                b, prefix = todo.pop()
                low, high = prefix << (deeper - b), (prefix + 1) << (deeper - b)
                if b == deeper:
                    size = slots.get(prefix, 0)
                else:
                    size = sum(v for k, v in slots.items() if low <= k < high)
                if size <= limit or b == HASH_BITS:
                    shards.append((b, prefix, size))
                elif b == deeper:
                    still_open.append(prefix)
                else:
                    todo += [(b + 1, 2 * prefix + 1), (b + 1, 2 * prefix)]
        bits, open_at = deeper, still_open
    return sorted(shards, key=lambda s: s[1] << (HASH_BITS - s[0]))


def shard(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES,
          overhead: int = 0) -> DataFrame:
    """key, bytes, shard_id (in hash order), shard_bits, shard_prefix, shard_bytes
    and ``oversized`` for every row."""
    rows = _hashed(docs, key_col, text_col, overhead)
    shards = directory(rows, limit)
    schema = T.StructType([T.StructField("shard_id", T.LongType()), T.StructField("shard_bits", T.IntegerType()),
                           T.StructField("shard_prefix", T.LongType()), T.StructField("shard_bytes", T.LongType())])
    table = rows.sparkSession.createDataFrame([(i, b, p, n) for i, (b, p, n) in enumerate(shards)], schema)
    depths = sorted({b for b, _, _ in shards})
    # one candidate prefix for each depth in use; the directory holds exactly one of them
    placed = rows.withColumn("shard_bits", F.explode(F.array(*map(F.lit, depths))))
    placed = placed.withColumn("shard_prefix", F.expr(f"shiftright(hash, {HASH_BITS} - shard_bits)"))
    return (placed.join(table, ["shard_bits", "shard_prefix"])
            .select("key", "bytes", "shard_id", "shard_bits", "shard_prefix", "shard_bytes",
                    (F.col("shard_bytes") > limit).alias("oversized")))
