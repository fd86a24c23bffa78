"""Row numbering and splits that stay distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coview.session import parallelism, write_cut

_POS_BITS = 33  # monotonically_increasing_id = partition id << 33 | position


def dense_index(df: DataFrame, order_by: Sequence[str], index_col: str = "row_index",
                num_partitions: int | None = None, seed: int = 42) -> DataFrame:
    """A 0-based dense index in ``order_by`` order, without a one-task window.

    Range-partition on the key (Spark samples the bounds, so skew is spread),
    sort inside each partition, and number rows per partition with
    ``monotonically_increasing_id``. The tagged rows are written once to the
    shared folder: range bounds come from sampling, so two evaluations of the
    same plan may cut differently, and the written copy is what both the
    counts and the rows are read from. The offset of each partition is the sum
    of the row counts before it: one row per partition, so the offset table is
    bounded by the partition count and broadcast safely.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A seeded random tie-break lets the range bounds split a key that holds a
    # large share of the rows; rows with equal keys have no order of their own.
    keys = [*order_by, "_tie"]
    ranged = (df.withColumn("_tie", F.rand(seed))
              .repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = write_cut(ranged.select(
        "*", F.shiftright("_mid", _POS_BITS).alias("_part"),
        (F.col("_mid") - F.shiftleft(F.shiftright("_mid", _POS_BITS), _POS_BITS)).alias("_pos")),
        "dense_index")
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(index_col, F.col("_off") + F.col("_pos"))
            .drop("_mid", "_part", "_pos", "_off", "_tie"))


def hash_split_flag(key: str, a: int = 7919, b: int = 104729, buckets: int = 10,
                    train_buckets: int = 7):
    """A repeatable 70/30 rule on an integer key: ``pmod(key*a + b, buckets) < train_buckets``."""
    return F.pmod(F.col(key) * F.lit(a) + F.lit(b), F.lit(buckets)) < train_buckets


def hash_split(df: DataFrame, key: str, **kw) -> tuple[DataFrame, DataFrame]:
    """(train, test) by ``hash_split_flag``; the same row always lands on the same side."""
    flag = hash_split_flag(key, **kw)
    return df.where(flag), df.where(~flag)


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 12345):
    """Seeded random split (the reference's split is unseeded)."""
    return df.randomSplit(list(weights), seed)


def widen(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a narrow input before CPU-heavy per-row work (splits, regexes).

    A scan has as many partitions as its files' splits; a few large files or
    one big row group give fewer tasks than cores. Only then is the input
    redistributed round-robin to ``min_partitions`` (default: the context's
    parallelism). Inputs that are already wide, as any large table is, are
    returned unchanged, so no shuffle is added at scale.

    Counting partitions plans the frame; call this on a scan (or a narrow
    projection of one), where planning runs no job.
    """
    target = min_partitions or parallelism(df.sparkSession)
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (Spark Connect): leave the layout to Spark
        return df
    if current >= target:
        return df
    return df.repartition(target)


#: rows of a task that a learner keeps in memory
ROWS_PER_TASK = 1 << 18


def deal(df: DataFrame, name: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` written once and dealt over as many tasks as its rows need (and at
    least the cluster's slots), for steps that read it often and keep it: what a
    task holds does not grow with the input, however few files there are."""
    written = write_cut(df, name)
    n = max(parallelism(df.sparkSession), -(-written.count() // rows))
    return written.repartition(n)


def salted_join(big: DataFrame, small: DataFrame, on: str, salt_on: Sequence[str],
                salts: int | None = None) -> DataFrame:
    """Inner join of ``big`` with ``small`` (at most one row per key) on ``on``,
    safe when one key holds any share of ``big``'s rows, and without a broadcast.

    ``big``'s rows get a salt from a hash of ``salt_on``; ``small``'s row of a
    key is repeated for the salts that the key's rows really have, which the
    distinct (key, salt) pairs of ``big`` tell. So a key meets its row in up to
    ``salts`` places, a key of a few rows in no more places than rows, and
    nothing depends on a threshold or on how large ``small`` is. No group in
    any step holds more than ``salts`` rows of a key except the last join's,
    where a key is spread over ``salts`` (default: the shuffle partitions, so
    that the largest key can fill the cluster).

    ``big`` is read twice: pass a scan or a written table. Null keys meet nothing.
    """
    n = salts or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(n)).cast("int"))
    met = salted.select(on, "_salt").distinct()
    return salted.join(small.join(met, on), [on, "_salt"]).drop("_salt")


#: pairs that a task of a pair expansion is to make
PAIRS_PER_TASK = 1 << 21


def spread_by_pairs(groups: DataFrame, key: str, n_pairs: int, least: int | None = None,
                    per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """``groups`` dealt by ``key`` over as many tasks as ``n_pairs`` needs (and at
    least ``least``, default: the cluster's slots). An explicit count, which
    AQE does not coalesce: the step behind it makes far more than it reads."""
    n = max(least or parallelism(groups.sparkSession), -(-n_pairs // per_task))
    return groups.repartition(n, key)
