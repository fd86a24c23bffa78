"""Session construction and the shared scratch folder.

Everything that has to outlive a task (loop state, written tables, lineage
cuts) goes below the folder the cluster names in ``spark.checkpoint.dir``.
That setting is read from the running session; only when it is unset (tests,
a laptop) do we pick a folder of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "coview", extra: dict | None = None) -> SparkSession:
    """Build (or return) a session with the settings every job here assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _own_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="coview-ckpt-")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written tables.

    Order: the directory already set on the context, then the
    ``spark.checkpoint.dir`` setting. Only a ``local[...]`` master, whose driver
    and executors are one process, falls back to a fresh folder of our own; on
    a cluster an unset directory is an error, since executors would each write
    to their own disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context: use the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        return configured or _own_folder(spark.conf.get("spark.master", ""))
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = _own_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def parallelism(spark: SparkSession) -> int:
    """The cluster's task slots (``defaultParallelism``), or the shuffle
    partition count where the context is not reachable."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that does not exist yet, below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/coview/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's own switch: a query's shuffle files go when the query ends
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go as soon as each query ends,
    not when the driver's JVM next collects garbage. The session's setting is
    put back."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def write_cut(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder, read it back.

    One job computes and writes; the returned frame is a plain scan, so a lost
    executor re-reads files instead of replaying the loop that built them. The
    job's shuffle files are not needed any more and go with it.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_end(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
