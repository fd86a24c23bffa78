"""Edge-table jobs: distinct edges, union, PageRank, transitive closure.

Loop state is written to the shared checkpoint folder, so plans stay short and
a lost executor re-reads files instead of replaying earlier rounds. A node that
holds a large share of the edges never lands in one task: both loops salt.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coview.operators.layout import salted_join
from coview.session import scratch_path, write_cut


def distinct_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()


def edge_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two edge sets, then distinct."""
    return a.select("src", "dst").union(b.select("src", "dst")).distinct()


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: out-links of one source that stay together in PageRank's layout
LINKS_PER_SALT = 1 << 16


def pagerank(edges: DataFrame, iterations: int = 10, damping: float = 0.85,
             cut_every: int = 3, num_partitions: int | None = None,
             links_per_salt: int = LINKS_PER_SALT) -> DataFrame:
    """(node, rank) after ``iterations`` rounds, with the reference's semantics.

    Duplicate edges count once. Every node with an out-link starts at 1.0; each
    round a node's rank is ``0.15 + 0.85 * sum(rank_src / outdeg_src)`` over
    its in-links, and only nodes that received something keep a rank: a node
    without in-links drops out after round 1, a node without out-links gets a
    rank but passes nothing on. Zero rounds give 1.0 to every source.

    Layout: see ``pagerank_layout``. A round shuffles the ranks (one row per
    node and salt) to the kept edges, and the shares, summed map-side, to their
    targets.
    """
    layout = pagerank_layout(edges, num_partitions, links_per_salt)
    ranks = pagerank_start(layout)
    try:
        for i in range(1, iterations + 1):
            ranks = pagerank_round(layout, ranks, damping)
            if i % cut_every == 0 and i < iterations:
                ranks = write_cut(ranks, "pagerank")
        if iterations > 0:
            ranks = write_cut(ranks, "pagerank")
    finally:
        layout["links"].unpersist()
    return ranks


def pagerank_layout(edges: DataFrame, num_partitions: int | None = None,
                    links_per_salt: int = LINKS_PER_SALT) -> dict:
    """The loop-invariant tables of PageRank: ``links`` (src, salt, dst), hash
    partitioned on (src, salt) and kept, and ``ends`` (src, salt, deg), written.

    Every edge learns its source's out-degree once, by a salted join; from then
    on a source of d links has ``ceil(d / links_per_salt)`` salts: one for
    ordinary sources, and as many as spread it for a source that holds a third
    of all edges. ``ends`` has a row per source and salt. The caller unpersists
    ``links``.
    """
    n = num_partitions or _num_partitions(edges)
    links = write_cut(distinct_edges(edges), "pagerank_links")
    deg = write_cut(links.groupBy("src").agg(F.count(F.lit(1)).alias("deg")), "pagerank_degree")
    salts = F.ceil(F.col("deg") / links_per_salt)
    salted = salted_join(links, deg, "src", ["dst"]).select(
        "src", F.pmod(F.xxhash64("dst"), salts).alias("salt"), "dst")
    ends = write_cut(deg.select("src", "deg", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")),
                     "pagerank_ends")
    return {"links": salted.repartition(n, "src", "salt").persist(), "ends": ends, "deg": deg}


def pagerank_start(layout: dict) -> DataFrame:
    """Rank 1.0 for every node with an out-link."""
    return layout["deg"].select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))


def pagerank_round(layout: dict, ranks: DataFrame, damping: float = 0.85) -> DataFrame:
    """One round: each source's share ``rank / outdeg``, repeated for its salts,
    meets its edges where they are kept; shares are summed per target."""
    ends = layout["ends"]
    share = (ranks.join(ends, ranks["node"] == ends["src"])
             .select("src", "salt", (F.col("rank") / F.col("deg")).alias("share")))
    contrib = layout["links"].join(share, ["src", "salt"])
    return (contrib.groupBy("dst")
            .agg((F.lit(1.0 - damping) + F.sum("share") * F.lit(damping)).alias("rank"))
            .select(F.col("dst").alias("node"), "rank"))


#: places that the paths into one node are spread over
CLOSURE_SALTS = 16


class ClosureState:
    """The tables of a running closure, bucketed so that a round moves only what
    it finds.

    ``known`` (src, dst) is bucketed on both and grows in place, one partition a
    round. ``steps`` (src, dst, salt) holds every edge once per salt, bucketed on
    (src, salt); ``ends`` (src, dst, salt) holds a round's new paths, bucketed on
    (dst, salt), the salt a hash of ``src``: a node that a third of all paths
    reach fills ``salts`` buckets, each of which has the node's edges.
    """

    def __init__(self, edges: DataFrame, salts: int = CLOSURE_SALTS, buckets: int | None = None) -> None:
        self.spark, self.salts = edges.sparkSession, salts
        self.buckets = buckets or _num_partitions(edges)
        self.round = 0
        self._tables: dict[str, tuple[str, str]] = {}
        first = write_cut(distinct_edges(edges).dropna(), "closure_edges")
        steps = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        self._append("steps", steps.repartition(self.buckets, "src", "salt"), "src", "salt")
        self._learn(first.repartition(self.buckets, "src", "dst"))

    def _append(self, name: str, rows: DataFrame, *keys: str) -> None:
        table, path = self._tables.setdefault(
            name, (f"closure_{name}_{uuid.uuid4().hex[:12]}", scratch_path(self.spark, f"closure_{name}")))
        (rows.withColumn("round", F.lit(self.round))
         .write.mode("append").format("parquet").option("path", path)
         .partitionBy("round").bucketBy(self.buckets, *keys).saveAsTable(table))

    def _learn(self, paths: DataFrame) -> None:
        """Append ``paths`` to ``known`` and deal them out by their ends."""
        self._append("known", paths, "src", "dst")
        salted = self._latest("known").withColumn("salt", F.pmod(F.xxhash64("src"), F.lit(self.salts)).cast("int"))
        self._append("ends", salted.repartition(self.buckets, "dst", "salt"), "dst", "salt")

    def _table(self, name: str) -> DataFrame:
        return self.spark.table(self._tables[name][0])

    def _latest(self, name: str) -> DataFrame:
        return self._table(name).where(F.col("round") == self.round).drop("round")

    def found(self) -> DataFrame:
        """The paths that extend last round's by one edge and are not known yet.

        Its plan has one exchange: candidates, distinct per task before it, go
        where the known path of the same ends would be.
        """
        ends, steps = self._latest("ends").alias("p"), self._table("steps").alias("e")
        longer = ends.join(steps, (F.col("p.dst") == F.col("e.src")) & (F.col("p.salt") == F.col("e.salt")))
        candidates = longer.select("p.src", "e.dst").distinct()
        return candidates.join(self._table("known").select("src", "dst"), ["src", "dst"], "left_anti")

    def advance(self) -> bool:
        """Run one round; false when it finds nothing."""
        new = self.found()
        self.round += 1
        self._learn(new)
        return not self._latest("known").isEmpty()

    def close(self) -> DataFrame:
        """The closure as a plain scan; the catalog forgets the tables."""
        schema, path = self._table("known").schema, self._tables["known"][1]
        known = self.spark.read.schema(schema).parquet(path).select("src", "dst")
        for table, _ in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        return known


def transitive_closure(edges: DataFrame, salts: int = CLOSURE_SALTS, buckets: int | None = None) -> DataFrame:
    """All (src, dst) joined by a path of length >= 1; (x, x) when x is on a cycle.

    Semi-naive: each round extends only the paths found in the round before by
    one edge, removes what is already known (``left_anti``) and stops when a
    round adds nothing. Known paths and edges are never shuffled again; see
    ``ClosureState``. Edges without both ends are left out. ``buckets`` should equal the session's shuffle partitions
    (the default), or the anti-join has to move its smaller side once more.
    """
    state = ClosureState(edges, salts, buckets)
    try:
        while state.advance():
            pass
    finally:
        known = state.close()
    return known
