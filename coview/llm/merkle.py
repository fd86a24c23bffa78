"""Merkle manifest of a table: one tree per group, one tree over the groups.

A row's leaf is the digest of its columns. Inside a group (a language) leaves
stand in id order, and every ``FAN`` consecutive nodes become the digest of
their digests until one, the subroot, is left; the subroots, in group order,
become the root the same way.

Proofs come from pointer jumping. Every inner node starts with a pointer to its
parent and the segment of its siblings' digests. A round joins the nodes with
themselves: a node takes over its ancestor's pointer and appends the ancestor's
segment to its own, so the distance doubles and a tree of height h needs
log2(h) rounds. Leaves join last, as whole runs of ``FAN`` siblings, with the
one segment all of them share: their parent's, which reaches the root by then.

All nodes of a large subtree point to the same ancestor in late rounds, so
those joins are salted: the few ancestors that are still wanted are repeated,
the many nodes below them are dealt out. Every round and every level is written
to the shared folder; a lost executor reads files again.

Cases: a null column counts as ``-``; null groups form a group of their own,
before all others; null ids come first; rows that share an id stand in order of
their digests, and equal rows are leaves of their own; a text of any length is
one leaf; an empty table has no rows and no root; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coview.llm.ordering import positions
from coview.session import write_cut

FAN = 8
_FAN_BITS = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: copies of an ancestor in a salted join, at most
MOST_SALTS = 4096

_STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, ``:`` and the text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: Sequence[str] = COLUMNS, changed: Mapping[str, Column] | None = None) -> Column:
    """A row's leaf, with the ``changed`` columns in place of its own."""
    changed = changed or {}
    return digest(*(field(changed.get(c, F.col(c))) for c in columns))


def fold(start: Column, proof: Column) -> Column:
    """The root that ``start`` leads to along ``proof``."""
    return F.aggregate(proof, start, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _node_id(level: Column | int, pos: str) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.concat_ws(":", level.cast("string"), F.col(pos).cast("string"), F.col("tree"))


def _climb(nodes: DataFrame) -> DataFrame:
    """Runs of up to ``FAN`` consecutive nodes of trees with more than one, each
    with the node it becomes: (tree, level, pos, size, id, hash, members)."""
    runs = (nodes.where("size > 1")
            .groupBy("tree", (F.col("level") + 1).alias("level"), F.shiftright("pos", _FAN_BITS).alias("pos"),
                     F.shiftright(F.col("size") + (FAN - 1), _FAN_BITS).alias("size"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "id", "hash"))).alias("members")))
    hashes = F.array_join(F.transform("members", lambda m: m["hash"]), "")
    return runs.withColumn("id", _node_id(F.col("level"), "pos")).withColumn("hash", F.sha2(hashes, 256))


_NODE = ("tree", "level", "pos", "size", "id", "hash")


def _build(nodes: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """The roots of all trees in ``nodes``, and the runs of every level."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels: list[DataFrame] = []
    current, roots = nodes.select(*_NODE), [nodes.where("size = 1").select(*_NODE)]
    while most > 1:
        levels.append(write_cut(_climb(current), f"{name}-{len(levels) + 1}"))
        current = levels[-1].select(*_NODE)
        roots.append(current.where("size = 1"))
        most = -(-most // FAN)
    return reduce(DataFrame.unionByName, roots), levels


def _around(hashes: Column, i: Column) -> Column:
    """Digests before and after the ``i``-th of a run, joined."""
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice(hashes, i + 2, F.lit(FAN)), "").alias("right"))


def _links(runs: DataFrame) -> DataFrame:
    """(node, up, steps, subroot): every member's pointer to its parent."""
    hashes = F.transform("members", lambda m: m["hash"])
    subroot = F.when((F.col("size") == 1) & (F.col("tree") != "top"), F.col("hash"))
    member = runs.select("members", "id", subroot.alias("subroot"), hashes.alias("hashes"),
                         F.posexplode("members.id").alias("i", "node"))
    return member.select("node", F.col("id").alias("up"),
                         F.array(_around(F.col("hashes"), F.col("i"))).cast(_STEP).alias("steps"), "subroot")


def _jump(state: DataFrame, top: str, distance: int) -> DataFrame:
    """One round: pointers of ``distance`` become pointers of twice that."""
    salts = min(FAN ** (distance // 2), MOST_SALTS) if distance >= 4 else 1
    going, there = state.where(F.col("up") != top), state.where(F.col("up") == top)
    wanted = going.select("up").distinct()
    above = (state.withColumnsRenamed({"node": "at", "up": "next", "steps": "more", "subroot": "above"})
             .join(wanted, F.col("at") == F.col("up"), "left_semi")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    below = going.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    far = below.join(above, (below["up"] == above["at"]) & (below["salt"] == above["salt"])).select(
        "node", F.col("next").alias("up"), F.concat("steps", "more").alias("steps"),
        F.coalesce("subroot", "above").alias("subroot"))
    return there.unionByName(far)


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group_col: str = "lang",
             id_col: str = "doc_id", keep: Mapping[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, *keep), one row per input row.

    ``proof`` holds for every level the digests to the left and to the right of
    the row's own path; ``fold(leaf, proof)`` gives the root. ``keep`` names
    expressions over the input row that are carried along.
    """
    keep = dict(keep or {})
    group = F.col(group_col).cast("string")
    leaves = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.concat(F.lit("."), group), F.lit("")).alias("tree"),
                         leaf_hash(columns).alias("leaf"), *(c.alias(f"keep_{k}") for k, c in keep.items()))
    kept = [f"keep_{k}" for k in keep]
    leaves = positions(leaves, ["tree"], ["doc_id", "leaf"], "merkle-leaves")
    # the lowest runs of siblings; a lone leaf is its group's subroot itself
    units = (leaves.groupBy("tree", "total", F.shiftright("at", _FAN_BITS).alias("pos"))
             .agg(F.array_sort(F.collect_list(F.struct("at", "doc_id", "leaf", *kept))).alias("leaves")))
    hashes = F.transform("leaves", lambda m: m["leaf"])
    units = units.select("tree", "pos", "leaves", F.shiftright(F.col("total") + (FAN - 1), _FAN_BITS).alias("size"),
                         (F.col("total") == 1).alias("alone"), F.lit(0).alias("level"),
                         F.when(F.col("total") == 1, hashes[0]).otherwise(F.sha2(F.array_join(hashes, ""), 256)).alias("hash"))
    units = write_cut(units.withColumn("id", _node_id(0, "pos")), "merkle-units")
    subroots, low = _build(units, "merkle-level")
    order = positions(subroots.select("tree", "id", "hash"), [], ["tree"], "merkle-subroots")
    tops, high = _build(order.select(F.lit("top").alias("tree"), F.lit(0).alias("level"), F.col("at").alias("pos"),
                                     F.col("total").alias("size"), "id", "hash"), "merkle-top")
    root = tops.first()
    root_id, root_hash = (root["id"], root["hash"]) if root else (None, None)
    levels = low + high
    found = units.withColumns({"steps": F.array().cast(_STEP), "subroot": F.lit(None).cast("string")})
    if levels:
        state = write_cut(reduce(DataFrame.unionByName, map(_links, levels)), "merkle-jump")
        distance = 1
        while distance < len(levels):
            state = write_cut(_jump(state, root_id, distance), "merkle-jump")
            distance *= 2
        found = units.join(state.drop("up"), units["id"] == state["node"], "left").drop("node")
    own = F.when(F.col("alone"), F.array().cast(_STEP)).otherwise(
        F.array(_around(F.col("hashes"), F.col("i"))).cast(_STEP))
    rows = found.select("alone", "hash", "steps", "subroot", F.transform("leaves", lambda m: m["leaf"]).alias("hashes"),
                        F.posexplode("leaves").alias("i", "m"))
    return rows.select(
        "m.doc_id", "m.leaf", F.coalesce("subroot", "hash").alias("subroot"), F.lit(root_hash).cast("string").alias("root"),
        F.concat(own, F.coalesce("steps", F.array().cast(_STEP))).alias("proof"),
        *(F.col(f"m.keep_{k}").alias(k) for k in keep))
