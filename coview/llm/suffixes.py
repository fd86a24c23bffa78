"""Duplicate-passage removal by deep-shallow suffix sorting.

Every byte covered by a string of ``span`` bytes that also starts earlier
(smaller id, or same document and earlier start) is removed. Suffixes are
sorted to ``span`` bytes only, which decides every such match.

A suffix matters only if its first ``span`` bytes occur twice. Each window of
that length has an anchor, the smallest hash among its ``gram``-byte grams, so
equal windows have equal anchors. A first pass finds the anchors that occur at
two places (aggregated per gram, combined before the shuffle; exact copies of
a whole text count once). Their hashes go into a bitmap of fixed size; a false
hit only sorts a suffix in vain. A second pass sends the surroundings of those
anchors, equal ones of a batch once, to the sorting tasks.

There, equal surroundings are settled together, and the suffixes of the rest
are ordered per gram and distance: a multikey quicksort over 8-byte characters
goes down to ``shallow`` bytes, dropping suffixes as they become unique; the
groups that are left have long common prefixes and are ordered by blind tries.
Suffixes of one leaf are equal; all but the earliest mark their bytes.

Cases: a null text is empty; texts shorter than ``span`` lose nothing; exact
copies of a text are removed whole after the first; rows that share an id come
in the order of the scan; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.llm import kernel as K
from coview.session import write_cut

SPAN, GRAM, SHALLOW = 100, 32, 40
FILTER_BITS = 1 << 26
_PLACE = np.uint64((1 << 24) - 1)
SEGMENT = 1 << 22
BLOCK = 1 << 18  # bytes of text whose anchors are found at once


def anchors(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """(document, place, gram hash, least and largest distance): the anchors of
    all windows, with the window starts ``place - distance`` they answer for."""
    reach = span - gram + 1
    parts = []
    n = len(data)
    for at in range(0, max(n - span + 1, 0), SEGMENT):
        piece = data[at: min(n, at + SEGMENT + span - 1)]
        c = K.prefix_hash(piece)
        starts = np.arange(len(piece) - gram + 1)
        h = K.span_hash(c, starts, starts + gram)
        low = (h & ~_PLACE) | starts.astype(np.uint64)
        size = 1
        while size * 2 <= reach:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[: len(low) - (reach - size)], low[reach - size:])
        p = np.arange(len(low)) + at
        doc = np.searchsorted(offsets, p, side="right") - 1
        inside = p + span <= offsets[doc + 1]
        place = (low & _PLACE).astype(np.int64)[inside]
        p, doc = p[inside], doc[inside]
        if not len(p):
            continue
        new = np.ones(len(p), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(p)) - 1
        a = place[first] + at
        parts.append((doc[first], a, h[place[first]], a - p[last], a - p[first]))
    if not parts:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),) + (np.zeros(0, dtype=np.int64),) * 2
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram hash and where it stands (text digest and place, hashed)."""
    for batch in batches:
        for block in K.text_blocks(batch.column(2), BLOCK):
            doc, place, h, _, _ = anchors(block.data, block.offsets)
            text = K.span_hash(K.prefix_hash(block.data), block.offsets[:-1], block.offsets[1:])
            where = K.mix(text[doc] + (place - block.offsets[doc]).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(where.view(np.int64))],
                                             names=["gram", "place"])


def _surroundings(data: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Bytes ``place - (SPAN - GRAM)`` to ``place + SPAN``, zero outside ``[low, high)``."""
    at = place[:, None] + np.arange(-(SPAN - GRAM), SPAN)
    out = data[np.clip(at, 0, max(len(data) - 1, 0))]
    out[(at < low[:, None]) | (at >= high[:, None])] = 0
    return out


def _keys(rows: np.ndarray) -> np.ndarray:
    """Byte rows as big-endian 8-byte characters (padded with zeros)."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), dtype=np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def multikey_groups(group: np.ndarray, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order rows by group and then character by character. Returns the rows
    that never became unique and their groups (equal in all characters)."""
    rows = np.arange(len(group))
    for j in range(characters.shape[1] + 1):
        if not len(rows):
            break
        key = characters[rows, j - 1] if j else np.zeros(len(rows), dtype=np.uint64)
        order = np.lexsort((key, group))
        rows, group, key = rows[order], group[order], key[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        keep = np.bincount(group)[group] > 1
        rows, group = rows[keep], group[keep]
    return rows, group


class BlindTrie:
    """Orders strings of one length that share a long prefix. A search looks
    only at the branching bytes, then one comparison tells where it left."""

    def __init__(self) -> None:
        self.root: list | int | None = None
        self.leaves: list[bytes] = []

    def insert(self, s: bytes) -> int:
        """The leaf number of ``s``; equal strings share a leaf."""
        if self.root is None:
            self.leaves.append(s)
            self.root = 0
            return 0
        node = self.root
        while isinstance(node, list):
            node = node[1].get(s[node[0]], next(iter(node[1].values())))
        other = self.leaves[node]
        if other == s:
            return node
        split = next(i for i, (a, b) in enumerate(zip(s, other, strict=True)) if a != b)
        self.leaves.append(s)
        leaf = len(self.leaves) - 1
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < split:
            parent, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == split:
            node[1][s[split]] = leaf
        else:
            branch = [split, {other[split]: node, s[split]: leaf}]
            if parent is None:
                self.root = branch
            else:
                parent[1][s[parent[0]]] = branch
        return leaf


def equal_suffixes(group: np.ndarray, strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose group and bytes occur at least twice, and their classes."""
    rows, group = multikey_groups(group, _keys(strings[:, :shallow]))
    if not len(rows):
        return rows, group
    new = np.ones(len(rows), dtype=bool)
    new[1:] = group[1:] != group[:-1]
    head = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
    same = (strings[rows, shallow:] == strings[head, shallow:]).all(axis=1)
    leaf = np.zeros(len(rows), dtype=np.int64)
    # groups that are not all equal to their first row: a blind trie each
    mixed = np.unique(group[~same])
    at = np.flatnonzero(np.isin(group, mixed))
    trie, current = None, -1
    for i in at.tolist():
        if group[i] != current:
            trie, current = BlindTrie(), group[i]
        leaf[i] = trie.insert(strings[rows[i], shallow:].tobytes())
    order = np.lexsort((leaf, group))
    rows, group, leaf = rows[order], group[order], leaf[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (leaf[1:] != leaf[:-1])
    cls = np.cumsum(new) - 1
    keep = np.bincount(cls)[cls] > 1
    return rows[keep], cls[keep]


def _not_first(cls: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Flags of the members that are not the earliest of their class."""
    best = np.full(int(cls.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(best, cls, rank)
    return rank != best[cls]


class _Sites:
    """Anchors with surroundings, in columns."""

    def __init__(self, gram, doc_id, uid, place, least, most, around):
        self.gram, self.doc_id, self.uid, self.place = gram, doc_id, uid, place
        self.least, self.most, self.around = least, most, around

    def rank(self) -> np.ndarray:
        order = np.lexsort((self.place, self.uid, self.doc_id))
        out = np.empty(len(order), dtype=np.int64)
        out[order] = np.arange(len(order))
        return out

    def take(self, at) -> _Sites:
        return _Sites(*(x[at] for x in (self.gram, self.doc_id, self.uid, self.place, self.least,
                                        self.most, self.around)))

    def collapse(self):
        """Sites with one row per equal (gram, surroundings, distances), and the
        byte ranges that the others lose: (uid, start, end)."""
        tail = np.stack([self.gram.view(np.uint64), (self.least * 256 + self.most).astype(np.uint64)], axis=1)
        rows, cls = multikey_groups(np.zeros(len(self.gram), dtype=np.int64),
                                    np.hstack([tail, _keys(self.around)]))
        if not len(rows):
            return self, (self.uid[:0], self.place[:0], self.place[:0])
        later = rows[_not_first(cls, self.rank()[rows])]
        lost = (self.uid[later], self.place[later] - self.most[later],
                self.place[later] - self.least[later] + SPAN)
        keep = np.ones(len(self.gram), dtype=bool)
        keep[later] = False
        return self.take(keep), lost

    def sort(self):
        """Byte ranges lost to equal suffixes among the sites."""
        order = np.argsort(self.gram, kind="stable")
        g = self.gram[order]
        new = np.ones(len(g), dtype=bool)
        new[1:] = g[1:] != g[:-1]
        group = np.empty(len(g), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        many = np.bincount(group, minlength=1)[group] > 1
        sites, group, rank = self.take(many), group[many], self.rank()[many]
        out = [(self.uid[:0], self.place[:0], self.place[:0])]
        for d in range(SPAN - GRAM + 1):
            at = np.flatnonzero((sites.least <= d) & (d <= sites.most))
            if not len(at):
                continue
            left = SPAN - GRAM - d
            rows, cls = equal_suffixes(group[at], sites.around[at, left: left + SPAN])
            if len(rows):
                later = at[rows[_not_first(cls, rank[at][rows])]]
                start = sites.place[later] - d
                out.append((sites.uid[later], start, start + SPAN))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def merge_ranges(uid: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of ranges per uid (touching ranges join)."""
    order = np.lexsort((start, uid))
    uid, start, end = uid[order], start[order], end[order]
    if not len(uid):
        return uid, start, end
    base = np.zeros(len(uid), dtype=np.int64)
    base[1:] = np.cumsum(uid[1:] != uid[:-1])
    stride = int(end.max()) + 2
    top = np.maximum.accumulate(end + base * stride)
    new = np.ones(len(uid), dtype=bool)
    new[1:] = start[1:] + base[1:] * stride > top[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(uid)) - 1
    return uid[first], start[first], top[last] - base[last] * stride


_SITE = T.StructType([T.StructField(c, T.LongType()) for c in
                      ("gram", "doc_id", "uid", "place", "least", "most")] + [T.StructField("around", T.BinaryType())])
_RANGE = T.StructType([T.StructField(c, T.LongType()) for c in ("uid", "start", "end")])


def _site_batch(s: _Sites, lost) -> Iterator[pa.RecordBatch]:
    """Sites, and lost ranges as rows without surroundings (gram is their uid)."""
    if len(s.gram):
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x) for x in (s.gram, s.doc_id, s.uid, s.place, s.least, s.most)),
             pa.array([r.tobytes() for r in s.around], type=pa.binary())], names=_SITE.names)
    uid, start, end = merge_ranges(*lost)
    if len(uid):
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x) for x in (uid, uid, uid, start, start, end)), pa.nulls(len(uid), pa.binary())],
            names=_SITE.names)


def _sites(batches: Iterator[pa.RecordBatch], bits) -> Iterator[pa.RecordBatch]:
    found = bits.value
    for batch in batches:
        ids, uids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        parts = []
        for block in K.text_blocks(batch.column(2), BLOCK):
            doc, place, h, least, most = anchors(block.data, block.offsets)
            slot = (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            on = (found[slot >> 3] >> (slot & 7) & 1).astype(bool)
            doc, place, h, least, most = (x[on] for x in (doc, place, h, least, most))
            if len(doc):
                row = block.first + doc
                parts.append((h.view(np.int64), ids[row], uids[row], place - block.offsets[doc], least, most,
                              _surroundings(block.data, block.offsets[doc], block.offsets[doc + 1], place)))
        if parts:
            yield from _site_batch(*_Sites(*(np.concatenate(x) for x in zip(*parts, strict=True))).collapse())


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All sites of a sorting task at once; the number of tasks follows the sites."""
    cols, lost = [], []
    for b in batches:
        x = [b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        site = b.column(6).is_valid().to_numpy(zero_copy_only=False)
        lost.append((x[2][~site], x[3][~site], x[5][~site]))
        around = np.frombuffer(b"".join(b.column(6).drop_null().to_pylist()), dtype=np.uint8)
        cols.append([*(c[site] for c in x), around.reshape(-1, 2 * SPAN - GRAM)])
    if not cols:
        return
    sites, more = _Sites(*(np.concatenate(x) for x in zip(*cols, strict=True))).collapse()
    lost += [more, sites.sort()]
    uid, start, end = merge_ranges(*(np.concatenate(x) for x in zip(*lost, strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (uid, start, end)], names=_RANGE.names)


def _bitmap(slots: DataFrame, size: int) -> np.ndarray:
    rows = (slots.groupBy(F.shiftright("slot", 15).alias("part"))
            .agg(F.expr("bitmap_construct_agg(slot & 32767)").alias("bits")).collect())
    out = np.zeros((size >> 15, 4096), dtype=np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out.reshape(-1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_removed, n_spans, sha = [], [], []
        for text, ranges in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            raw = text.encode("utf-8")
            spans = np.array([(r["start"], r["end"]) for r in ranges], dtype=np.int64).reshape(-1, 2)
            _, start, end = merge_ranges(np.zeros(len(spans), dtype=np.int64), spans[:, 0], spans[:, 1])
            edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(raw)]
            kept = b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
            n_removed.append(len(raw) - len(kept))
            n_spans.append(len(start))
            sha.append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_removed, type=pa.int64()), pa.array(n_spans, type=pa.int64()),
             pa.array(sha, type=pa.string())], names=["uid", "removed", "spans", "sha"])


def removed_ranges(rows: DataFrame, sites_per_task: int = 50_000) -> DataFrame:
    """(uid, start, end) byte ranges of ``rows`` (doc_id, uid, text); the ranges
    of one uid may overlap."""
    spark = rows.sparkSession
    grams = rows.mapInArrow(_grams, "gram long, place long")
    twice = (grams.groupBy("gram").agg(F.min("place").alias("a"), F.max("place").alias("b"), F.count("*").alias("n"))
             .where("a <> b"))
    twice = write_cut(twice.select(F.expr(f"gram & {FILTER_BITS - 1}").alias("slot"), "n"), "grams")
    total = twice.agg(F.sum("n")).first()[0] or 0
    bits = spark.sparkContext.broadcast(_bitmap(twice.select("slot"), FILTER_BITS))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // sites_per_task + 1)
    sites = rows.mapInArrow(partial(_sites, bits=bits), _SITE).repartition(tasks, "gram")
    return sites.mapInArrow(_sort, _RANGE)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    whole = write_cut(rows.select("doc_id", "uid", F.octet_length("text").cast("long").alias("n_bytes"),
                                  F.sha2("text", 256).alias("sha")), "texts")
    order = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))), "uid")
    first = whole.groupBy(F.col("sha").alias("text_sha")).agg(F.min(order)["uid"].alias("first_uid"))
    ranges = write_cut(removed_ranges(rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))), "ranges")
    slot = F.pmod(F.xxhash64("uid"), F.lit(1 << 20))
    hit = _bitmap(ranges.select(slot.alias("slot")).distinct(), 1 << 20)

    def only_hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = b.column(2).to_numpy()
            yield b.filter(pa.array((hit[s >> 3] >> (s & 7) & 1).astype(bool)))

    texts = rows.select("uid", "text", slot.alias("slot")).mapInArrow(only_hit, "uid long, text string, slot long")
    per_text = ranges.groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    cut = texts.drop("slot").join(per_text, "uid").mapInArrow(_cut, "uid long, removed long, spans long, sha string")
    cut = cut.withColumnRenamed("sha", "cut_sha")
    copy = (F.col("uid") != F.col("first_uid")) & (F.col("n_bytes") >= SPAN)
    return (whole.join(first, whole["sha"] == first["text_sha"]).join(cut, "uid", "left").select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256")))
