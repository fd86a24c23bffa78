"""LDA by EM over blocks of documents.

The edges (doc, term, n) of some documents are one block, packed: per document
its terms as numbers of the block's own vocabulary, and their counts. Terms are
dealt to parts by hash. A round sends, for each term of a block and not for each
edge, the block's topic sums to the term's part, and the sums over all blocks
back. Shares of an edge follow from the sums of its term and of its document, so
they are never written. A task holds one block or one part.

Cases: edges of a null document count in the start only; without edges there
are no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coview.session import write_cut

#: edges of a block, block entries of a part, and edges worked on at a time
BLOCK_EDGES, PART_TERMS, HELD_EDGES = 1 << 23, 1 << 20, 1 << 20
#: slots that edges are packed by before the number of blocks is known
SLOTS = 1024

_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int64()), ("x", pa.int64()),
                     *((f"b{i}", pa.binary()) for i in range(4))])
_ROWS = "kind int, block long, part long, x long, b0 binary, b1 binary, b2 binary, b3 binary"
EDGES, DOCS, SENT, TERMS, PLACES, TOLD = range(6)


def _pack(x: np.ndarray) -> bytes:
    """An array by byte place."""
    return zlib.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    places = np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(places.T).view(kind).ravel()


def _pack_terms(terms: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("t", pa.large_string())])) as out:
        out.write_batch(pa.record_batch([terms.cast(pa.large_string())], names=["t"]))
    return zlib.compress(sink.getvalue().to_pybytes(), 1)


def _unpack_terms(b: bytes) -> pa.Array:
    return pa.ipc.open_stream(zlib.decompress(b)).read_all()["t"].combine_chunks()


def _numbered(parts: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The distinct terms of some arrays, and the number of each entry."""
    found = pa.concat_arrays(parts).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _rows(*rows: dict) -> pa.Table:
    return pa.Table.from_pylist([{f.name: r.get(f.name) for f in _SCHEMA} for r in rows], schema=_SCHEMA)


def _slotted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed edges by slot: columns slot, doc, term, n in; EDGES rows with the slot as block out."""
    held, size = [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).sort_by([("slot", "ascending"), ("doc", "ascending")])
        slot = table["slot"].to_numpy()
        cuts = np.append(np.flatnonzero(np.diff(slot, prepend=slot[0] - 1)), len(slot))
        known = pc.is_valid(table["doc"]).to_numpy().astype(np.uint8)
        doc = pc.fill_null(table["doc"], 0).to_numpy()
        n, term = table["n"].to_numpy(), table["term"].combine_chunks()
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield from _rows({"kind": EDGES, "block": int(slot[a]), "x": z - a,
                              "b0": _pack(np.diff(doc[a:z], prepend=0)), "b1": _pack_terms(term.slice(a, z - a)),
                              "b2": _pack(n[a:z].astype(np.uint32)), "b3": _pack(known[a:z])}).to_batches()

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 2 * HELD_EDGES:
            yield from rows()
            held, size = [], 0
    if size:
        yield from rows()


def _sums(shares, term: np.ndarray, doc: np.ndarray, n: np.ndarray, terms: int, docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Topic sums of terms and documents; ``shares(a, z)`` gives those of edges ``a..z``."""
    w, d = np.zeros((k, terms)), np.zeros((k, docs))
    for a in range(0, len(term), HELD_EDGES):
        z = min(a + HELD_EDGES, len(term))
        for t, p in enumerate(shares(a, z)):
            p = p * n[a:z]
            w[t] += np.bincount(term[a:z], weights=p, minlength=terms)
            d[t] += np.bincount(doc[a:z], weights=p, minlength=docs)
    return w, d


def _assemble(table: pa.Table, blocks: int, parts: int, k: int) -> pa.Table:
    """One block from its packed edges: the block, its documents' sums and its
    terms, with their sums, for the parts."""
    block = table["block"][0].as_py() % blocks
    column = lambda c, kind: np.concatenate([_unpack(b, kind) for b in table[c].to_pylist()])
    doc = np.concatenate([np.cumsum(_unpack(b, np.int64)) for b in table["b0"].to_pylist()])
    vocabulary, term = _numbered([_unpack_terms(b) for b in table["b1"].to_pylist()])
    n, known = column("b2", np.uint32), column("b3", np.uint8).astype(bool)
    home = np.array([zlib.crc32(t.encode()) % parts for t in vocabulary.to_pylist()], dtype=np.int64)
    order = np.argsort(home, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    vocabulary, home, term = vocabulary.take(pa.array(order)), home[order], place[term]
    length = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    lost_term, lost_n = term[~known], n[~known]
    doc, term, n = doc[known], term[known], n[known]
    order = np.lexsort((term, doc))
    doc, term, n = doc[order], term[order], n[order]
    first = np.flatnonzero(np.diff(doc, prepend=doc[0] - 1)) if len(doc) else np.zeros(0, dtype=np.int64)
    held = np.diff(np.append(first, len(doc)))
    row = np.repeat(np.arange(len(first)), held)
    rest = 0.4 / max(k - 1, 1)

    def start(a: int, z: int) -> Iterator[np.ndarray]:
        own = np.mod(doc[a:z] + length[term[a:z]], k)
        return (np.where(own == t, 0.6 if k > 1 else 1.0, rest) for t in range(k))

    w, d = _sums(start, term, row, n, len(home), len(first), k)
    w += rest * np.bincount(lost_term, weights=lost_n, minlength=len(home))
    live = np.bincount(term, minlength=len(home)) > 0
    step = np.diff(term, prepend=0)
    step[first] = term[first]
    bounds = np.searchsorted(home, np.arange(parts + 1)).tolist()
    out = [{"kind": EDGES, "block": block, "part": -1 - block, "x": len(term), "b0": _pack(step.astype(np.uint32)),
            "b1": _pack(n), "b2": _pack(held.astype(np.uint32))},
           {"kind": DOCS, "block": block, "part": -1 - block, "b0": _pack(d.ravel())}]
    out += [{"kind": SENT, "block": block, "part": p, "b0": _pack_terms(vocabulary.slice(a, z - a)),
             "b1": _pack(w[:, a:z].ravel()), "b2": _pack(live[a:z])}
            for p, (a, z) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if z > a]
    return _rows(*out)


def _round(table: pa.Table, k: int, alpha: float, eta: float, total: list[float], terms: int) -> pa.Table:
    """A block's new sums from those of its documents and terms."""
    rows = table.to_pylist()
    edges = next(r for r in rows if r["kind"] == EDGES)
    block = edges["block"]
    told = sorted((r for r in rows if r["kind"] == TOLD), key=lambda r: r["part"])
    held = _unpack(edges["b2"], np.uint32).astype(np.int64)
    first = np.cumsum(held) - held
    step, n = _unpack(edges["b0"], np.uint32).astype(np.int64), _unpack(edges["b1"], np.uint32)
    term = np.cumsum(step)
    term -= np.repeat(term[first] - step[first], held)
    row = np.repeat(np.arange(len(held)), held)
    d = _unpack(next(r for r in rows if r["kind"] == DOCS)["b0"], np.float64).reshape(k, -1)
    w = [_unpack(r["b0"], np.float64).reshape(k, -1) for r in told]
    sizes = [x.shape[1] for x in w]
    w = np.concatenate(w, axis=1)

    def shares(a: int, z: int) -> list[np.ndarray]:
        raw = [(w[t][term[a:z]] + eta) * (d[t][row[a:z]] + alpha) / (total[t] + terms * eta) for t in range(k)]
        whole = raw[0]
        for r in raw[1:]:
            whole = whole + r
        return [r / whole for r in raw]

    w, d = _sums(shares, term, row, n, w.shape[1], len(held), k)
    ends = np.cumsum(sizes).tolist()
    return _rows({"kind": DOCS, "block": block, "part": -1 - block, "b0": _pack(d.ravel())},
                 *({"kind": SENT, "block": block, "part": r["part"], "b1": _pack(w[:, z - m: z].ravel())}
                   for r, m, z in zip(told, sizes, ends, strict=True)))


def _first_meeting(table: pa.Table, k: int) -> pa.Table:
    """One part's terms from all blocks, where each block's entries stand among
    them, and the sums told to each block. A block's own rows pass."""
    if table["part"][0].as_py() < 0:
        return table
    rows = table.to_pylist()
    sent = [_unpack_terms(r["b0"]) for r in rows]
    vocabulary, at = _numbered(sent)
    places = np.split(at, np.cumsum([len(s) for s in sent])[:-1])
    live = np.bincount(at, weights=np.concatenate([_unpack(r["b2"], np.bool_) for r in rows]), minlength=len(vocabulary)) > 0
    w = _totals(rows, places, len(vocabulary), k)
    part = rows[0]["part"]
    return _rows({"kind": TERMS, "part": part, "x": len(live), "b0": _pack(w.ravel()), "b1": _pack_terms(vocabulary),
                  "b2": _pack(live)},
                 *({"kind": PLACES, "part": part, "block": r["block"], "b0": _pack(at.astype(np.uint32))}
                   for r, at in zip(rows, places, strict=True)),
                 *_told(part, rows, places, w))


def _meeting(table: pa.Table, k: int) -> pa.Table:
    """``_first_meeting`` with places and vocabulary at hand."""
    if table["part"][0].as_py() < 0:
        return table
    rows = table.to_pylist()
    own = next(r for r in rows if r["kind"] == TERMS)
    where = {r["block"]: _unpack(r["b0"], np.uint32) for r in rows if r["kind"] == PLACES}
    sent = [r for r in rows if r["kind"] == SENT]
    places = [where[r["block"]] for r in sent]
    live = _unpack(own["b2"], np.bool_)
    w = _totals(sent, places, len(live), k)
    return _rows({"kind": TERMS, "part": own["part"], "x": int(live.sum()), "b0": _pack(w.ravel())},
                 *_told(own["part"], sent, places, w))


def _totals(rows: list[dict], places: list[np.ndarray], terms: int, k: int) -> np.ndarray:
    w = np.zeros((k, terms))
    for r, at in sorted(zip(rows, places, strict=True), key=lambda x: x[0]["block"]):
        w[:, at] += _unpack(r["b1"], np.float64).reshape(k, -1)
    return w


def _told(part: int, rows: list[dict], places: list[np.ndarray], w: np.ndarray) -> Iterator[dict]:
    for r, at in zip(rows, places, strict=True):
        yield {"kind": TOLD, "part": part, "block": r["block"], "b0": _pack(w[:, at].ravel())}


def _sum_rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Topic sums and terms of each part."""
    for b in batches:
        for x, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_pydict({"terms": [x], "w": pa.array([_unpack(w, np.float64).reshape(k, -1).sum(axis=1).tolist()])})


def _weights(table: pa.Table, k: int, total: list[float], all_terms: bool) -> pa.Table:
    """A part's (topic, term, weight)."""
    rows = table.to_pylist()
    first = next(r for r in rows if r["b1"] is not None)
    last = max(rows, key=lambda r: r["block"])
    keep = np.ones(first["x"], dtype=bool) if all_terms else _unpack(first["b2"], np.bool_)
    w = _unpack(last["b0"], np.float64).reshape(k, -1)[:, keep]
    terms = _unpack_terms(first["b1"]).cast(pa.string()).filter(pa.array(keep))
    return pa.concat_tables([pa.table({"topic": pa.array(np.full(len(terms), t, dtype=np.int32)), "term": terms,
                                       "weight": w[t] / (total[t] or 1.0)}) for t in range(k)])


def lda_topics(counts: DataFrame, k: int = 3, rounds: int = 3, doc_weight: float | None = None,
               term_weight: float = 1.1, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(topic, term, weight): the full topic-term matrix of LDA fitted by EM.

    ``counts`` has (doc, term, n). Only the k topic totals and the number of
    terms go to the driver; the vocabulary is of any size. ``doc_weight`` and
    ``term_weight`` are the usual smoothing parameters (50 / k + 1 and 1.1).
    The start gives 0.6 of an edge to topic ``(doc + length(term)) mod k``.
    """
    spark = counts.sparkSession
    alpha = (50.0 / k + 1.0 if doc_weight is None else doc_weight) - 1.0
    eta = term_weight - 1.0
    slots = max(SLOTS, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    slot = F.pmod(F.when(F.col("doc").isNull(), F.xxhash64("term")).otherwise(F.xxhash64("doc")), F.lit(slots))
    packed = write_cut(counts.where("term IS NOT NULL").select(
        slot.alias("slot"), F.col("doc").cast("long").alias("doc"), "term", F.col("n").cast("long").alias("n"))
        .mapInArrow(_slotted, _ROWS), "lda_counts")
    edges = packed.agg(F.sum("x")).first()[0] or 0
    blocks = min(slots, max(1, -(-edges // block_edges)))
    parts = max(1, min(4 * blocks, 64), -(-edges // (8 * PART_TERMS)))
    kind = F.col("kind")
    made = packed.groupBy((F.col("block") % blocks).alias("of")).applyInArrow(
        lambda t: _assemble(t, blocks, parts, k), _ROWS)
    now = base = write_cut(made.groupBy("part").applyInArrow(lambda t: _first_meeting(t, k), _ROWS), "lda_terms")
    # neither the vocabularies nor the first sums
    at_parts = (base.where(kind.isin(TERMS, PLACES)).withColumn("b0", F.when(kind == PLACES, F.col("b0")))
                .withColumn("b1", F.lit(None).cast("binary")))
    step = lambda total, terms: lambda t: _round(t, k, alpha, eta, total, terms)
    for turn in range(rounds + 1):
        found = now.where(kind == TERMS).select("x", "b0").mapInArrow(partial(_sum_rows, k=k), "terms long, w array<double>")
        sums = found.agg(F.sum("terms"), *[F.sum(F.col("w")[t]) for t in range(k)]).first()
        terms, total = sums[0] or 0, [v or 0.0 for v in sums[1:]]
        if turn == rounds:
            break
        # one row of edges a block; its documents and what it was told are the last round's
        own = now.where(kind.isin(DOCS, TOLD)).unionByName(base.where(kind == EDGES))
        sent = own.groupBy("block").applyInArrow(step(total, terms), _ROWS)
        now = write_cut(sent.unionByName(at_parts).groupBy("part").applyInArrow(lambda t: _meeting(t, k), _ROWS), "lda_terms")
    last = now.where(kind == TERMS).withColumn("block", F.lit(1).cast("long")).withColumn("b1", F.lit(None).cast("binary"))
    first = base.where(kind == TERMS).withColumn("block", F.lit(0).cast("long"))
    return last.unionByName(first).groupBy("part").applyInArrow(
        lambda t: _weights(t, k, total, not rounds), "topic int, term string, weight double")
