"""N-gram Jaccard join: components of documents with similar shingle sets.

The document by n-gram incidence matrix is kept as rows (shingle, document),
dealt to blocks by the shingle's hash. Only the columns that a link needs are
multiplied: a set of n shingles that links at 75 % shares a shingle among the
first n - ceil(0.75 n) + 1 of each partner in one global order, so each
document enters with that many columns (its size-derived bound). The order puts
frequent shingles last (a table of fixed size, counted over all documents, says
which hash slots are frequent), then goes by hash; so a passage that many
documents share is no column of theirs unless they hold little else.

Documents with equal sets are one row from the start. A column of a few rows is
multiplied as a whole block; a longer one would be quadratic, so it is multiplied
with one leader row, another one each round. Overlap counts are accumulated for
each pair, and pairs below bounds derived from their sizes are discarded. What
remains is verified on the whole sets. Linked documents are contracted, and
columns that lie inside one component leave the matrix. From the second round on
columns of at most ``BLOCK_ROWS`` rows are whole blocks (at most that many
products a row), after which they leave too. Rounds follow until one adds no
link, ``LEADER_ROUNDS`` at most. They only contract: what they find is checked,
what they miss is left to the last pass. That pass takes all columns of the first
round that still span components and meets every two rows of different
components, long columns in pairs of blocks of ``LONG_ROWS`` rows. Its rows carry
a fixed-size sketch of their set, whose distance is at most that of the sets, and
name the row's smallest columns of the pass; only pairs near enough to be linked
leave the task that met them. A pair meets in each column of both and is returned
from the smallest that both name only, so that the rows of the pass are the pairs
near a link and not these times their columns. Where the lists name no column of
both, each of its columns returns the pair: no link is lost. Pairs with fewer shared
columns than a link has are discarded then. The comparisons in a task grow with the
square of the components in a column.

Cases: a null text, or one without words, has no shingles and links with
nothing; a text of fewer words than ``k`` has its whole sequence as its only
shingle; rows that share an id are one node; a null id links with
nothing and has a null component; an empty table gives no rows; other columns are not read. Shingles are compared
by 64-bit hashes, sets by 128-bit digests.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.llm import kernel as K
from coview.session import write_cut

WORDS, PERCENT = 5, 75
#: slots of the id filter that goes to all tasks: 128 KB, whatever the input
FILTER_SLOTS = 1 << 20
#: columns of at most so many rows are multiplied as a whole block: in the
#: first round, in later ones
FIRST_BLOCK_ROWS, BLOCK_ROWS = 8, 64
#: hash slots of the frequency table: 1 MB, whatever the input; slots of a row
#: of it on the way
RANK_SLOTS, RANK_ROW = 1 << 20, 1 << 14
#: rounds that contract before the last pass
LEADER_ROUNDS = 6
#: rows of a block of a long column in the last pass, and pairs held at a time
LONG_ROWS, HELD_PAIRS = 4096, 1 << 19
#: slots of a set's sketch, half a byte each, and pairs whose sketches a task compares at a time
SKETCH_SLOTS, HELD_SKETCHES = 128, 1 << 15
#: columns that a row of the last pass names, 4 bytes each, and pairs whose names a task compares at a time
LIST_COLUMNS, HELD_LISTS = 8, 1 << 14
#: rows of one column that a task holds at a time
HELD_ROWS = 1 << 20
#: bytes of text whose shingles a task holds at a time
TEXT_BYTES = 1 << 18


def shingle_sets(block: K.Block, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, flat, and their counts."""
    data = K.LOWER[block.data]
    words = K.find_words(data, block.offsets, K.SPACED)
    h = K.span_hash(K.prefix_hash(data), words.starts, words.ends)
    at = K.windows(words, k)
    doc, value = words.doc_of()[at], K.run_hash(h, k)[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        own = [K.run_hash(h[words.doc[d]: words.doc[d + 1]], int(words.counts[d]))[0] for d in short.tolist()]
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(own, dtype=np.uint64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[first], np.bincount(doc[first], minlength=block.n)


def _segment_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _digests(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, a, b = [], [], []
        for block in K.text_blocks(batch.column(1), TEXT_BYTES):
            values, counts = shingle_sets(block, k)
            n.append(counts)
            a.append(_segment_sum(K.mix(values), counts))
            b.append(_segment_sum(K.mix(values ^ np.uint64(0x5851F42D4C957F2D)), counts))
        if n:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(n).astype(np.int64)),
                 *(pa.array(np.concatenate(x).view(np.int64)) for x in (a, b))], names=["doc_id", "n", "a", "b"])


def _frequent(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """How many shingles of a task's documents fall into each hash slot."""
    total = np.zeros(RANK_SLOTS, dtype=np.uint32)
    for batch in batches:
        for block in K.text_blocks(batch.column(0), TEXT_BYTES):
            values, _ = shingle_sets(block, k)
            slot, held = np.unique(values & np.uint64(RANK_SLOTS - 1), return_counts=True)
            total[slot.astype(np.int64)] += held.astype(np.uint32)
    rows = [r for r in range(RANK_SLOTS // RANK_ROW) if total[r * RANK_ROW: (r + 1) * RANK_ROW].any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array([_packed(total[r * RANK_ROW: (r + 1) * RANK_ROW]) for r in rows], pa.binary())],
        names=["row", "held"])


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(RANK_ROW, dtype=np.uint64)
    for b in table["held"]:
        total += _unpacked(b.as_py())
    return pa.table({"row": table["row"][:1], "held": pa.array([_packed(total)], pa.binary())})


def frequent_from(mean: float) -> float:
    """Shingles from which a slot is frequent: the number of rare ones that meet in
    a slot spreads with the square root of its mean, so what stands out does not
    grow in step with the input."""
    return max(8.0, min(4 * mean, mean + 8 * mean ** 0.5))


def frequency_ranks(source: DataFrame, k: int) -> np.ndarray:
    """Per hash slot 0, or the power of two of its count over all documents if it
    is frequent among the slots."""
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("held", T.BinaryType())])
    rows = source.select("text").mapInArrow(K.ends(partial(_frequent, k=k)), schema).groupBy("row").applyInArrow(_summed, schema)
    total = np.zeros(RANK_SLOTS, dtype=np.int64)
    for r in rows.collect():
        total[r["row"] * RANK_ROW: (r["row"] + 1) * RANK_ROW] = _unpacked(bytes(r["held"])).astype(np.int64)
    ranks = np.zeros(RANK_SLOTS, dtype=np.uint8)
    often = np.flatnonzero(total >= frequent_from(total.mean()))
    ranks[often] = np.frexp(total[often].astype(np.float64))[1]
    return ranks


def _columns(batches: Iterator[pa.RecordBatch], k: int, percent: int, ids: np.ndarray | None,
             ranks: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Per document its leading columns, or (with an id filter) its whole set."""
    for batch in batches:
        if ids is not None:
            slot = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((ids[slot >> 3] >> (slot & 7) & 1).astype(bool)))
        for block in K.text_blocks(batch.column(1), TEXT_BYTES):
            values, counts = shingle_sets(block, k)
            length = counts
            if ids is None:
                rank = ranks[(values & np.uint64(RANK_SLOTS - 1)).astype(np.int64)]
                values = values[np.lexsort((values, rank, np.repeat(np.arange(block.n), counts)))]
                length = np.where(counts > 0, counts - -(-percent * counts // 100) + 1, 0)
            at = K.ragged(np.cumsum(counts) - counts, length)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, block.n), pa.array(counts.astype(np.int64)),
                 K.list_array(values[at].view(np.int64), length, pa.int64())], names=["doc_id", "n", "shingles"])


def _sketches(batches: Iterator[pa.RecordBatch], k: int, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document in the id filter how many shingles it has in each slot, modulo 16."""
    for batch in batches:
        slot = batch.column(2).to_numpy()
        batch = batch.filter(pa.array((ids[slot >> 3] >> (slot & 7) & 1).astype(bool)))
        for block in K.text_blocks(batch.column(1), TEXT_BYTES):
            values, counts = shingle_sets(block, k)
            sketch = pa.array(list(sketches(values, counts)), type=pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, block.n), pa.array(counts.astype(np.int64)), sketch],
                names=["doc_id", "n", "sketch"])


def sketches(values: np.ndarray, counts: np.ndarray) -> Iterator[bytes]:
    """One for each set of ``shingle_sets``."""
    at = np.repeat(np.arange(len(counts)), counts) * SKETCH_SLOTS + (K.mix(values) % np.uint64(SKETCH_SLOTS)).astype(np.int64)
    held = np.bincount(at, minlength=len(counts) * SKETCH_SLOTS).astype(np.uint8).reshape(-1, SKETCH_SLOTS)
    held &= 15
    return (row.tobytes() for row in held[:, ::2] | held[:, 1::2] << 4)


def _near(x: np.ndarray, y: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of sketches (rows of ``x`` and ``y``) that differ no more than those of
    linked sets whose sizes sum to ``total``. A shingle of one set only moves one
    slot by one, so sketches differ in no more than the sets do."""
    apart = np.zeros(len(x), dtype=np.int64)
    for a, b in ((x & 15, y & 15), (x >> 4, y >> 4)):
        a -= b
        apart += np.minimum(a & 15, -a & 15).sum(axis=1, dtype=np.int64)  # modulo 16
    return apart <= total + 2 * (-percent * total // (100 + percent))


def _product(cells: np.ndarray, lead: np.ndarray | None, percent: int, block: int,
             last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y, nx, ny, overlap) of some columns, and the cells that stay.

    ``cells`` has rows shingle, doc_id, n, comp, sorted by shingle, the leader of
    each column first; ``lead`` is the leader of a first column whose beginning
    has been multiplied before.
    """
    if lead is not None:
        cells = np.concatenate([lead[:, None], cells], axis=1)
    shingle, doc, n, comp = cells
    starts = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    held = np.diff(np.append(starts, len(shingle)))
    spans = np.minimum.reduceat(comp, starts) < np.maximum.reduceat(comp, starts)
    whole = held <= block
    if lead is not None:
        spans[0], whole[0] = True, False
    stays = np.repeat(spans & ~(whole & last), held)
    if lead is not None:
        stays[0] = False
    column = np.repeat(np.arange(len(starts)), held)
    x, y = [np.flatnonzero(spans[column] & ~whole[column])], []
    y.append(starts[column[x[0]]])
    inside = np.flatnonzero(spans[column] & whole[column])
    for step in range(1, block):
        inside = inside[inside + step < len(column)]
        inside = inside[column[inside] == column[inside + step]]
        if not len(inside):
            break
        x.append(inside + step)
        y.append(inside)
    x, y = np.concatenate(x), np.concatenate(y)
    low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
    ok = (comp[x] != comp[y]) & (low * 100 >= high * percent)
    x, y = x[ok], y[ok]
    swap = doc[x] > doc[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    order = np.lexsort((doc[y], doc[x]))
    x, y = x[order], y[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[x][1:] != doc[x][:-1]) | (doc[y][1:] != doc[y][:-1])])[: len(x)])
    overlap = np.diff(np.append(new, len(x)))
    return np.stack([doc[x[new]], doc[y[new]], n[x[new]], n[y[new]], overlap]), cells[:3, stays]


def _all_pairs(cells: np.ndarray, sketch: np.ndarray, length: np.ndarray, flat: np.ndarray,
               percent: int) -> Iterator[np.ndarray]:
    """Pairs (a, b, na, nb) of the rows of different components in some columns
    whose sketches are near, those of ``_here`` only. ``cells`` has rows key, doc_id,
    n, comp, side, col, ``sketch`` a row for each of their columns, ``flat`` the lists
    of columns with their ``length``; rows of one side (0 or 1) do not meet, as their
    block is multiplied by itself elsewhere."""
    order = np.lexsort((cells[3], cells[0]))
    cells, sketch = cells[:, order], sketch[order]
    start, length = (np.cumsum(length) - length)[order], length[order]
    key, doc, n, comp, side, col = cells
    m = len(key)
    column = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    run = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (comp[1:] != comp[:-1])]))
    column_end = np.repeat(np.append(column[1:], m), np.diff(np.append(column, m)))
    run_end = np.repeat(np.append(run[1:], m), np.diff(np.append(run, m)))
    partners = column_end - run_end
    rows = np.flatnonzero(partners > 0)
    done = np.cumsum(partners[rows])
    first = 0
    while first < len(rows):
        past = max(first + 1, int(np.searchsorted(done, (done[first - 1] if first else 0) + HELD_PAIRS, side="right")))
        some = rows[first:past]
        first = past
        x, y = np.repeat(some, partners[some]), K.ragged(run_end[some], partners[some])
        low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
        ok = (low * 100 >= high * percent) & ((side[x] < 0) | (side[x] != side[y]))
        x, y = x[ok], y[ok]
        near = [_near(sketch[x[i: i + HELD_SKETCHES]], sketch[y[i: i + HELD_SKETCHES]],
                      n[x[i: i + HELD_SKETCHES]] + n[y[i: i + HELD_SKETCHES]], percent)
                for i in range(0, len(x), HELD_SKETCHES)]
        if not near or not (near := np.concatenate(near)).any():
            continue
        x, y = x[near], y[near]
        here = np.concatenate([_here(x[i: i + HELD_LISTS], y[i: i + HELD_LISTS], col, flat, start, length)
                               for i in range(0, len(x), HELD_LISTS)])
        if not here.any():
            continue
        x, y = x[here], y[here]
        swap = doc[x] > doc[y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        order = np.lexsort((n[y], n[x], doc[y], doc[x]))
        pair = np.stack([doc[x], doc[y], n[x], n[y]])[:, order]
        new = np.concatenate([[True], (pair[:, 1:] != pair[:, :-1]).any(axis=0)])
        yield pair[:, new]


def _here(x: np.ndarray, y: np.ndarray, col: np.ndarray, flat: np.ndarray, start: np.ndarray,
          length: np.ndarray) -> np.ndarray:
    """Which pairs of rows are returned from this column: those whose lists name no
    smaller column of both. A pair is returned from the smallest column that both
    name; if they name none, from each of theirs."""
    m = len(x)
    pair = np.concatenate([np.repeat(np.arange(m), length[x]), np.repeat(np.arange(m), length[y])])
    named = np.concatenate([flat[K.ragged(start[x], length[x])], flat[K.ragged(start[y], length[y])]])
    named = (pair << 32) + (named.astype(np.int64) + (1 << 31))
    named.sort()
    both = named[1:][named[1:] == named[:-1]]
    of = both >> 32
    return np.bincount(of[(both & 0xFFFFFFFF) - (1 << 31) < col[x][of]], minlength=m) == 0


def _exhaust(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """``_all_pairs`` over a stream of cells sorted by key, with their sketches and
    (if the stream has them) their columns and the smallest open columns of their rows."""
    held, sketch = np.zeros((6, 0), dtype=np.int64), np.zeros((0, SKETCH_SLOTS // 2), dtype=np.uint8)
    length, flat = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def rows(cut: int) -> Iterator[pa.RecordBatch]:
        for pairs in _all_pairs(held[:, :cut], sketch[:cut], length[:cut], flat, percent):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], names=["a", "b", "na", "nb"])

    for batch in batches:
        if not batch.num_rows:
            continue
        none = np.zeros(batch.num_rows, dtype=np.int64)
        known = batch.num_columns > 6
        more = [c.to_numpy() for c in batch.columns[:5]] + [batch.column(6).to_numpy() if known else none]
        held = np.concatenate([held, np.stack(more)], axis=1)
        more = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=np.uint8)
        sketch = np.concatenate([sketch, more.reshape(-1, SKETCH_SLOTS // 2)])
        length = np.concatenate([length, batch.column(7).value_lengths().to_numpy() if known else none])
        if known:
            flat = np.concatenate([flat, batch.column(7).flatten().to_numpy()])
        if held.shape[1] < HELD_ROWS // 8:
            continue
        cut = int(np.searchsorted(held[0], held[0, -1]))
        if cut:
            yield from rows(cut)
            flat = flat[length[:cut].sum():].copy()
            held, sketch, length = held[:, cut:].copy(), sketch[cut:].copy(), length[cut:]
    if held.shape[1]:
        yield from rows(held.shape[1])


def spanning(cells: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Cells with their component, of the columns that span components."""
    if comp is not None:
        cells = cells.join(comp, "doc_id", "left").select("shingle", "doc_id", "n", F.coalesce("comp", "doc_id").alias("comp"))
    else:
        cells = cells.select("shingle", "doc_id", "n", F.col("doc_id").alias("comp"))
    open_ = cells.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return cells.join(open_.select("shingle"), "shingle", "left_semi")


def open_columns(cells: DataFrame) -> DataFrame:
    """(doc_id, n, comp, cols) of the rows of ``cells``: their columns as 32-bit
    hashes in order. Columns of one hash are one column; that only adds to what meets."""
    return cells.groupBy("doc_id", "n").agg(F.min("comp").alias("comp"), F.sort_array(F.collect_set(F.hash("shingle"))).alias("cols"))


def last_pass(rows: DataFrame, lengths: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) of different components whose sketches are near, with at
    least the number of shared leading columns that a link of their sizes has.
    ``rows`` are those of ``open_columns``, ``sketch`` has (doc_id, n, sketch) of
    their documents, ``lengths`` (shingle, held) of the columns of more than
    ``LONG_ROWS`` rows."""
    blocks = (lengths.groupBy(F.hash("shingle").alias("col"))
              .agg(F.ceil(F.sum("held") / LONG_ROWS).cast("int").alias("blocks")))
    cells = (rows.join(sketch, ["doc_id", "n"])
             .select("doc_id", "n", "comp", "sketch", F.slice("cols", 1, LIST_COLUMNS).alias("cols"), F.explode("cols").alias("col"))
             .join(F.broadcast(blocks), "col", "left"))
    own = F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)")
    cells = cells.withColumn("own", own).withColumn("other", F.explode(
        F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(-1)))))
    alone = F.col("blocks").isNull() | (F.col("blocks") < 2)
    cells = cells.select(
        F.when(alone, F.col("col").cast("long")).otherwise(F.xxhash64("col", F.least("own", "other"), F.greatest("own", "other"))).alias("key"),
        "doc_id", "n", "comp",
        F.when(alone | (F.col("own") == F.col("other")), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).cast("long").alias("side"),
        "sketch", F.col("col").cast("long").alias("col"), "cols")
    fields = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "na", "nb")])
    pairs = cells.repartition("key").sortWithinPartitions("key").mapInArrow(K.ends(partial(_exhaust, percent=percent)), fields)
    # sets x >= y that link share o = p (x + y) / (100 + p) shingles at least. Of
    # the one whose leading columns end first all but ceil(p x / 100) - 1 lead, and
    # what it shares of these leads in the other too
    need = F.expr(f"ceil({percent} * (na + nb) / {100 + percent}) - ceil({percent} * greatest(na, nb) / 100) + 1")
    left = rows.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("cols").alias("ca"))
    right = rows.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("cols").alias("cb"))
    return (pairs.distinct().join(left, ["a", "na"]).join(right, ["b", "nb"])
            .where(F.size(F.array_intersect("ca", "cb")) >= need).select("a", "b", "na", "nb"))


def _multiply(batches: Iterator[pa.RecordBatch], percent: int, block: int, last: bool,
              long_rows: int = LONG_ROWS) -> Iterator[pa.RecordBatch]:
    """``_product`` over a sorted stream of cells; holds whole columns up to ``HELD_ROWS``."""
    names = ["a", "b", "na", "nb", "overlap"]
    held, lead = np.zeros((4, 0), dtype=np.int64), None

    def rows(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        pairs, stay = _product(cells, lead, percent, block, last)
        start = np.flatnonzero(np.concatenate([[True], cells[0, 1:] != cells[0, :-1]]))
        length = np.diff(np.append(start, cells.shape[1]))
        long = length > long_rows
        if long.any():  # their lengths, for the last pass
            none = np.zeros(int(long.sum()), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cells[0, start[long]], length[long], none, none, none - 1)], names=names)
        for part in (pairs, np.concatenate([stay, np.zeros((2, stay.shape[1]), dtype=np.int64)])):
            if part.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in part], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        if held.shape[1] < HELD_ROWS // 8:
            continue
        cut = int(np.searchsorted(held[0], held[0, -1]))
        if cut:
            yield from rows(held[:, :cut])
            held, lead = held[:, cut:].copy(), None
        elif held.shape[1] >= HELD_ROWS:
            yield from rows(held)
            lead, held = (held[:, 0].copy() if lead is None else lead), np.zeros((4, 0), dtype=np.int64)
    if held.shape[1]:
        yield from rows(held)


def _needed(ids: DataFrame) -> np.ndarray:
    """A bitmap of the ids' hash slots: a filter of fixed size without misses."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_SLOTS))
    rows = (ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", 15).alias("part"))
            .agg(F.expr("bitmap_construct_agg(slot & 32767)").alias("bits")).collect())
    out = np.zeros((FILTER_SLOTS >> 15, 4096), dtype=np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out.reshape(-1)


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, comp) for every id in ``edges`` (a, b): comp is the least id reachable."""
    both = write_cut(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = write_cut(both.groupBy(F.col("a").alias("doc_id"))
                       .agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        heard = (both.join(labels, both["b"] == labels["doc_id"]).groupBy(F.col("a").alias("doc_id"))
                 .agg(F.min("comp").alias("heard")))
        jump = labels.select(F.col("doc_id").alias("comp"), F.col("comp").alias("root"))
        new = write_cut(labels.join(heard, "doc_id").join(jump, "comp").select(
            "doc_id", F.least("heard", "root").alias("comp"), F.col("comp").alias("was")), "labels")
        if new.where("comp <> was").isEmpty():
            return new.select("doc_id", "comp")
        labels = new.select("doc_id", "comp")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
         percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (verified links to leaders
    of the document's set) for every row; ids are integers."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    long = lambda *names: [T.StructField(c, T.LongType()) for c in names]
    digests = write_cut(source.mapInArrow(K.ends(partial(_digests, k=k)), T.StructType(long("doc_id", "n", "a", "b"))), "digests")
    # equal sets are one row of the matrix, named by their least id
    sets = digests.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "a", "b").agg(F.min("doc_id").alias("rep"))
    reps = sets.select(F.col("rep").alias("doc_id"), "n").distinct()
    fields = T.StructType([*long("doc_id", "n"), T.StructField("shingles", T.ArrayType(T.LongType()))])
    columns = source.mapInArrow(K.ends(partial(_columns, k=k, percent=percent, ids=None, ranks=frequency_ranks(source, k))), fields)
    cells = (columns.join(reps, ["doc_id", "n"], "left_semi")
             .select(F.explode("shingles").alias("shingle"), "doc_id", "n"))
    hashed = source.where("doc_id IS NOT NULL").withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_SLOTS)))

    def verified(pairs: DataFrame) -> DataFrame:
        slots = _needed(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")))
        whole = hashed.mapInArrow(K.ends(partial(_columns, k=k, percent=percent, ids=slots, ranks=None)), fields)
        left = whole.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
        right = whole.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        new = (pairs.join(left, ["a", "na"]).join(right, ["b", "nb"]).select("a", "b", both.alias("i"), (F.col("na") + F.col("nb")).alias("t"))
               .where(F.col("i") * 100 >= (F.col("t") - F.col("i")) * percent))
        return write_cut(new.select("a", "b").distinct(), "links")

    links = None
    comp = None
    for turn in range(LEADER_ROUNDS):
        if comp is not None:
            cells = cells.join(comp, "doc_id", "left").select("shingle", "doc_id", "n", F.coalesce("comp", "doc_id").alias("comp"))
        else:
            cells = cells.select("shingle", "doc_id", "n", F.col("doc_id").alias("comp"))
        dealt = cells.repartition("shingle").sortWithinPartitions("shingle", F.xxhash64("doc_id", F.lit(turn)), "doc_id")
        product = write_cut(dealt.mapInArrow(
            K.ends(partial(_multiply, percent=percent, block=BLOCK_ROWS if turn else FIRST_BLOCK_ROWS, last=turn > 0, long_rows=LONG_ROWS)),
            T.StructType(long("a", "b", "na", "nb", "overlap"))), "product")
        cells = product.where("overlap = 0").select(F.col("a").alias("shingle"), F.col("b").alias("doc_id"), F.col("na").alias("n"))
        if not turn:  # every column of two documents or more
            every, lengths = cells, product.where("overlap = -1").select(F.col("a").alias("shingle"), F.col("b").alias("held"))
        # linked sets of sizes x >= y share at least o = p (x + y) / (100 + p)
        # shingles, so o - ceil(p x / 100) + 1 columns; a leader holds part of
        # these, so a quarter is asked for; the last pass finds what this drops
        need = F.expr(f"(ceil({percent} * (na + nb) / {100 + percent}) - ceil({percent} * greatest(na, nb) / 100) + 1) / 4")
        pairs = write_cut(product.where("overlap > 0").groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
                          .where(F.col("overlap") >= need).select("a", "b", "na", "nb"), "pairs")
        new = verified(pairs)
        if not new.isEmpty():
            links = new if links is None else links.union(new)
            comp = components(links)
        elif turn:
            break
    open_ = write_cut(open_columns(spanning(every, comp)), "open")
    sketch = hashed.mapInArrow(K.ends(partial(_sketches, k=k, ids=_needed(open_))), T.StructType(
        [*long("doc_id", "n"), T.StructField("sketch", T.BinaryType())])).distinct()
    new = verified(write_cut(last_pass(open_, lengths, sketch, percent), "pairs"))
    if not new.isEmpty():
        links = new if links is None else links.union(new)
        comp = components(links)
    out = (digests.join(sets, ["n", "a", "b"], "left")
           .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")))
    if links is None:
        return out.select("doc_id", "n_shingles", F.col("rep").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    degree = (links.select(F.col("a").alias("rep")).union(links.select("b"))
              .groupBy("rep").agg(F.count("*").alias("n_links")))
    return (out.join(comp.withColumnRenamed("doc_id", "rep"), "rep", "left").join(degree, "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("comp", "rep").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))
