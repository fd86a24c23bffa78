"""Hierarchical Pitman-Yor language model with Gibbs-sampled seating.

A token is a lower-cased word or the end of its text. Its context is the token
before it (the end token at the start of a text), so every word has a
restaurant of what follows it. All of them share one parent restaurant over
words, whose own base is uniform over the vocabulary and one unknown word.
Cells (word, context) with their counts come from every training document of the
corpus.

Seating is sampled in sweeps. Tables of all words are reseated by the Chinese
restaurant process given the totals of the last sweep. Words are dealt to parts
by hash, so a word's cells and its parent entry are in one part. A context is a
word too: its part is the home of its restaurant, which sums the restaurant's
tables over the parts and sends the sum back to those that ask. A cell of one
guest always has one table, so its tables are summed once and sweeps carry only
the cells of two guests and more. Each sweep's tables are written, not the words
and contexts they belong to, which stay as they were. The driver sees the parent's totals, the vocabulary and the token count. Predictive
probabilities are averaged over the sweeps after the burn-in.

Texts are scanned once: a batch of documents becomes token numbers and a
dictionary of its cells; dictionaries, not tokens, meet the model. A batch gets
back counts and tables of its cells and words, small numbers, from which it
works out its probabilities. A very frequent word is one entry per batch.

Cases: a null or empty text is the end token alone; null ids train the model;
without training rows all probabilities come from the uniform base; repeated
rows are scored alike; an empty table gives no rows; other columns are not
read. Words are compared by 64-bit hashes, contexts by their first 48 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coview.llm import kernel as K
from coview.session import write_cut

DISCOUNT, STRENGTH = 0.6, 5.0          # context restaurants
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 20.0
SWEEPS, BURN_IN = 3, 1
BATCH_BYTES = 16 << 20
#: bytes of text for which there is a part, and parts of small inputs at most:
#: parts write to each other, so their number is not that of the shuffle
PART_BYTES, SMALL_PARTS = 16 << 20, 128
_END = np.uint64(0x2545F4914F6CDD1D)
#: a context is its word's hash without the last bits; words in order are contexts in order
_CUT = np.uint64(16)


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), dtype=kind)


def _pack_places(x: np.ndarray) -> bytes:
    """32-bit numbers by byte place: their high places are few values or none."""
    return zlib.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack_places(b: bytes) -> np.ndarray:
    places = np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(places.T).view("<u4").ravel()


def _pack_hashes(x: np.ndarray, width: int) -> bytes:
    """Hashes of ``width`` bytes, mostly rising, as differences by byte place."""
    step = np.diff(x, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(step.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes(), 1)


def _unpack_hashes(b: bytes, width: int) -> np.ndarray:
    places = np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(width, -1)
    step = np.zeros((places.shape[1], 8), dtype=np.uint8)
    step[:, :width] = places.T
    return np.cumsum(step.view("<u8").ravel(), dtype=np.uint64) & np.uint64((1 << 8 * width) - 1)


def _pack_rising(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=0).astype(np.uint32))


def _unpack_rising(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint32), dtype=np.int64)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def tokens(block: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end token per document, contexts, tokens per document."""
    data = K.LOWER[block.data]
    words = K.find_words(data, block.offsets, K.SPACED)
    counts = words.counts + 1
    ends = np.cumsum(counts) - 1
    inner = np.ones(int(counts.sum()), dtype=bool)
    inner[ends] = False
    word = np.full(len(inner), _END, dtype=np.uint64)
    word[inner] = K.span_hash(K.prefix_hash(data), words.starts, words.ends)
    return word, _contexts(word), counts


def _contexts(word: np.ndarray) -> np.ndarray:
    """The words before; an end token is before every first word."""
    return np.concatenate([[_END], word[:-1]]) >> _CUT


_OWN = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64())]
_BYTES = [(f"b{i}", pa.binary()) for i in range(6)]
#: rows of every step: what they are, whose, and packed columns
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("batch", pa.int64()), *_OWN, ("x", pa.int64()),
                     ("y", pa.int64()), *_BYTES])
_ROWS = ("kind int, part long, batch long, doc_id long, held_out boolean, n_tokens long, x long, y long, "
         + ", ".join(f"b{i} binary" for i in range(6)))
OWN, CELLS, MAP, STATE, SEATS, HOME, TOLD, TABLES = range(8)


def _rows(kind: int, n: int, **columns) -> pa.RecordBatch:
    """``n`` rows of a kind; columns are arrays, lists or one value for all."""
    out = []
    for f in _SCHEMA:
        v = kind if f.name == "kind" else columns.get(f.name)
        if v is None:
            out.append(pa.nulls(n, f.type))
        elif isinstance(v, pa.Array):
            out.append(v)
        elif isinstance(v, (np.ndarray, list)):
            out.append(pa.array(v, type=f.type))
        else:
            out.append(pa.array([v] * n, type=f.type))
    return pa.RecordBatch.from_arrays(out, schema=_SCHEMA)


class _Batch:
    """Tokens of some documents, flushed as token numbers and a dictionary."""

    def __init__(self, number: int, parts: int) -> None:
        self.number, self.parts = number, parts
        self.words, self.lengths, self.ids, self.held = [], [], [], []
        self.bytes = 0

    def flush(self) -> Iterator[pa.RecordBatch]:
        word = np.concatenate(self.words)
        self.words = None
        lengths, held = np.concatenate(self.lengths), np.concatenate(self.held)
        context = _contexts(word)  # every block ends with an end token, which is before the next one's first word
        key = K.mix(context)
        key += word
        key = K.mix(key)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        word, context, key = word[first], context[first], None
        order = np.lexsort((context, word))
        part = ((word[order] >> _CUT) % np.uint64(self.parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        order, part = order[by_part], part[by_part]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        number = place.astype(np.uint32)[inverse]
        inverse = first = place = None
        trained = np.bincount(number[np.repeat(~held, lengths)], minlength=len(order)).astype(np.uint32)
        word, context = word[order], context[order]
        bounds = np.searchsorted(part, np.arange(self.parts + 1))
        heads = _starts(word)
        runs = np.diff(np.append(heads, len(word))).astype(np.uint32)
        at = np.searchsorted(heads, bounds)
        used = np.flatnonzero(np.diff(bounds)).tolist()
        yield _rows(CELLS, len(used), part=used, batch=self.number,
                    b0=[_pack_hashes(word[heads[at[p]: at[p + 1]]], 8) for p in used],
                    b1=[_pack(runs[at[p]: at[p + 1]]) for p in used],
                    b2=[_pack_hashes(context[bounds[p]: bounds[p + 1]], 6) for p in used],
                    b3=[_pack(trained[bounds[p]: bounds[p + 1]]) for p in used])
        ends = np.cumsum(lengths)
        yield _rows(OWN, len(lengths), part=-1 - self.number, batch=self.number, doc_id=pa.concat_arrays(self.ids),
                    held_out=held, n_tokens=lengths.astype(np.int64),
                    b0=[_pack_places(number[a:z]) for a, z in zip((ends - lengths).tolist(), ends.tolist(), strict=True)])


def _batches(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    current = _Batch(number, parts)
    for b in batches:
        held = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for block in K.text_blocks(b.column(2)):
            word, _, counts = tokens(block)
            current.words.append(word)
            current.lengths.append(counts)
            current.ids.append(b.column(0).slice(block.first, block.n))
            current.held.append(held[block.first: block.first + block.n])
            current.bytes += len(block.data)
            if current.bytes >= BATCH_BYTES:
                yield from current.flush()
                number += 1
                current = _Batch(number, parts)
    if current.words:
        yield from current.flush()


def _dealt(part: int, kind: int, keys: np.ndarray, values: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rising contexts and a number each, as one row for each home."""
    home = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    bounds = np.searchsorted(home[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(bounds)).tolist()
    cut = [order[bounds[p]: bounds[p + 1]] for p in used]
    return _rows(kind, len(used), part=used, x=part, b0=[_pack_hashes(keys[c], 6) for c in cut],
                 b1=[_pack(values[c].astype(np.uint32)) for c in cut])


def _assemble(table: pa.Table, parts: int) -> pa.Table:
    """One part's cells from all batches; a batch's own rows as they are.

    ``MAP`` rows say which cell and which word each entry of a batch is (and how
    many entries a word has), the
    ``CELLS`` row holds the counts of the cells, ``STATE`` the cells of two
    guests and more, each at one table, ``SEATS`` the tables of the others
    by context, ``HOME`` the words.
    """
    part = table["part"][0].as_py()
    if part < 0:
        return table
    batch = table["batch"].to_pylist()
    heads = [_unpack_hashes(b, 8) for b in table["b0"].to_pylist()]
    word = np.concatenate([np.repeat(h, _unpack(r, np.uint32)) for h, r in zip(heads, table["b1"].to_pylist(), strict=True)])
    context = [_unpack_hashes(b, 6) for b in table["b2"].to_pylist()]
    sizes = [len(c) for c in context]
    context = np.concatenate(context)
    count = np.concatenate([_unpack(b, np.uint32) for b in table["b3"].to_pylist()]).astype(np.int64)
    order = np.lexsort((context, word))
    word, context, count = word[order], context[order], count[order]
    at = _starts(word, context)
    cell = np.empty(len(order), dtype=np.int64)
    cell[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
    word, context, count = word[at], context[at], np.add.reduceat(count, at)
    first = _starts(word)
    runs = np.diff(np.append(first, len(word)))
    head = np.repeat(np.arange(len(first)), runs)
    words = word[first]
    cells = np.split(cell, np.cumsum(sizes)[:-1])
    out = [_rows(MAP, len(batch), part=part, batch=batch, b0=[_pack_rising(c) for c in cells],
                 b1=[_pack_rising(np.searchsorted(words, h)) for h in heads], b2=table["b1"].to_pylist())]
    total = np.add.reduceat(count, first)
    out.append(_rows(CELLS, 1, part=part, x=int((total > 0).sum()), y=int(count.sum()),
                     b0=[_pack(count.astype(np.uint32))], b1=[_pack(runs.astype(np.uint32))]))
    one, more = count == 1, count > 1
    fixed = np.bincount(head[one], minlength=len(words))
    state = State(part, head[more], context[more], count[more], np.ones(int(more.sum()), dtype=np.int64), fixed,
                  np.minimum(total, 1))
    out.append(state.row(STATE))
    out.append(_dealt(part, SEATS, *np.unique(context[one], return_counts=True), parts))
    out.append(_rows(HOME, 1, part=part, b0=[_pack_hashes(words, 8)]))
    return pa.Table.from_batches(out)


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating ``customers`` guests of one dish, one after another:
    with k seated at t tables the next opens a table with probability
    ``opening / (opening + k - discount t)``. Beyond 64 guests they are seated
    in growing groups with the chances at the middle of the group."""
    tables = np.minimum(customers, 1).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    k = 1
    while len(live):
        step = 1 if k < 64 else k // 8
        here = np.minimum(step, customers[live] - k)
        chance = opening[live] / (opening[live] + k + (here - 1) / 2 - discount * tables[live])
        tables[live] += rng.binomial(here, np.clip(chance, 0, 1))
        k += step
        live = live[customers[live] > k]
    return tables


class State:
    """One part's seating: cells of two guests and more with their tables, per
    word the tables of its other cells and of the word in the parent."""

    def __init__(self, part, word, context, count, tables, fixed, parent_tables) -> None:
        self.part, self.word, self.context, self.count = part, word, context, count
        self.tables, self.fixed, self.parent_tables = tables, fixed, parent_tables

    @staticmethod
    def of(rows: list[dict]) -> State:
        """From the part's first ``STATE`` row and, if it has been reseated, its
        ``TABLES`` row, which holds only what a sweep changes."""
        long = lambda b: _unpack(b, np.uint32).astype(np.int64)
        own = next(r for r in rows if r["kind"] == STATE)
        now = next((r for r in rows if r["kind"] == TABLES), own)
        return State(own["part"], _unpack_rising(own["b0"]), own["b1"] and _unpack_hashes(own["b1"], 6),
                     *map(long, (own["b2"], now["b3"], own["b4"], now["b5"])))

    def parents(self) -> np.ndarray:
        """Guests of each word in the parent restaurant."""
        return self.fixed + np.bincount(self.word, weights=self.tables, minlength=len(self.fixed)).astype(np.int64)

    def row(self, kind: int) -> pa.RecordBatch:
        """The whole state, or (``TABLES``) its tables alone."""
        small = [_pack(x.astype(np.uint32)) for x in (self.count, self.tables, self.fixed, self.parent_tables)]
        columns = {"b0": [_pack_rising(self.word)], "b1": [_pack_hashes(self.context, 6)], "b2": [small[0]],
                   "b4": [small[2]]} if kind == STATE else {}
        return _rows(kind, 1, part=self.part, x=int(self.parents().sum()), y=int(self.parent_tables.sum()),
                     b3=[small[1]], b5=[small[3]], **columns)

    def shared(self, totals: dict) -> np.ndarray:
        """The parent's probability of each of the part's words."""
        return _shared(self.parents(), self.parent_tables, totals)

    def sweep(self, number: int, totals: dict, tables: np.ndarray) -> None:
        """Reseats all cells, given the tables of each cell's restaurant."""
        rng = np.random.default_rng([20240229, number, self.part])
        mass = STRENGTH + DISCOUNT * tables
        self.tables = seat(self.count, mass * self.shared(totals)[self.word], DISCOUNT, rng)
        parents = self.parents()
        self.parent_tables = seat(parents, np.full(len(parents), _new_mass(totals)), PARENT_DISCOUNT, rng)


def _shared(parents: np.ndarray, parent_tables: np.ndarray, totals: dict) -> np.ndarray:
    return (parents - PARENT_DISCOUNT * parent_tables + _new_mass(totals)) / (PARENT_STRENGTH + totals["parents"])


def _new_mass(totals: dict) -> float:
    return (PARENT_STRENGTH + PARENT_DISCOUNT * totals["parent_tables"]) * totals["base"]


def _seats(state: pa.Table, parts: int) -> pa.Table:
    """The tables of a part's cells, summed by context, for their homes."""
    s = State.of(state.to_pylist())
    keys, place = np.unique(s.context, return_inverse=True)
    return pa.Table.from_batches([_dealt(s.part, SEATS, keys, np.bincount(place, weights=s.tables, minlength=len(keys)), parts)])


def _at_home(home: pa.Table, seats: pa.Table, words_too: bool) -> pa.Table:
    """The tables of each restaurant of a home: all of them in the ``HOME`` row,
    and a ``TOLD`` row for each part that sent some, in the order it sent them."""
    if not home.num_rows:
        return _SCHEMA.empty_table()
    own = home.to_pylist()[0]
    words = _unpack_hashes(own["b0"], 8)
    total = _unpack(own["b1"], np.uint32).astype(np.int64) if own["b1"] else np.zeros(len(words), dtype=np.int64)
    sent = [(r["x"], np.searchsorted(words >> _CUT, _unpack_hashes(r["b0"], 6)), _unpack(r["b1"], np.uint32))
            for r in seats.to_pylist()]
    total = total.copy()
    for _, at, tables in sent:
        total[at] += tables
    out = [_rows(HOME, 1, part=own["part"], b0=[own["b0"] if words_too else None], b1=[_pack(total.astype(np.uint32))]),
           _rows(TOLD, len(sent), part=[p for p, _, _ in sent], x=own["part"],
                 b0=[_pack(total[at].astype(np.uint32)) for _, at, _ in sent])]
    return pa.Table.from_batches(out)


def _reseat(state: pa.Table, told: pa.Table, number: int, totals: dict, parts: int) -> pa.Table:
    s = State.of(state.to_pylist())
    keys, place = np.unique(s.context, return_inverse=True)
    home = (keys % np.uint64(parts)).astype(np.int64)
    tables = np.zeros(len(keys), dtype=np.int64)
    for r in told.to_pylist():
        tables[home == r["x"]] = _unpack(r["b0"], np.uint32)
    s.sweep(number, totals, tables[place])
    return pa.Table.from_batches([s.row(TABLES)])


def _answer(asked: pa.Table, samples: pa.Table) -> pa.Table:
    """For every entry of a batch: guests and tables of its cells; guests of its
    words, their guests and tables in the parent and the tables of their
    restaurants. ``samples`` has the ``STATE`` row, and a ``TABLES`` and a
    ``HOME`` row of each sample with its number in ``batch``."""
    if not asked.num_rows:
        return _SCHEMA.empty_table()
    rows, states = asked.to_pylist(), samples.to_pylist()
    own = next(r for r in rows if r["kind"] == CELLS)
    start = next(r for r in states if r["kind"] == STATE)
    count, runs = (_unpack(own[c], np.uint32) for c in ("b0", "b1"))
    more = np.flatnonzero(count > 1)
    total = np.add.reduceat(count.astype(np.int64), np.cumsum(runs, dtype=np.int64) - runs)
    parents, seats, tables = [], [], []
    for r in sorted((r for r in states if r["kind"] != STATE), key=lambda r: r["batch"]):
        if r["kind"] == HOME:
            seats.append(_unpack(r["b1"], np.uint32))
            continue
        s = State.of([start, r])
        parents += [s.parents().astype(np.uint32), s.parent_tables.astype(np.uint32)]
        here = np.minimum(count, 1)
        here[more] = s.tables
        tables.append(here)
    out = []
    for r in rows:
        if r["kind"] != MAP:
            continue
        cell, word = _unpack_rising(r["b0"]), _unpack_rising(r["b1"])
        out.append(_rows(MAP, 1, part=r["part"], batch=r["batch"], b0=[_pack_places(count[cell])],
                         b1=[_pack_places(np.concatenate([t[cell] for t in tables]))], b2=[_pack(total[word])],
                         b3=[_pack_places(np.concatenate([x[word] for x in parents]))],
                         b4=[_pack_places(np.concatenate([x[word] for x in seats]))],
                         b5=[r["b2"]]))
    return pa.Table.from_batches(out, schema=_SCHEMA)


def _score(docs: pa.Table, answers: pa.Table, n: int, vocabulary: int, totals: list[dict]) -> pa.Table:
    """``totals``: those of each sample."""
    answers = answers.sort_by("part")
    samples = len(totals)

    def column(name: str, read, by: int = 1) -> np.ndarray:
        return np.concatenate([read(b).reshape(by, -1) for b in answers[name].to_pylist()], axis=1)

    count, tables = column("b0", _unpack_places)[0], column("b1", _unpack_places, samples)
    guests = column("b2", partial(_unpack, kind=np.int64))[0]
    parents, seats = column("b3", _unpack_places, 2 * samples).astype(np.int64), column("b4", _unpack_places, samples)
    shares = [_shared(parents[2 * s], parents[2 * s + 1], t) for s, t in enumerate(totals)]
    word = np.repeat(np.arange(len(guests)), column("b5", partial(_unpack, kind=np.uint32))[0])
    base = np.log10((guests + 0.1) / (n + 0.1 * (vocabulary + 1)))
    score, base_score, known = [], [], []
    for packed in docs["b0"].to_pylist():
        number = _unpack_places(packed)
        here = word[number]
        before = np.roll(here, 1)  # the end token, the last, is before the first
        chance = np.zeros(len(number))
        for s in range(samples):
            stay = count[number] - DISCOUNT * tables[s][number]
            chance += (stay + (STRENGTH + DISCOUNT * seats[s][before]) * shares[s][here]) / (STRENGTH + guests[before])
        score.append(float(np.log10(chance / samples).sum()))
        base_score.append(float(base[here].sum()))
        known.append(int((guests[here] > 0).sum()))
    return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": docs["n_tokens"],
                     "n_known": pa.array(known, pa.int64()),
                     "train_tokens": pa.array([n] * docs.num_rows, pa.int64()),
                     "base_score": pa.array(base_score, pa.float64()), "score": pa.array(score, pa.float64())})


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 10, is 0 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def part_count(size: int, partitions: int) -> int:
    """Parts for ``size`` bytes of text and this many shuffle partitions."""
    return max(min(4 * partitions, SMALL_PARTS), -(-size // PART_BYTES))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS,
          burn_in: int = BURN_IN, parts: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (log10 probability) of every row. Perplexity is ``10 ** (-score / n_tokens)``."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                         F.col(text_col).cast("string").alias("text"))
    if parts is None:
        size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = part_count(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = write_cut(source.mapInArrow(K.ends(partial(_batches, parts=parts)), _ROWS).groupBy("part").applyInArrow(
        K.group_ends(partial(_assemble, parts=parts)), _ROWS), "lm-cells")
    kind = F.col("kind")
    n, vocabulary = (int(v or 0) for v in rows.where(kind == CELLS).agg(F.sum("y"), F.sum("x")).first())

    def totals(tables: DataFrame) -> dict:
        parents, parent_tables = (int(v or 0) for v in tables.agg(F.sum("x"), F.sum("y")).first())
        return {"parents": parents, "parent_tables": parent_tables, "base": 1.0 / (vocabulary + 1)}

    def at_home(home: DataFrame, seats: DataFrame, words_too: bool = False) -> DataFrame:
        return write_cut(home.groupBy("part").cogroup(seats.groupBy("part")).applyInArrow(
            K.group_ends(partial(_at_home, words_too=words_too), 2), _ROWS), "lm-homes")

    def seated(state: DataFrame) -> DataFrame:
        return at_home(homes, state.groupBy("part").applyInArrow(K.group_ends(partial(_seats, parts=parts)), _ROWS))

    homes = at_home(rows.where(kind == HOME), rows.where(kind == SEATS), True).where(kind == HOME)
    start = rows.where(kind == STATE)
    state, held = start, seated(start)
    history, samples = [totals(start)], None
    for number in range(sweeps):
        tables = write_cut(state.groupBy("part").cogroup(held.where(kind == TOLD).groupBy("part")).applyInArrow(
            K.group_ends(partial(_reseat, number=number, totals=history[-1], parts=parts), 2), _ROWS), "lm-tables")
        state = start.unionByName(tables)
        held = seated(state)
        history.append(totals(tables))
        if number >= burn_in:
            both = tables.unionByName(held.where(kind == HOME)).withColumn("batch", F.lit(number + 1).cast("long"))
            samples = both if samples is None else samples.unionByName(both)
    # without the contexts, which the answers do not need
    samples = samples.unionByName(start.withColumn("b1", F.lit(None).cast("binary")))
    asked = rows.where(kind.isin(CELLS, MAP))
    answers = asked.groupBy("part").cogroup(samples.groupBy("part")).applyInArrow(K.group_ends(_answer, 2), _ROWS)
    return rows.where(kind == OWN).groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        K.group_ends(partial(_score, n=n, vocabulary=vocabulary, totals=history[burn_in + 1:]), 2),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
