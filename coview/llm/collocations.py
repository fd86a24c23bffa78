"""Phrases whose words belong together, the best of every language.

A phrase of 2 to 4 words is a candidate from ``LEAST`` occurrences on. Cut into
two parts it scores ``2,000,000 * a / (l + r)``, rounded down (``a``, ``l``,
``r``: occurrences of the phrase and of both parts); its lowest cut counts. A
candidate goes if a longer one holds it and is nearly as frequent.

The search grows phrases word by word, best first. A prefix ``p`` with first
word ``u`` bounds all its extensions: they occur at most f(p) times and one of
their cuts has ``u`` on the left, so none scores above
``2,000,000 * f(p) / (f(u) + f(p))``. The bound only falls as a prefix grows. A
round sets a threshold per language (the score of its ``places``-th pair of
words), expands every prefix whose bound reaches it, and counts what precedes
the candidates above it, as only one word more can show that a longer candidate
holds them. After a round every survivor at or above the threshold is known
exactly, ties included. A language with ``top`` of them is settled; the others
go on with a threshold further down, at last 0.

Counting reads the texts once per length: words become 64-bit hashes (language
included), windows are counted per task with numpy and summed by Spark on all
their word hashes. What the tasks must know (frequent words, expanded prefixes)
comes as bit filters without misses, sized from counts up to ``MOST_BITS``;
beyond that they let more windows through, and no count changes.

Cases: a null or empty text has no words; a null language is ``und``; a piece
of one word has no phrase; words of any length are one word; ties are ordered
by count, then by the bytes of the phrase; repeated rows count as often as they
stand; null ids do not matter (ids are not read); an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coview.llm import kernel as K
from coview.session import write_cut

TOP = 2000
LEAST = 30
LONGEST = 4
SCALE = 2_000_000
#: a candidate goes if a longer one that holds it has this many hundredths of its count
HOLDS = 80
#: size of a bit filter: bits for each entry, at least and at most
ENTRY_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28
#: windows that a task gathers before it counts them
GATHER = 1 << 20

_BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
_IN_WORD = np.array([b not in _BREAKS and b not in b" \t" for b in range(256)], dtype=bool)
_IS_BREAK = np.array([b in _BREAKS for b in range(256)], dtype=bool)
_CHUNK = 15  # log2 of the bits of one bitmap of Spark's


class Bits:
    """A filter over 64-bit keys: no misses, few false hits while not full."""

    def __init__(self, data: np.ndarray, size: int) -> None:
        self.data, self.size = data, size

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for shift in (0, 32):
            at = (keys >> np.uint64(shift)) & np.uint64(self.size - 1)
            out &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def bits_of(keys: DataFrame) -> Bits:
    """The filter of column ``key``; its size follows the number of rows."""
    n = keys.count()
    size = LEAST_BITS
    while size < min(n * ENTRY_BITS, MOST_BITS):
        size *= 2
    mask = F.lit(size - 1).cast("long")
    at = keys.select(F.explode(F.array(F.col("key").bitwiseAND(mask),
                                       F.shiftrightunsigned("key", 32).bitwiseAND(mask))).alias("at"))
    chunks = (at.groupBy(F.shiftright("at", _CHUNK).alias("chunk"))
              .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << _CHUNK) - 1).cast("long"))).alias("bits")))
    data = np.zeros(size >> 3, dtype=np.uint8)
    for row in chunks.collect():
        start = row["chunk"] << (_CHUNK - 3)
        part = np.frombuffer(row["bits"], dtype=np.uint8)[: len(data) - start]
        data[start: start + len(part)] = part
    return Bits(data, size)


# --- windows of a batch -----------------------------------------------------

def _words(lang: np.ndarray, block: K.Block) -> tuple[np.ndarray, np.ndarray, K.Words, np.ndarray]:
    """Word hashes of a block, words from each to the end of its piece, spans, bytes."""
    data = K.LOWER[block.data]
    words = K.find_words(data, block.offsets, _IN_WORD)
    n = len(words.starts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), words, data
    doc = words.doc_of()
    own = K.span_hash(K.prefix_hash(data), words.starts, words.ends)
    hashes = K.mix(own ^ lang[block.first + doc])
    breaks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_IS_BREAK[data], out=breaks[1:])
    ends = np.ones(n, dtype=bool)
    ends[:-1] = (doc[1:] != doc[:-1]) | (breaks[words.starts[1:]] > breaks[words.ends[:-1]])
    last = np.flatnonzero(ends)
    left = last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1
    return hashes, left, words, data


def _room(left: np.ndarray, k: int) -> np.ndarray:
    """Windows of ``k`` words: does one start at each of the ``n - k + 1`` places?"""
    return left[: max(0, len(left) - k + 1)] >= k


def _pairs(w: np.ndarray, left: np.ndarray, frequent: Bits) -> np.ndarray:
    known = frequent.has(w)
    return np.flatnonzero(_room(left, 2) & known[:-1] & known[1:]) if len(w) > 1 else np.zeros(0, int)


def _longer(w: np.ndarray, left: np.ndarray, k: int, frequent: Bits, grow: Bits, check: Bits) -> np.ndarray:
    """Windows of ``k`` words with an expanded prefix or a checked suffix, and
    nothing rarer than a candidate inside."""
    if len(w) < k:
        return np.zeros(0, int)
    inner = K.run_hash(w, k - 1)
    wanted = (grow.has(inner[:-1]) | check.has(inner[1:])) & _room(left, k)
    at = np.flatnonzero(wanted)
    two = K.run_hash(w, 2)
    for j in range(k - 1):
        at = at[frequent.has(two[at + j])]
    return at


def _exactly(w: np.ndarray, left: np.ndarray, k: int, wanted: Bits) -> np.ndarray:
    return np.flatnonzero(_room(left, k) & wanted.has(K.run_hash(w, k))) if len(w) >= k else np.zeros(0, int)


def _count(batches: Iterator[pa.RecordBatch], k: int, pick: Callable | None) -> Iterator[pa.RecordBatch]:
    """(w1..wk, n) of the picked windows; with ``pick`` None, (g, w1, n) of all words."""
    names = [*(["g"] if pick is None else []), *(f"w{j + 1}" for j in range(k)), "n"]
    held: list[list[np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held)]
        _, first, n = np.unique(columns[0], return_index=True, return_counts=True)
        values = [c[first].view(np.int64) for c in columns[1:]]
        return pa.RecordBatch.from_arrays([*map(pa.array, values), pa.array(n)], names=names)

    rows = 0
    for batch in batches:
        lang = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for block in K.text_blocks(batch.column(1)):
            w, left, words, _ = _words(lang, block)
            if pick is None:
                got = [w, lang[block.first + words.doc_of()], w]
            else:
                at = pick(w, left)
                # the hash only brings equal windows together; Spark's sum is by all words
                got = [K.run_hash(w, k)[at], *(w[at + j] for j in range(k))]
            if len(got[0]):
                held.append(got)
                rows += len(got[0])
            if rows >= GATHER:
                yield flush()
                held, rows = [], 0
    if held:
        yield flush()


def _spell(batches: Iterator[pa.RecordBatch], wanted: Bits) -> Iterator[pa.RecordBatch]:
    """(key, phrase) of the wanted windows, each once per block."""
    for batch in batches:
        lang = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for block in K.text_blocks(batch.column(1)):
            w, left, words, data = _words(lang, block)
            for k in range(2, LONGEST + 1):
                at = _exactly(w, left, k, wanted)
                if not len(at):
                    continue
                keys, first = np.unique(K.run_hash(w, k)[at], return_index=True)
                raw = data.tobytes()
                text = [b" ".join(raw[words.starts[i + j]: words.ends[i + j]] for j in range(k)).decode("utf-8", "replace")
                        for i in at[first]]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(text, pa.string())],
                                                 names=["key", "phrase"])


def _add_key(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The batch and the ``run_hash`` of its first ``k`` columns as ``key``."""
    for batch in batches:
        rows = np.stack([batch.column(j).to_numpy(zero_copy_only=False).view(np.uint64) for j in range(k)], axis=1)
        key = rows[:, 0].copy()
        for j in range(1, k):
            key = key * K._Q + rows[:, j]
        key = K.mix(key + np.uint64(k))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64))],
                                         names=[*batch.schema.names, "key"])


# --- the search -------------------------------------------------------------

def _w(first: int, last: int) -> list[str]:
    return [f"w{j}" for j in range(first, last + 1)]


def _counted(texts: DataFrame, k: int, pick: Callable, name: str) -> DataFrame:
    """(w1..wk, a, key) of the picked windows that occur ``LEAST`` times, written."""
    schema = ", ".join(f"{c} long" for c in [*_w(1, k), "n"])
    found = (texts.mapInArrow(partial(_count, k=k, pick=pick), schema).groupBy(*_w(1, k))
             .agg(F.sum("n").alias("a")).where(F.col("a") >= LEAST))
    keyed = found.mapInArrow(partial(_add_key, k=k), schema.replace(" n long", " a long, key long"))
    return write_cut(keyed, name)


def _ratio(a: str | Column, *parts: str) -> Column:
    """``SCALE * a / (sum of parts)`` rounded down, in 38 digits."""
    whole = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")
    above, below = whole(a) * F.lit(SCALE), reduce(Column.__add__, map(whole, parts))
    return F.call_function("div", above, below)


def _scored(table: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """``table`` with score, l, r of its lowest cut and ``bound`` for what it grows into."""
    options = F.array(*(F.struct(_ratio("a", x, y).alias("score"), F.lit(i).alias("cut"), F.col(x).alias("l"),
                                 F.col(y).alias("r")) for i, (x, y) in enumerate(cuts)))
    best = F.array_min(options)
    return (table.withColumn("best", best).select("*", "best.score", "best.l", "best.r").drop("best")
            .withColumn("bound", _ratio("a", "f1", "a")))


def _score2(two: DataFrame, one: DataFrame) -> DataFrame:
    first = one.select(F.col("w").alias("w1"), "g", F.col("f").alias("f1"))
    last = one.select(F.col("w").alias("w2"), F.col("f").alias("f2"))
    return _scored(two.join(first, "w1").join(last, "w2"), [("f1", "f2")])


def _score3(three: DataFrame, two: DataFrame) -> DataFrame:
    head = two.select("w1", "w2", "g", "f1", F.col("a").alias("f12"))
    tail = two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("f2").alias("f3"))
    return _scored(three.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]), [("f1", "f23"), ("f12", "f3")])


def _score4(four: DataFrame, three: DataFrame, two: DataFrame) -> DataFrame:
    """``f234`` is null where that phrase was not counted yet; the score is then
    the highest possible one, with the count of the whole phrase in its place.
    Phrases whose own prefix was not expanded are below the threshold: left out."""
    head = three.select("w1", "w2", "w3", "g", "f1", "f12", F.col("a").alias("f123"))
    tail = two.select(F.col("w1").alias("w3"), F.col("w2").alias("w4"), F.col("a").alias("f34"), F.col("f2").alias("f4"))
    rest = three.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"), F.col("a").alias("f234"))
    table = four.join(head, _w(1, 3)).join(tail, ["w3", "w4"]).join(rest, _w(2, 4), "left")
    table = table.withColumn("rest", F.coalesce("f234", "a"))
    return _scored(table, [("f1", "rest"), ("f12", "f34"), ("f123", "f4")])


def _thresholds(two: DataFrame, places: int) -> DataFrame:
    """(g, theta): the score of a language's ``places``-th pair, 0 if it has fewer."""
    best = Window.partitionBy("g").orderBy(F.col("score").desc())
    return (two.withColumn("place", F.row_number().over(best)).where(F.col("place") <= places)
            .groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("theta"))
            .select("g", F.when(F.col("n") == places, F.col("theta")).otherwise(F.lit(0).cast("long")).alias("theta")))


def _free(table: DataFrame, longer: DataFrame, k: int) -> DataFrame:
    """Rows of ``table`` that no phrase of ``longer`` holds."""
    by_head = longer.select(*_w(1, k), "a")
    by_tail = longer.select(*(F.col(f"w{j + 1}").alias(f"w{j}") for j in range(1, k + 1)), "a")
    holder = by_head.unionByName(by_tail).groupBy(*_w(1, k)).agg(F.max("a").alias("holder"))
    return (table.join(holder, _w(1, k), "left")
            .where(F.col("holder").isNull() | (F.col("holder") * 100 < F.col("a") * HOLDS)).drop("holder"))


def _merged(old: DataFrame | None, new: DataFrame, k: int) -> DataFrame:
    """Counts are exact wherever they come from; a phrase met twice stays once."""
    return new if old is None else old.unionByName(new).dropDuplicates(_w(1, k))


def mine(docs: DataFrame, top: int = TOP, lang_col: str = "lang", text_col: str = "text",
         places: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` survivors
    by score and count, descending, then by phrase. ``places`` sets the first
    threshold and thereby only how many rounds it takes."""
    places = places or top + top // 2
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    source = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("g"), F.col(text_col).cast("string").alias("text"))
    texts = source.select("g", "text")
    words = write_cut(texts.mapInArrow(partial(_count, k=1, pick=None), "g long, w1 long, n long")
                      .groupBy("g", "w1").agg(F.sum("n").alias("n")), "collocation-words")
    langs = write_cut(words.groupBy("g").agg(F.sum("n").alias("n"))
                      .join(source.select("lang", "g").distinct(), "g"), "collocation-langs")
    one = words.where(F.col("n") >= LEAST).select("g", F.col("w1").alias("w"), F.col("n").alias("f"))
    frequent1 = bits_of(one.select(F.col("w").alias("key")))
    two = write_cut(_score2(_counted(texts, 2, partial(_pairs, frequent=frequent1), "collocation-2"), one),
                    "collocation-scores-2")
    frequent2 = bits_of(two)

    three = four = survivors = None
    theta = _thresholds(two, places).withColumn("below", F.lit(SCALE + 1).cast("long"))
    settled = None
    while True:
        theta = write_cut(theta, "collocation-thresholds")
        if not theta.limit(1).count():
            break

        def reached(table: DataFrame, by: str) -> DataFrame:
            return table.join(theta, "g").where((F.col(by) >= F.col("theta")) & (F.col(by) < F.col("below"))).select("key")

        pick = partial(_longer, k=3, frequent=frequent2, grow=bits_of(reached(two, "bound")),
                       check=bits_of(reached(two, "score")))
        three = _merged(three, _counted(texts, 3, pick, "collocation-3"), 3)
        scores3 = write_cut(_score3(three, two), "collocation-scores-3")
        pick = partial(_longer, k=4, frequent=frequent2, grow=bits_of(reached(scores3, "bound")),
                       check=bits_of(reached(scores3, "score")))
        four = _merged(four, _counted(texts, 4, pick, "collocation-4"), 4)
        scores4 = write_cut(_score4(four, scores3, two), "collocation-scores-4")
        open4 = (scores4.where(F.col("f234").isNull()).join(theta, "g").where(F.col("score") >= F.col("theta"))
                 .select(*(F.col(f"w{j + 1}").alias(f"w{j}") for j in (1, 2, 3))).distinct())
        keyed = open4.mapInArrow(partial(_add_key, k=3), "w1 long, w2 long, w3 long, key long")
        missing = bits_of(keyed)
        if missing.data.any():
            pick = partial(_exactly, k=3, wanted=missing)
            three = _merged(three, _counted(texts, 3, pick, "collocation-rest"), 3)
            scores3 = write_cut(_score3(three, two), "collocation-scores-3")
            scores4 = write_cut(_score4(four, scores3, two), "collocation-scores-4")
        three = scores3.select(*_w(1, 3), "a", "key")

        def pool(table: DataFrame, k: int) -> DataFrame:
            rows = table.join(theta, "g").where(F.col("score") >= F.col("theta"))
            return rows.select("g", "key", F.lit(k).alias("words"), "a", "l", "r", "score", "theta", *_w(1, k))

        parts = [_free(pool(two, 2), three, 2), _free(pool(scores3, 3), four, 3),
                 pool(scores4.where(F.col("f234").isNotNull()), 4)]
        found = write_cut(reduce(DataFrame.unionByName, (p.select("g", "key", "words", "a", "l", "r", "score", "theta")
                                                        for p in parts)), "collocation-survivors")
        enough = found.groupBy("g").agg(F.count(F.lit(1)).alias("found"))
        state = theta.join(enough, "g", "left").withColumn("done", (F.col("theta") == 0) | (F.coalesce("found", F.lit(0)) >= top))
        state = write_cut(state, "collocation-state")
        part = found.join(state.where("done").select("g"), "g", "left_semi")
        settled = part if settled is None else settled.unionByName(part)
        places *= 4
        theta = (state.where("not done").select("g", F.col("theta").alias("below"))
                 .join(_thresholds(two, places), "g").select("g", "theta", "below"))
    if settled is None:
        number = lambda c: F.lit(0).cast("long").alias(c)
        return langs.where("false").select("lang", number("rank"), F.lit("").alias("phrase"),
                                           *map(number, ("a", "l", "r")), "n", number("score"))
    order = [F.col("score").desc(), F.col("a").desc()]
    by_lang = Window.partitionBy("g")
    best = write_cut(settled.withColumn("rank", F.rank().over(by_lang.orderBy(*order))).where(F.col("rank") <= top)
                     .drop("rank", "theta"), "collocation-best")
    spelled = (texts.mapInArrow(partial(_spell, wanted=bits_of(best.select("key"))), "key long, phrase string")
               .groupBy("key").agg(F.min("phrase").alias("phrase")))
    ranked = best.join(spelled, "key").withColumn("rank", F.row_number().over(by_lang.orderBy(*order, "phrase")))
    return (ranked.where(F.col("rank") <= top).join(langs, "g")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
