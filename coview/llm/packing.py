"""Packing by Karmarkar-Karp multiway differencing.

Documents are tokenised, cut into pieces of at most ``cut`` tokens, and the
pieces of a block are dealt to windows by the largest differencing method: the
two partial partitions with the largest spread are merged, the fullest windows
of one with the emptiest of the other, until one partition is left. The number
of windows starts at the least possible and rises while the fullest window is
over capacity.

Blocks are made inside map tasks from the rows as they come (bounded memory, no
shuffle, no key that could be hot), so a lost task is simply run again. Each
block is closed when it holds ``block_windows`` windows; only the last block of
a task is smaller.

Cases: a null or empty text is a document with only the end id; repeated rows
are documents of their own; a very long text is spread over as many windows as
it needs; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.llm import kernel as K

WINDOW = 2048
END_ID = 1
#: bytes of text that a task tokenises at a time
TEXT_BYTES = 1 << 18


def _piece_class(b: int) -> int:
    """0 white space, 1 letters, 2 digits, 3 punctuation, 4 needs its whole chunk."""
    if b == 0x20 or 9 <= b <= 13:
        return 0
    if 48 <= b <= 57:
        return 2
    if 65 <= b <= 90 or 97 <= b <= 122 or 0x80 <= b <= 0xBF or 0xC3 <= b <= 0xC9:
        return 1
    if b < 32 or b >= 127 or b in b"'<":
        return 4
    return 3


_CLASS = np.array([_piece_class(b) for b in range(256)], dtype=np.uint8)
#: two-byte characters below U+0280 that are not plain letters: multiplication
#: and division signs, and the dotted capital I (its lower case is two characters)
_NOT_LETTERS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))


class WordTokenizer:
    """Token ids of whole texts, from cached ids of their words.

    For tokenizers that split at white space, into letter runs, single digits
    and punctuation runs, and that lower-case (``word_bpe_49k.json``). Texts are
    cut by the same rule where it is plain; a white-space chunk with anything
    else (apostrophes, ``<``, control characters, characters from U+0280 on)
    goes through the tokenizer as a whole, so ids equal those of whole texts.
    The cache is emptied when it holds ``max_cached`` entries.
    """

    def __init__(self, path: str, max_cached: int = 600_000) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.max_cached = max_cached
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._clear()

    def forget(self) -> None:
        """Drop the cached words: what follows in this worker needs the memory."""
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.array([x for g in got for x in g], dtype=np.uint32)
        return flat, np.fromiter(map(len, got), dtype=np.int64, count=len(got))

    def _encode_plain(self, texts: list[str], group: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """Each text is one pre-token, whose last id carries the word end."""
        joined = [" ".join(texts[i: i + group]) for i in range(0, len(texts), group)]
        flat, _ = self._encode_each(joined)
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        if len(ends) != len(texts):
            return self._encode_each(texts)
        return flat, np.diff(ends, prepend=0)

    def _learn(self, hashes: list[int], texts: list[str], plain: bool) -> None:
        if not texts:
            return
        flat, length = (self._encode_plain if plain else self._encode_each)(texts)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used: self.used + len(flat)] = flat
        n = len(self.start)
        self.known.update(zip(hashes, range(n, n + len(texts)), strict=True))
        self.start = np.concatenate([self.start, self.used + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.used += len(flat)

    @staticmethod
    def _pieces(block: K.Block) -> tuple[np.ndarray, K.Words, np.ndarray]:
        """The bytes to encode, the pieces, and which of them are whole chunks."""
        raw = block.data
        data, kind = K.LOWER[raw], _CLASS[raw]
        odd = kind == 4
        for lead, second in _NOT_LETTERS:
            at = np.flatnonzero(raw[:-1] == lead)
            odd[at[raw[at + 1] == second]] = True
        if odd.any():
            chunks = K.find_words(raw, block.offsets, K.SPACED)
            hit = np.unique(np.searchsorted(chunks.starts, np.flatnonzero(odd), side="right") - 1)
            inside = K.ragged(chunks.starts[hit], (chunks.ends - chunks.starts)[hit])
            kind[inside] = 4
            data[inside] = raw[inside]
        begin = np.ones(len(raw), dtype=bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begin[block.offsets[:-1][block.offsets[:-1] < len(raw)]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(raw))
        used = kind[starts] != 0
        starts, ends = starts[used], ends[used]
        return data, K.Words(starts, ends, np.searchsorted(starts, block.offsets)), kind[starts] == 4

    def encode(self, block: K.Block, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a block's documents and each document's id count."""
        data, words, whole = self._pieces(block)
        hashes = K.span_hash(K.prefix_hash(data), words.starts, words.ends)
        hashes ^= whole.astype(np.uint64)  # a whole chunk never shares a piece's entry
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > self.max_cached:
            self._clear()
        keys = unique.tolist()
        missing = [i for i, k in enumerate(keys) if k not in self.known]
        if missing:
            raw = data.tobytes()
            at = first[missing]
            texts = [raw[s:e].decode("utf-8") for s, e in
                     zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]
            for plain in (True, False):
                pick = np.flatnonzero(whole[at] != plain).tolist()
                self._learn([keys[missing[i]] for i in pick], [texts[i] for i in pick], plain)
        row = np.fromiter((self.known[k] for k in keys), dtype=np.int64, count=len(keys))[inverse]
        lengths = self.length[row]
        before = np.concatenate([[0], np.cumsum(lengths)])[words.doc]
        counts = np.diff(before)
        flat = self.ids[K.ragged(self.start[row], lengths)]
        if end_id is None:
            return flat, counts
        out = np.full(len(flat) + block.n, end_id, dtype=np.uint32)
        out[np.arange(len(flat)) + np.repeat(np.arange(block.n), counts)] = flat
        return out, counts + 1


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_for(path: str) -> WordTokenizer:
    """One tokenizer per Python worker, kept from task to task; its cached words
    are not (see ``_pack``)."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def differencing(sizes: np.ndarray, m: int) -> tuple[np.ndarray, int]:
    """Karmarkar-Karp: a window ``0..m-1`` for each size, and the fullest sum."""
    n = len(sizes)
    left, right = [np.zeros(n + 1, dtype=np.int64)], [np.zeros(n + 1, dtype=np.int64)]
    nodes = n + 1  # node 0 is empty, 1..n are the pieces
    heap, partials = [], {}
    for i, size in enumerate(sizes.tolist()):
        sums, node = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64)
        sums[0], node[0] = size, i + 1
        partials[i] = (sums, node)
        heap.append((-size if m > 1 else 0, i))
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sums_a, node_a), (sums_b, node_b) = partials.pop(a), partials.pop(b)
        sums, other = sums_a + sums_b[::-1], node_b[::-1]
        both = (node_a > 0) & (other > 0)
        node = node_a + other  # one of them is 0 unless both are set
        k = int(both.sum())
        left.append(node_a[both])
        right.append(other[both])
        node[both] = np.arange(nodes, nodes + k)
        nodes += k
        order = np.argsort(-sums, kind="stable")
        sums, node = sums[order], node[order]
        partials[serial] = (sums, node)
        heapq.heappush(heap, (int(sums[-1] - sums[0]), serial))
        serial += 1
    sums, node = partials[heap[0][1]]
    lefts, rights = np.concatenate(left).tolist(), np.concatenate(right).tolist()
    window = [0] * nodes
    for w, x in enumerate(node.tolist()):
        window[x] = w
    for x in range(nodes - 1, n, -1):
        window[lefts[x]] = window[rights[x]] = window[x]
    return np.array(window[1: n + 1], dtype=np.int64), int(sums[0])


def deal(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows for sizes no larger than ``capacity``; their count rises until
    the fullest one fits."""
    m = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window, fullest = differencing(sizes, m)
        if fullest <= capacity:
            return window
        m += 1


class _Pool:
    """Pieces of one task that wait for their block."""

    def __init__(self, window: int, cut: int, block_windows: int, base: int) -> None:
        self.window, self.cut, self.base = window, cut, base
        self.least = block_windows * window
        self.sequence = 0
        self._reset()

    def _reset(self) -> None:
        self.parts, self.waiting = [], 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Cut documents into whole windows and shorter pieces of the rest."""
        per = np.where(counts % self.window, -(-(counts % self.window) // self.cut), 0)
        n_whole = counts // self.window
        k = n_whole + per
        doc = np.repeat(np.arange(len(counts)), k)
        j = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
        start = (np.minimum(j, n_whole[doc]) * self.window
                 + np.maximum(j - n_whole[doc], 0) * self.cut)
        limit = np.where(j < n_whole[doc], self.window, self.cut)
        length = np.minimum(limit, counts[doc] - start)
        at = (np.cumsum(counts) - counts)[doc] + start
        # close blocks after the piece that fills them
        total = self.waiting + np.cumsum(length)
        a = 0
        while a < len(doc):
            z = min(len(doc), int(np.searchsorted(total, self.least)) + 1)
            self.parts.append((doc_ids.take(pa.array(doc[a:z])), start[a:z], length[a:z],
                               counts[doc[a:z]], [ids[x: x + y] for x, y in
                                                  zip(at[a:z].tolist(), length[a:z].tolist(), strict=True)]))
            self.waiting = int(total[z - 1])
            if self.waiting >= self.least:
                total -= self.waiting
                yield self.flush()
            a = z

    def flush(self) -> pa.RecordBatch:
        doc_ids = pa.concat_arrays([p[0] for p in self.parts])
        start, sizes, tokens = (np.concatenate([p[i] for p in self.parts]) for i in (1, 2, 3))
        ids = [x for p in self.parts for x in p[4]]
        whole = sizes == self.window
        window = np.zeros(len(sizes), dtype=np.int64)
        n_whole = int(whole.sum())
        window[whole] = np.arange(n_whole)
        if n_whole < len(sizes):
            window[~whole] = n_whole + deal(sizes[~whole], self.window)
        order = np.argsort(window, kind="stable")
        window, sizes = window[order], sizes[order]
        before = np.cumsum(sizes) - sizes
        out = pa.RecordBatch.from_arrays([
            doc_ids.take(pa.array(order)), pa.array(start[order]), pa.array(sizes),
            pa.array(tokens[order]), pa.array(self.base + self.sequence + window),
            pa.array(before - before[np.searchsorted(window, window)]),
            pa.array([ids[i].astype("<u4").tobytes() for i in order.tolist()], type=pa.binary()),
        ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        self.sequence += int(window[-1]) + 1
        self._reset()
        return out


def _pack(batches: Iterator[pa.RecordBatch], path: str, window: int, cut: int, end_id: int | None,
          block_windows: int) -> Iterator[pa.RecordBatch]:
    tokenizer = tokenizer_for(path)
    pool = None
    try:
        for batch in batches:
            if pool is None:
                pool = _Pool(window, cut, block_windows, TaskContext.get().partitionId() << 32)
            for block in K.text_blocks(batch.column(1), TEXT_BYTES):
                ids, counts = tokenizer.encode(block, end_id)
                yield from pool.add(batch.column(0).slice(block.first, block.n), ids, counts)
        if pool is not None and pool.parts:
            yield pool.flush()
    finally:
        tokenizer.forget()


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, cut: int = 512, end_id: int | None = END_ID,
         block_windows: int = 192) -> DataFrame:
    """Packed pieces: doc_id, start, length, doc_tokens, sequence_id, offset and
    ``ids`` (the piece's ids as little-endian unsigned 32-bit integers).

    ``tokenizer_path`` names a tokenizer file that every executor can open.
    ``cut`` is the longest piece of a document's last, partial window.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", source.schema["doc_id"].dataType),
        *(T.StructField(c, T.LongType()) for c in
          ("start", "length", "doc_tokens", "sequence_id", "offset")),
        T.StructField("ids", T.BinaryType())])
    return source.mapInArrow(K.ends(partial(_pack, path=tokenizer_path, window=window, cut=cut,
                                            end_id=end_id, block_windows=block_windows)), schema)
