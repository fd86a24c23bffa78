"""Vectorised text helpers for Arrow batches inside Spark tasks.

Texts are handled as one UTF-8 byte buffer per block of documents. A block
holds at most ``BLOCK_BYTES`` bytes (or one longer text), so the numpy
temporaries of a task stay bounded whatever the batch holds.

Words are maximal runs of word bytes. Both word rules of this package separate
on ASCII characters only, so working on UTF-8 bytes gives the same words as
working on characters. Hashes are 64-bit: a polynomial hash per word, mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = np.uint64(0xD6E8FEB86659FD93)


def _byte_table(word: callable) -> np.ndarray:
    return np.array([word(b) for b in range(256)], dtype=bool)


#: ``[^\x20\x09-\x0D]+``
SPACED = _byte_table(lambda b: b != 0x20 and not 9 <= b <= 13)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = _byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: lower-cases A-Z and leaves every other byte alone
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            m = max(n + 1, BLOCK_BYTES + 1)
            steps = np.full(m, _P, dtype=np.uint64)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = _P_INV
            self.down = np.multiply.accumulate(steps)
        return self.up, self.down


_POWERS = _Powers()


def give_back() -> None:
    """Memory that ended work has freed goes back to the system. A Python worker
    outlives its task, and waits beside those that work; Arrow's pool and the C
    library would keep what the largest batch took."""
    _POWERS.__init__()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def _ended(batches: Iterator[pa.RecordBatch], step: Callable) -> Iterator[pa.RecordBatch]:
    try:
        yield from step(batches)
    finally:
        give_back()


def ends(step: Callable) -> Callable:
    """``step``, a function for ``mapInArrow``, whose task gives back its memory."""
    return partial(_ended, step=step)


# without type hints: Spark fails on those of a partial function
def _group_ended(table, *, step):
    try:
        return step(table)
    finally:
        give_back()


def _groups_ended(left, right, *, step):
    try:
        return step(left, right)
    finally:
        give_back()


def group_ends(step: Callable, sides: int = 1) -> Callable:
    """The same for ``applyInArrow`` on groups (or, with two sides, cogroups)."""
    return partial(_group_ended if sides == 1 else _groups_ended, step=step)



def prefix_hash(data: np.ndarray) -> np.ndarray:
    """``c`` with ``c[e] - c[s]`` the (shifted) polynomial of ``data[s:e]``."""
    up, _ = _POWERS.get(len(data))
    c = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=c[1:])
    return c


def span_hash(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]`` from its ``prefix_hash``."""
    _, down = _POWERS.get(len(c))
    return mix((c[ends] - c[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def run_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values of ``h``, in order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= _Q
        out += h[j: j + n]
    return mix(out + np.uint64(k))


@dataclass
class Block:
    """Consecutive documents ``first..first+n-1`` of a batch as one buffer."""

    first: int
    data: np.ndarray     # bytes, not lower-cased
    offsets: np.ndarray  # n + 1 byte offsets into data

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Split a string column into blocks; null texts become empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offs = np.frombuffer(buffers[1], dtype=np.int64)[column.offset: column.offset + n + 1]
    data = (np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None
            else np.zeros(0, dtype=np.uint8))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield Block(i, data[offs[i]: offs[j]], offs[i: j + 1] - offs[i])
        i = j


@dataclass
class Words:
    """Words of a block: byte spans, and where each document's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # n + 1 word offsets

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc) - 1), self.counts)


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Maximal runs of bytes in ``table`` that do not cross documents."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1: n + 1] = table[data]
    begin = inside[1: n + 1] & ~inside[:n]
    stop = np.zeros(n + 1, dtype=bool)
    stop[:] = inside[: n + 1] & ~inside[1: n + 2]
    edge = offsets[1:-1]
    edge = edge[edge < n]
    begin[edge] = inside[edge + 1]
    stop[edge] = inside[edge]
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(stop), np.searchsorted(starts, offsets))


def windows(words: Words, k: int) -> np.ndarray:
    """Start words of all runs of ``k`` words inside one document."""
    counts = words.counts
    left = np.repeat(words.doc[1:], counts) - np.arange(len(words.starts))
    return np.flatnonzero(left >= k)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start+1, ...`` (``length`` of them) for each pair, joined."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def covered(lengths: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags for positions ``0..lengths-1`` that lie in any ``[start, end)``."""
    step = np.zeros(int(lengths) + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
