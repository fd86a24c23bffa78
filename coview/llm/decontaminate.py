"""Benchmark decontamination by hashed n-gram windows of the test items.

Every run of ``n`` normalised words of a benchmark item is a window (an item of
fewer words is one window). Their hashes go to all tasks; each task scans the
word windows of whole training texts, checks every hash hit word by word, and
marks the words inside any occurrence.

The window table is broadcast only while the items hold at most
``slice_bytes`` bytes of text. A larger benchmark is dealt into slices of that
size, and the documents pass through one slice after another, so the memory of
a task never depends on the benchmark's size.

Cases: a null or empty text has no words and no hits; items with a null text
or no words have no windows; items with a null id hit words but are not listed;
repeated items or documents are treated row by row, ids are listed once; empty
tables give empty results or no hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coview.llm import kernel as K

WINDOW_WORDS = 10
SLICE_BYTES = 8 << 20


def _item_windows(items: list[tuple[str | None, str]], n: int) -> dict[int, dict]:
    """``length -> {hash: [(joined words, item id), ...]}``."""
    out: dict[int, dict] = {}
    column = pa.array([t for _, t in items], type=pa.string())
    for block in K.text_blocks(column):
        data = K.LOWER[block.data]
        words = K.find_words(data, block.offsets, K.ALNUM)
        hashes = K.span_hash(K.prefix_hash(data), words.starts, words.ends)
        raw = data.tobytes()
        spans = list(zip(words.starts.tolist(), words.ends.tolist(), strict=True))
        for i in range(block.n):
            a, z = int(words.doc[i]), int(words.doc[i + 1])
            if a == z:
                continue
            k = min(n, z - a)
            table = out.setdefault(k, {})
            for j, h in enumerate(K.run_hash(hashes[a:z], k).tolist()):
                joined = b" ".join(raw[s:e] for s, e in spans[a + j: a + j + k])
                entry = (joined, items[block.first + i][0])
                found = table.setdefault(h, [])
                if entry not in found:
                    found.append(entry)
    return out


def _scan(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    lookups = [(k, t, np.sort(np.array(list(t), dtype=np.uint64))) for k, t in table.value.items()]
    for batch in batches:
        runs, items, n_words = [], [], []
        old_runs = batch.column("runs").to_pylist()
        old_items = batch.column("items").to_pylist()
        for block in K.text_blocks(batch.column("text")):
            data = K.LOWER[block.data]
            words = K.find_words(data, block.offsets, K.ALNUM)
            hashes = K.span_hash(K.prefix_hash(data), words.starts, words.ends)
            found: dict[int, tuple[set, list]] = {}
            raw = None
            for k, by_hash, keys in lookups:
                starts = K.windows(words, k)
                h = K.run_hash(hashes, k)[starts]
                at = np.searchsorted(keys, h)
                at[at == len(keys)] = 0
                for i in np.flatnonzero(keys[at] == h).tolist():
                    w = int(starts[i])
                    raw = raw or data.tobytes()
                    joined = b" ".join(raw[words.starts[x]: words.ends[x]] for x in range(w, w + k))
                    hit = [item for text, item in by_hash[int(h[i])] if text == joined]
                    if hit:
                        doc = int(np.searchsorted(words.doc, w, side="right")) - 1
                        ids, spans = found.setdefault(doc, (set(), []))
                        ids.update(x for x in hit if x is not None)
                        spans.append((w - int(words.doc[doc]), w - int(words.doc[doc]) + k))
            for d, n in enumerate(words.counts.tolist()):
                row = block.first + d
                ids, spans = found.get(d, (set(), []))
                spans = sorted([*spans, *((r["first"], r["after"]) for r in old_runs[row] or [])])
                merged: list[list[int]] = []
                for s, e in spans:
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                n_words.append(n)
                runs.append([{"first": s, "after": e} for s, e in merged])
                items.append(sorted({*ids, *(old_items[row] or [])}))
        schema = batch.schema
        arrays = [batch.column(i) for i in range(batch.num_columns)]
        for name, values in (("n_words", n_words), ("runs", runs), ("items", items)):
            i = schema.get_field_index(name)
            arrays[i] = pa.array(values, type=schema.field(i).type)
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _slices(spark: SparkSession, items: DataFrame, slice_bytes: int, n: int) -> Iterator:
    """Broadcast window tables, one for each slice of at most about
    ``slice_bytes`` bytes of item text (a longer single item is one slice)."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // slice_bytes))
    slot = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for s in range(count):
        part = [(r["item"], r["text"]) for r in
                items.where(F.col("text").isNotNull() & (slot == s)).collect()]
        yield spark.sparkContext.broadcast(_item_windows(part, n))


def find_windows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW_WORDS,
                 slice_bytes: int = SLICE_BYTES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per document: the ``keep`` columns, ``text``, n_words, ``runs`` (hit word
    ranges ``first`` to before ``after``, merged) and ``items`` (sorted item ids
    as strings, those with a window in the text)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.col(item_text_col).cast("string").alias("text"))
    kept = [F.col(c).alias(f"keep_{c}") for c in keep if c != "text"]
    run = T.StructType([T.StructField("first", T.LongType()), T.StructField("after", T.LongType())])
    out = docs.select(*kept, F.col(text_col).cast("string").alias("text"),
                      F.lit(0).cast("long").alias("n_words"),
                      F.array().cast(T.ArrayType(run)).alias("runs"),
                      F.array().cast("array<string>").alias("items"))
    for table in _slices(spark, items, slice_bytes, n):
        out = out.mapInArrow(K.ends(partial(_scan, table=table)), out.schema)
    return out.select(*(F.col(f"keep_{c}").alias(c) for c in keep if c != "text"),
                      "text", "n_words", "runs", "items")


def n_hit(runs: str = "runs"):
    """Words inside any occurrence of a window."""
    return F.aggregate(F.col(runs), F.lit(0).cast("long"),
                       lambda a, r: a + r["after"] - r["first"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        runs = batch.column("runs").to_pylist()
        hit = [i for i, r in enumerate(runs) if r]
        for i in hit:
            raw = np.frombuffer(texts[i].encode("utf-8"), dtype=np.uint8)
            words = K.find_words(K.LOWER[raw], np.array([0, len(raw)]), K.ALNUM)
            keep = np.ones(len(raw), dtype=bool)
            for r in runs[i]:
                keep[words.starts[r["first"]]: words.ends[r["after"] - 1]] = False
            texts[i] = raw[keep].tobytes().decode("utf-8")
        i = batch.schema.get_field_index("text")
        yield batch.set_column(i, batch.schema.field(i), pa.array(texts, type=batch.schema.field(i).type))


def remove_hits(found: DataFrame) -> DataFrame:
    """``find_windows`` rows with the hit words (and what stands between them)
    cut out of ``text``."""
    return found.mapInArrow(K.ends(_cut), found.schema)
