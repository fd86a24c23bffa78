"""Mix sources to target weights: capped water-filling, then seeded sampling.

Every source asks for its share of the mix by weight. A source that would be
repeated more than ``epochs`` times is clamped there, and what it leaves over is
dealt again among the others by weight, until none is above its cap. A target
becomes whole passes over the source and a fractional one. The fractional pass
reads the source in a seeded order and stops at its last word, inside a document
if need be, so a source's taken words are its target rounded down, exactly.

Only DataFrame expressions: places in the seeded order are running sums over
two levels of hash buckets (256 by 256 per source), so no window holds more
than 256 bucket sums or one bucket's rows, and a source with most of the rows is
spread over 65,536 buckets. The driver sees two numbers a round.

Cases: a null or empty text has size 0 and is never taken; null sources form
one source, after all others; a source without words gets target 0; rows that
share an id (or have none) are placed by id, then by text, and are mixed row by
row; equal rows are interchangeable; an empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coview.llm.ordering import positions
from coview.session import write_cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 17

_SOURCE = ("no_source", "source")
_WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
          seed: int = SEED) -> DataFrame:
    """(doc_id, no_source, source, size, place): ``place`` is the hexadecimal
    digest that fixes a row's place in its source's seeded order."""
    text, source = F.col(text_col).cast("string"), F.col(source_col).cast("string")
    key = F.coalesce(F.col(id_col).cast("string"), text, F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), source.isNull().alias("no_source"),
                       F.coalesce(source, F.lit("")).alias("source"), n_words(text).alias("size"),
                       F.md5(F.concat(F.lit(f"{seed}:"), key)).alias("place"))


def fill(sources: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> Column:
    """The target of a source from its ``weight`` and ``source_size``.

    One small aggregate a round: the caps of the sources found above theirs so
    far, and the weight of all others. The level only rises, so a clamped
    source stays clamped and the rounds end.
    """
    weight, cap = F.col("weight"), (F.col("source_size") * epochs).cast("double")
    total = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)

    def asks(left: float, free: float) -> Column:
        return F.lit(left) * weight / F.lit(free)

    left, free = total, float(sources.agg(F.sum("weight")).first()[0] or 1)
    while True:
        above = asks(left, free) > cap
        got = sources.agg(F.sum(F.when(above, F.col("source_size") * epochs)).alias("clamped"),
                          F.sum(F.when(~above, weight)).alias("free")).first()
        new_left, new_free = total - float(got["clamped"] or 0), float(got["free"] or 0)
        if new_free == 0 or (new_left, new_free) == (left, free):
            return F.least(asks(left, free), cap)
        left, free = new_left, new_free


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
        seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, passes, extra, taken) per row.

    A row is taken ``passes`` times whole, then its first ``extra`` words.
    ``weights`` repeat over the sources in code point order, null last.
    """
    rows = write_cut(sized(docs, id_col, source_col, text_col, seed), "mixing-sizes")
    sums = rows.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))
    sources = write_cut(positions(sums, [], _SOURCE, "mixing-order").select(
        *_SOURCE, "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("double").alias("weight")),
        "mixing-sources")
    sources = sources.withColumn("target", fill(sources, share, epochs))
    # words before a bucket: of earlier coarse buckets, and of earlier fine ones in the same coarse
    coarse, fine = [*_SOURCE, "coarse"], [*_SOURCE, "coarse", "fine"]
    rows = rows.withColumns({"coarse": F.substring("place", 1, 2), "fine": F.substring("place", 3, 2)})
    buckets = rows.groupBy(*fine).agg(F.sum("size").alias("n"))

    def earlier(group: Sequence[str], by: str) -> Column:
        w = Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0))

    starts = (buckets.groupBy(*coarse).agg(F.sum("n").alias("n"))
              .select(*coarse, earlier(_SOURCE, "coarse").alias("coarse_start")))
    starts = starts.join(sources.drop("weight"), [*_SOURCE])
    buckets = buckets.select(*fine, earlier(coarse, "fine").alias("fine_start")).join(starts, coarse)
    own = (Window.partitionBy(*fine).orderBy("place", "doc_id", "size")
           .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.join(buckets, fine).select(
        "doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target",
        (F.col("coarse_start") + F.col("fine_start") + F.coalesce(F.sum("size").over(own), F.lit(0))).alias("before"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    placed = placed.withColumn("passes", passes)
    rest = F.floor("target") - F.col("passes") * F.col("source_size") - F.col("before")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), rest)).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", "passes", extra.alias("extra"),
                         (F.col("passes") * F.col("size") + extra).alias("taken"))


def repeat(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, copy, text): the mix itself, for tables whose ids are unique.

    Whole copies are numbered from 0; the fractional one, last, holds the first
    ``extra`` words as they stand in the text.
    """
    take = mixed.where("taken > 0").select(F.col("doc_id").alias("key"), "size", "passes", "extra")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        take, F.col("doc_id") == F.col("key"))
    some = (F.col("extra") > 0).cast("long")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") + some - 1)))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(rf"({_WORD}[\x20\x09-\x0D]*)")),
                                F.lit(1), F.col("extra").cast("int")), "")
    whole = (F.col("copy") < F.col("passes")) | (F.col("extra") == F.col("size"))
    return rows.select("doc_id", "copy", F.when(whole, F.col("text")).otherwise(head).alias("text"))
