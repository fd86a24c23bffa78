"""Frequent itemsets and matrix-factorisation recommendations."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coview.operators.layout import dense_index, salted_join
from coview.session import parallelism, write_cut

_CHUNK_BITS = 15   # baskets of one bitmap of Spark's (bitmap_construct_agg): 32,768


def transactions(rows: DataFrame, basket_col: str, item_col: str) -> DataFrame:
    """One row per basket with its distinct items (FP-growth refuses duplicates).

    A basket's list is bounded by its own rows; the de-duplication happens
    in the aggregate, not in a driver-side step.
    """
    return rows.groupBy(basket_col).agg(F.collect_set(F.col(item_col).cast("string")).alias("items"))


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.3,
                      num_partitions: int | None = None, items_col: str = "items") -> DataFrame:
    """(itemset, size, freq): every itemset in at least ``ceil(min_support * n)`` baskets.

    A repeated item of a basket counts once.

    ``itemset`` is the sorted items joined by ``,``. The mining is Spark ML's
    parallel FP-growth; ``num_partitions`` spreads its conditional trees and
    defaults to the cluster's parallelism (Spark's own default, the input's
    partition count, is one task for a basket table stored as one file).
    """
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=1.0)
    fp = fp.setNumPartitions(num_partitions or parallelism(baskets.sparkSession))
    baskets = baskets.withColumn(items_col, F.array_distinct(items_col))
    sets = fp.fit(baskets).freqItemsets
    return sets.select(F.array_join(F.array_sort("items"), ",").alias("itemset"),
                       F.size("items").alias("size"), F.col("freq").cast("long").alias("freq"))


def basket_bitmaps(rows: DataFrame, basket_col: str, item_col: str) -> tuple[DataFrame, int]:
    """(items array of one, chunk, bits) and the number of baskets.

    Baskets get dense numbers; an item's baskets are one bit each, 32,768 to a
    chunk. No basket is ever one row, a repeated item sets its bit once more,
    and a basket of any length is spread over the join that numbers its rows.
    """
    pairs = rows.select(F.col(basket_col).alias("basket"), F.col(item_col).cast("string").alias("item"))
    pairs = write_cut(pairs.where("basket is not null and item is not null"), "basket_items")
    index = dense_index(pairs.select("basket").distinct(), ["basket"], "at")
    bits = F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << _CHUNK_BITS) - 1).cast("long")))
    maps = (salted_join(pairs, index, "basket", ["item"])
            .groupBy("item", F.shiftright("at", _CHUNK_BITS).alias("chunk")).agg(bits.alias("bits")))
    return maps.select(F.array("item").alias("items"), "chunk", "bits"), index.count()


def _supported(maps: DataFrame, least: int) -> DataFrame:
    """(items, freq) of the itemsets with at least ``least`` baskets."""
    return (maps.groupBy("items").agg(F.sum(F.bitmap_count("bits")).alias("freq"))
            .where(F.col("freq") >= least))


def _candidates(frequent: DataFrame, size: int) -> DataFrame:
    """(items, part): itemsets of ``size`` two of whose parts are frequent, and
    these parts: those that share all items but their last."""
    a = frequent.select(F.col("items").alias("a"), F.slice("items", 1, size - 2).alias("head"), F.element_at("items", -1).alias("x"))
    b = frequent.select(F.col("items").alias("b"), F.slice("items", 1, size - 2).alias("head"), F.element_at("items", -1).alias("y"))
    both = a.join(b, "head").where(F.col("x") < F.col("y"))
    return both.select(F.concat("a", F.array("y")).alias("items"), F.explode(F.array("a", "b")).alias("part"))


def vertical_itemsets(rows: DataFrame, basket_col: str, item_col: str, min_support: float = 0.3) -> DataFrame:
    """(itemset, size, freq): every itemset in at least ``ceil(min_support * n)`` of
    the ``n`` baskets, from one (basket, item) row per purchase.

    Vertical mining: a level joins its candidates with the bitmaps of the two
    parts they are made of and intersects them (``bitmap_and_agg``) per chunk of
    baskets. What is shuffled are bitmaps of frequent itemsets, whatever the
    length of the baskets. ``itemset`` is the sorted items joined by ``,``. Rows
    without a basket or an item do not count; no rows give no itemsets.
    """
    maps, n = basket_bitmaps(rows, basket_col, item_col)
    least = max(1, math.ceil(min_support * n))
    maps = write_cut(maps, "itemset_bitmaps")
    size, out = 1, None
    while True:
        frequent = write_cut(_supported(maps, least), "itemsets")
        out = frequent if out is None else out.unionByName(frequent)
        size += 1
        if frequent.count() < size:   # a set of `size` items has as many parts of one item less
            break
        parts = maps.withColumnRenamed("items", "part").repartition("chunk")
        met = parts.join(_candidates(frequent, size), "part")
        maps = write_cut(met.groupBy("chunk", "items").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
                         .where("n = 2").drop("n"), "itemset_bitmaps")
    return out.select(F.array_join("items", ",").alias("itemset"), F.size("items").alias("size"), "freq")


def als_factors(ratings: DataFrame, rank: int = 10, iterations: int = 10, reg: float = 0.01,
                blocks: int = -1, seed: int = 42, user_col: str = "user", item_col: str = "item",
                rating_col: str = "rating") -> tuple[DataFrame, DataFrame]:
    """Explicit ALS; returns (user factors, item factors) as (id, features array<float>).

    ``blocks = -1`` lets Spark size the blocks from the input's partitioning.
    """
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, userCol=user_col, itemCol=item_col,
              ratingCol=rating_col, seed=seed, implicitPrefs=False)
    if blocks > 0:
        als = als.setNumBlocks(blocks)
    model = als.fit(ratings)
    return model.userFactors, model.itemFactors
