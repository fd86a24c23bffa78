"""The best partners of every item, without a table of all pairs.

A user under the cap is a basket. For each item of it the basket goes, as one
packed row, to the item's part; a part holds all baskets of its items, so it sums
the scores of its pairs and keeps the best ``k`` of an item in place. Neither
pairs nor their mirror are shuffled, only baskets, and those in rounds: a round
takes some of the parts, writes their few rows, and its shuffle files go before
the next one begins. What is on disk at once grows with the rows of the
user-item table, not with the pairs.

An item of more pairs than a part is to hold is hot. Its pairs are summed as
rows, combined before they are shuffled, so no item has to fit one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coview.operators.layout import PAIRS_PER_TASK, ROWS_PER_TASK, spread_by_pairs
from coview.session import parallelism, write_cut

#: pairs (both directions) of a part, and of an item that is hot
PART_PAIRS = 1 << 20
#: pairs that a round makes for each row of the user-item table, and at least
ROUND_PAIRS, ROUND_LEAST = 8, 1 << 26


def _best(table: pa.Table, k: int) -> pa.Table:
    """The best ``k`` partners of a part's items; one row a basket and own item."""
    lists = table["items"].combine_chunks()
    found = lists.flatten().dictionary_encode()
    order = pc.array_sort_indices(found.dictionary)
    vocabulary = found.dictionary.take(order)
    rank = np.empty(len(vocabulary), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(vocabulary))
    other = rank[found.indices.to_numpy()]
    mine = pc.index_in(table["item_id"].combine_chunks(), vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    held = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(mine)), held)
    x, events = table["x"].to_numpy(), table["n_events"].to_numpy()
    value = x[row] * table["xs"].combine_chunks().flatten().to_numpy() / np.log(1.0 + events)[row]
    pair = mine[row] * len(vocabulary) + other
    keep = mine[row] != other
    pair, value = pair[keep], value[keep]
    by = np.argsort(pair)
    pair = pair[by]
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    # ``rank_score`` in units of 1e-9; a score is at most 1, as the weights count all users
    score = np.floor((np.add.reduceat(value[by], first) + 1e-12) * 1e9 + 0.5).astype(np.int64)
    mine, other = np.divmod(pair[first], len(vocabulary))
    top = score.max()
    by = np.argsort(mine * (top + 1) + (top - score), kind="stable")   # ties stay in the order of the partner
    mine = mine[by]
    first = np.flatnonzero(np.diff(mine, prepend=-1))
    place = np.arange(len(mine)) - np.repeat(first, np.diff(np.append(first, len(mine))))
    by, mine = by[place < k], mine[place < k]
    return pa.table({"item_id": vocabulary.take(pa.array(mine)), "other_id": vocabulary.take(pa.array(other[by])),
                     "score": score[by] / 1e9})


def best_partners(dcn: DataFrame, rows: int, k: int, rank_score: Callable[[Column], Column],
                  part_pairs: int = PART_PAIRS, round_pairs: int | None = None) -> DataFrame:
    """(item_id, other_id, score) with at least the best ``k`` partners of every item.

    ``dcn`` has (user_id, item_id, n_events, x, pairs): ``rows`` normalised counts
    of the users who make pairs, with the pairs that their item is in.
    """
    spark, kind = dcn.sparkSession, dcn.schema["item_id"].dataType
    cells = dcn.select("user_id", "n_events", F.struct(
        "item_id", "x", (F.col("pairs") > part_pairs).alias("hot")).alias("c"))
    tasks = max(parallelism(spark), -(-rows // ROWS_PER_TASK))
    size, hot_items = F.size("items.item_id"), F.size(F.filter("items.hot", lambda h: h))
    baskets = write_cut(
        cells.repartition(tasks, "user_id").groupBy("user_id", "n_events").agg(F.collect_list("c").alias("items"))
        .select("user_id", "n_events", F.col("items.item_id").alias("items"), F.col("items.x").alias("xs"),
                F.col("items.hot").alias("hot"), (hot_items * (size - 1)).cast("long").alias("hot_pairs"),
                ((size - hot_items) * (size - 1)).cast("long").alias("pairs")).where("size(items) > 1"), "baskets")
    n_pairs, n_hot = (v or 0 for v in baskets.agg(F.sum("pairs"), F.sum("hot_pairs")).first())

    def own(of: DataFrame) -> DataFrame:
        """A row for each item of a basket."""
        return of.select("*", F.posexplode("items").alias("at", "item_id")).select(
            "n_events", "items", "xs", "item_id", F.get("xs", F.col("at")).alias("x"), F.get("hot", F.col("at")).alias("is_hot"))

    parts = max(1, -(-n_pairs // part_pairs))
    rounds = max(1, -(-n_pairs // (round_pairs or max(ROUND_LEAST, ROUND_PAIRS * rows))))
    schema = f"item_id {kind.simpleString()}, other_id {kind.simpleString()}, score double"
    sent = own(baskets.where("pairs > 0")).where("not is_hot").select(
        F.pmod(F.xxhash64("item_id"), F.lit(parts)).alias("part"), "item_id", "x", F.col("n_events").cast("double").alias("n_events"),
        "items", "xs")
    out = []
    for turn in range(rounds if n_pairs else 0):
        dealt = sent.where(F.col("part") % rounds == turn).repartition(max(parallelism(spark), -(-parts // rounds)), "part")
        out.append(write_cut(dealt.groupBy("part").applyInArrow(lambda t: _best(t, k), schema), "partners"))
    if n_hot:
        dealt = own(spread_by_pairs(baskets.where("hot_pairs > 0"), "user_id", n_hot, per_task=PAIRS_PER_TASK)).where("is_hot")
        product = F.col("x") * F.get("xs", F.col("at")) / F.log(F.lit(1.0) + F.col("n_events"))
        pairs = dealt.select("*", F.posexplode("items").alias("at", "other_id")).where("item_id <> other_id").select(
            "item_id", "other_id", product.alias("s"))
        out.append(pairs.groupBy("item_id", "other_id").agg(rank_score(F.sum("s")).alias("score")))
    found = out[0] if out else spark.createDataFrame([], schema)
    for more in out[1:]:
        found = found.unionByName(more)
    return found
