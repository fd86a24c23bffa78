"""User-damped item-to-item similarity and per-item top-k lists.

For a log of (user, item) events::

    N_u   = events of user u
    c_ui  = events of user u on item i
    w_i   = sum over all users of c_ui^2 / ln(1 + N_u)
    s_ij  = sum over users with fewer than ``cap`` distinct items of
            c_ui * c_uj / ln(1 + N_u)
    score = s_ij / sqrt(w_i) / sqrt(w_j)

Plan shape (see ``explain``): the log is combined map-side to one row per
(user, item) and written once. User totals, and later item weights, come back
to those rows by a salted join, so a user or an item that holds a third of
them is spread over the cluster and nothing is broadcast on trust. Weights join
per (user, item) as ``x = c / sqrt(w)``, so the pair table is never joined with
anything: ``score = sum_u x_ui * x_uj / ln(1 + N_u)``. A user under the cap is a
basket of fewer than ``cap`` items; baskets are dealt over as many tasks as
their pairs need and unfold in place, each unordered pair once (``i < j``),
into a partial aggregate before the pair shuffle. The mirror is an
``explode`` of two structs, and the top-k is a ``row_number`` filter that Spark
plans as a per-partition ``WindowGroupLimit`` before the shuffle on
``item_id``, so at most k rows per item and map task travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from coview.functions.scalars import fixed5
from coview.operators.behavior import user_item_counts
from coview.operators.layout import PAIRS_PER_TASK, salted_join, spread_by_pairs
from coview.operators.partners import best_partners
from coview.session import write_cut


def rank_score(c: Column) -> Column:
    """The score used for ordering and output: rounded to 9 places after a
    1e-12 bias, so sums taken in another order still rank the same."""
    return F.round(c + F.lit(1e-12), 9)


def damped_counts(pairs: DataFrame, salts: int | None = None) -> DataFrame:
    """(user_id, item_id, n, n_events, n_items) for every user-item pair."""
    return with_user_totals(write_cut(user_item_counts(pairs), "user_item_counts"), salts)


def with_user_totals(cui: DataFrame, salts: int | None = None) -> DataFrame:
    """A written (user_id, item_id, n) table with its users' events and items."""
    totals = cui.groupBy("user_id").agg(F.sum("n").alias("n_events"),
                                        F.count(F.lit(1)).alias("n_items"))
    return salted_join(cui, totals, "user_id", ["item_id"], salts)


def item_weights(dc: DataFrame, *more: Column) -> DataFrame:
    """(item_id, weight, n_users): weight = sum over all users of c^2 / ln(1 + N_u).
    ``more`` are further sums of the same pass."""
    return dc.groupBy("item_id").agg(
        F.sum(F.col("n") * F.col("n") / F.log(F.lit(1.0) + F.col("n_events"))).alias("weight"),
        F.count(F.lit(1)).alias("n_users"), *more)


CAP_COLUMNS = {"items": "n_items", "events": "n_events"}


def _under_cap(cap: int, cap_on: str):
    """Users who make pairs: fewer than ``cap`` distinct items (the job's rule)
    or, with ``cap_on="events"``, fewer than ``cap`` events (its older form).
    Either way a user has fewer than ``cap`` distinct items, which bounds the
    pairs a user adds."""
    return F.col(CAP_COLUMNS[cap_on]) < cap


def count_pairs(dc: DataFrame, cap: int = 100, cap_on: str = "items") -> int:
    """How many (user, unordered item pair) rows the users under the cap make."""
    return int(dc.where(_under_cap(cap, cap_on)).agg(F.sum((F.col("n_items") - 1) / 2)).first()[0] or 0)


def _pair_sums(df: DataFrame, value: str, cap: int, cap_on: str, name: str, n_pairs: int,
               pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """(item_a, item_b, name), item_a < item_b: the sum over users under the cap
    of the product of both values, damped by the user's events.

    Baskets hold fewer than ``cap`` items, so one user's pairs are a small part
    of a task's and tasks of equal pair counts follow from dealing users by
    hash over ``pairs / pairs_per_task`` tasks.
    """
    capped = df.where(_under_cap(cap, cap_on)).select("user_id", "item_id", F.col(value).alias("x"), "n_events")
    baskets = (spread_by_pairs(capped, "user_id", n_pairs, per_task=pairs_per_task).groupBy("user_id", "n_events")
               .agg(F.array_sort(F.collect_list(F.struct("item_id", "x"))).alias("items")))
    firsts = baskets.select("n_events", "items", F.posexplode("items").alias("at", "a"))
    pairs = firsts.select("n_events", "a", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("b"))
    product = F.col("a.x") * F.col("b.x") / F.log(F.lit(1.0) + F.col("n_events"))
    return (pairs.select(F.col("a.item_id").alias("item_a"), F.col("b.item_id").alias("item_b"), product.alias("s"))
            .groupBy("item_a", "item_b").agg(F.sum("s").alias(name)))


def item_pair_scores(dc: DataFrame, cap: int = 100, cap_on: str = "items") -> DataFrame:
    """(item_a, item_b, pair_score) with item_a < item_b, users under the cap only:
    the sum over those users of ``c_a * c_b / ln(1 + N_u)``."""
    return _pair_sums(dc, "n", cap, cap_on, "pair_score", count_pairs(dc, cap, cap_on))


def normalized_counts(dc: DataFrame, weights: DataFrame, salts: int | None = None) -> DataFrame:
    """``dc`` with ``x = n / sqrt(weight of the item)`` and the weights' further sums.

    Joining the weights here, once per (user, item), replaces the two joins of
    the much larger pair table with the weights (``s_ij / sqrt(w_i) / sqrt(w_j)``
    is the sum of ``x_ui * x_uj / ln(1 + N_u)``).
    """
    j = salted_join(dc, weights.drop("n_users"), "item_id", ["user_id"], salts)
    return j.withColumn("x", F.col("n") / F.sqrt("weight"))


def similarity_half(dcn: DataFrame, cap: int = 100, cap_on: str = "items", n_pairs: int | None = None) -> DataFrame:
    """(item_a, item_b, score), item_a < item_b, from normalised counts."""
    n_pairs = count_pairs(dcn, cap, cap_on) if n_pairs is None else n_pairs
    return _pair_sums(dcn, "x", cap, cap_on, "score", n_pairs)


def mirror(half: DataFrame) -> DataFrame:
    """Both directions of each unordered pair: (item_id, other_id, score)."""
    both = F.explode(F.array(
        F.struct(F.col("item_a").alias("item_id"), F.col("item_b").alias("other_id"), "score"),
        F.struct(F.col("item_b").alias("item_id"), F.col("item_a").alias("other_id"), "score")))
    return half.select(both.alias("p")).select("p.item_id", "p.other_id", "p.score")


def item_similarity(pairs: DataFrame, cap: int = 100, salts: int | None = None,
                    cap_on: str = "items") -> DataFrame:
    """(item_id, other_id, score) in both directions, score as ``rank_score``.

    The per-(user, item) table with user totals is written once to the shared
    folder; the weights and the normalised counts both read it. Scores are
    rounded once per unordered pair, before the mirror doubles the rows.
    """
    dc = write_cut(damped_counts(pairs, salts), "damped_counts")
    half = similarity_half(normalized_counts(dc, item_weights(dc), salts), cap, cap_on, count_pairs(dc, cap, cap_on))
    return mirror(half.withColumn("score", rank_score(F.col("score"))))


def items_with_partners(dc: DataFrame, cap: int = 100, cap_on: str = "items") -> DataFrame:
    """(item_id) of every item that has at least one similar item.

    Exact without building pairs: every pair score is a sum of positive terms,
    so an item has a partner exactly when a user under the cap holds it
    together with at least one other item.
    """
    return (dc.where((F.col("n_items") >= 2) & _under_cap(cap, cap_on))
            .select("item_id").distinct())


def top_k(similar: DataFrame, k: int = 10, round_scores: bool = True) -> DataFrame:
    """(item_id, rank, other_id, score): the k best partners per item.

    Ties in the rounded score go to the smaller partner id. Scores from
    ``item_similarity`` are rounded already (``round_scores=False`` skips the
    second, idempotent rounding).
    """
    w = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("other_id").asc())
    ranked = similar.withColumn("score", rank_score(F.col("score"))) if round_scores else similar
    return (ranked.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "other_id", "score"))


def top_k_list(ranked: DataFrame) -> DataFrame:
    """(item_id, item_list) with ``other:0.12345;other:...`` in rank order.

    The group holds at most k rows after ``top_k``, so the list is bounded.
    """
    entry = F.struct("rank", F.concat(F.col("other_id").cast("string"), F.lit(":"),
                                      fixed5(F.col("score"))).alias("txt"))
    return (ranked.groupBy("item_id")
            .agg(F.array_sort(F.collect_list(entry)).alias("e"))
            .select("item_id", F.array_join(F.transform("e", lambda x: x["txt"]), ";")
                    .alias("item_list")))


def top_similarity(pairs: DataFrame, k: int = 10, cap: int = 100, salts: int | None = None,
                   cap_on: str = "items", **sizes) -> DataFrame:
    """(item_id, other_id, score): the rows of ``item_similarity`` that ``top_k``
    can keep. The same sums, each item's pairs in one place and never on disk
    all at once (``partners.best_partners``, which takes ``sizes``)."""
    dc = write_cut(damped_counts(pairs, salts), "damped_counts")
    paired = _under_cap(cap, cap_on) & (F.col("n_items") > 1)
    made = F.coalesce(F.sum(F.when(paired, F.col("n_items") - 1)), F.lit(0)).alias("pairs")
    dcn = normalized_counts(dc, item_weights(dc, made), salts).where(paired)
    return best_partners(dcn, dc.where(paired).count(), k, rank_score, **sizes)


def related_items(pairs: DataFrame, k: int = 10, cap: int = 100,
                  salts: int | None = None, cap_on: str = "items", **sizes) -> DataFrame:
    """The whole job: behaviour pairs to (item_id, item_list).

    ``cap_on="events", cap=500, k=100`` is the job's older form, which capped
    users on their event count; its pair sums are the same.
    """
    return top_k_list(top_k(top_similarity(pairs, k, cap, salts, cap_on, **sizes), k, round_scores=False))


def shown_items(lists: DataFrame, active: DataFrame, n: int = 101) -> DataFrame:
    """Lists of active items only, the first ``n`` by item id (the job's printout)."""
    return (lists.join(active.select("item_id"), "item_id", "left_semi")
            .orderBy("item_id").limit(n))
