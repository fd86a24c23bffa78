"""Matrix factorisation by alternating least squares, as keyed sums.

A half step solves one small system per user (or item)::

    (sum v v' + reg * n * I) x = sum r v        over its n ratings (v, r)

The sums are one packed row per key (``rank * (rank + 1) / 2 + rank`` numbers),
partial in every map task, so a user or item with a third of all ratings
leaves a task as one row. Ratings are packed once by either side, one row a key
(several for a key of very many ratings), and the factors of a side come to its
packed rows, so a half step moves a key's factors once and not once a rating. The
system is solved in place by an unrolled Cholesky decomposition. Ids are
keys and may be of any type; no id index is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coview.session import write_cut

#: ratings of a packed row, about
CHUNK = 1 << 14


def start_value(key: str, j: int) -> Column:
    """A start factor in [0.1, 1.1) from the id alone: the first 24 bits of
    ``md5('id:j')``."""
    digits = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{j}"))), 1, 6)
    return F.lit(0.1) + F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 24))


def _names(rank: int) -> list[str]:
    return [f"f{j}" for j in range(rank)]


def packed(ratings: DataFrame, by: str, other: str, rating: str, chunk: int = CHUNK) -> DataFrame:
    """(by, _chunk, _entries): the ratings of a key as one array of (other, rating),
    or as several of about ``chunk`` entries. Written.

    Only keys of more than ``chunk`` ratings are broadcast, at most one for so
    many ratings. Rows without a key are left out.
    """
    rows = ratings.select(by, other, rating).where(F.col(by).isNotNull())
    long = (rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk)
            .select(by, F.ceil(F.col("_n") / chunk).alias("_chunks")))
    own = F.coalesce(F.pmod(F.xxhash64(other, rating), F.col("_chunks")), F.lit(0).cast("long"))
    return write_cut(rows.join(F.broadcast(long), by, "left").withColumn("_chunk", own)
                     .groupBy(by, "_chunk").agg(F.collect_list(F.struct(other, rating)).alias("_entries")), "als_packed")


def _sums(pack: DataFrame, fixed: DataFrame, key: str, other: str, rating: str, rank: int) -> DataFrame:
    f = _names(rank)
    there = pack.select(other, "_chunk").join(fixed.select(other, *f), other)
    met = pack.join(there, [other, "_chunk"]).select(*f, F.inline("_entries").alias(key, rating))
    outer = [F.sum(F.col(f[i]) * F.col(f[j])).alias(f"g{i}_{j}") for i in range(rank) for j in range(i, rank)]
    right = [F.sum(F.col(rating) * F.col(f[j])).alias(f"b{j}") for j in range(rank)]
    return met.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *outer, *right)


def gram_sums(ratings: DataFrame, fixed: DataFrame, key: str, other: str, rating: str, rank: int,
              chunk: int = CHUNK) -> DataFrame:
    """(key, n, g{i}_{j} for i <= j, b{j}): the packed normal equations of ``key``."""
    return _sums(packed(ratings, other, key, rating, chunk), fixed, key, other, rating, rank)


def solve(sums: DataFrame, key: str, rank: int, reg: float) -> DataFrame:
    """(key, n, f0..): the solution of every row's system, by Cholesky.

    One projection per column of the decomposition keeps each expression short.
    """
    c = F.col
    out = sums.withColumns({f"g{j}_{j}": c(f"g{j}_{j}") + F.lit(reg) * c("n") for j in range(rank)})
    for j in range(rank):
        square = c(f"g{j}_{j}")
        for k in range(j):
            square = square - c(f"l{j}_{k}") * c(f"l{j}_{k}")
        out = out.withColumn(f"l{j}_{j}", F.sqrt(square))
        below = {}
        for i in range(j + 1, rank):
            rest = c(f"g{j}_{i}")
            for k in range(j):
                rest = rest - c(f"l{i}_{k}") * c(f"l{j}_{k}")
            below[f"l{i}_{j}"] = rest / c(f"l{j}_{j}")
        out = out.withColumns(below) if below else out
    for j in range(rank):
        rest = c(f"b{j}")
        for k in range(j):
            rest = rest - c(f"l{j}_{k}") * c(f"y{k}")
        out = out.withColumn(f"y{j}", rest / c(f"l{j}_{j}"))
    for j in reversed(range(rank)):
        rest = c(f"y{j}")
        for k in range(j + 1, rank):
            rest = rest - c(f"l{k}_{j}") * c(f"f{k}")
        out = out.withColumn(f"f{j}", rest / c(f"l{j}_{j}"))
    return out.select(key, "n", *_names(rank))


def residuals(sums: DataFrame, solved: DataFrame, key: str, rank: int, reg: float) -> DataFrame:
    """(key, residual): the largest error of a key's factors in its equations."""
    both = sums.drop("n").join(solved, key)
    errors = []
    for i in range(rank):
        left = F.lit(reg) * F.col("n") * F.col(f"f{i}")
        for j in range(rank):
            left = left + F.col(f"g{min(i, j)}_{max(i, j)}") * F.col(f"f{j}")
        errors.append(F.abs(left - F.col(f"b{i}")))
    return both.select(key, (F.greatest(*errors) if rank > 1 else errors[0]).alias("residual"))


def alternating_least_squares(ratings: DataFrame, rank: int = 10, iterations: int = 10, reg: float = 0.01,
                              user: str = "user", item: str = "item", rating: str = "rating",
                              chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """((user, n, f0..), (item, n, f0..)) after ``iterations`` rounds.

    A round solves the items from the users, then the users from the items;
    the users start from their ids (``start_value``). ``reg`` counts once per
    rating of a key. Rows without a user, item or rating are left out; several
    ratings of a pair all count. Each half step is written to the shared folder.
    """
    ratings = write_cut(ratings.select(user, item, F.col(rating).cast("double").alias(rating)).dropna(), "als_ratings")
    by_user, by_item = packed(ratings, user, item, rating, chunk), packed(ratings, item, user, rating, chunk)
    users = by_user.select(user).distinct().select(user, *(start_value(user, j).alias(f"f{j}") for j in range(rank)))
    items = None
    for _ in range(iterations):
        items = write_cut(solve(_sums(by_user, users, item, user, rating, rank), item, rank, reg), "als_items")
        users = write_cut(solve(_sums(by_item, items, user, item, rating, rank), user, rank, reg), "als_users")
    if items is None:
        raise ValueError("iterations must be positive")
    return users, items
