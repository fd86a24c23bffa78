"""Places of rows in sorted groups, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coview.session import write_cut

_PLACE_BITS = 33  # monotonically_increasing_id = partition << 33 | place


def positions(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``at`` (0-based place inside its group) and ``total`` (rows
    of the group), both long.

    Rows are range-partitioned by group and order, so a group of any size is
    spread over as many partitions as it fills, and written once to the shared
    folder: range bounds come from a sample, and places and counts must see the
    same cut. What one window holds is a group's partitions, one row each.
    ``group`` columns must not be null. Ties are cut anywhere; rows that tie
    have no order of their own.
    """
    keys = [*group, *order, "_tie"]
    placed = (rows.withColumn("_tie", F.rand(7)).repartitionByRange(*keys).sortWithinPartitions(*keys)
              .drop("_tie").withColumn("_place", F.monotonically_increasing_id())
              .withColumn("_part", F.shiftright("_place", _PLACE_BITS)))
    placed = write_cut(placed, name)
    runs = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(*group, "_part", "_first", F.sum("_n").over(whole).alias("total"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (placed.join(starts, [*group, "_part"])
            .withColumn("at", F.col("_before") + F.col("_place") - F.col("_first"))
            .drop("_place", "_part", "_first", "_before"))
