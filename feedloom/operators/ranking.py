"""Places and ranks without a task that holds a whole table or group.

A range sort spreads the rows over all tasks; a row's place is its partition's offset plus its number inside the partition, and its rank in a group is its
place minus the group's first place. Only one count for each partition and one minimum for each group are aggregated, so a group with a third of all rows
is sorted by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import ensure_checkpoint_dir

_BITS = 33


def numbered(df: DataFrame, *order: Column | str, place: str = "place") -> DataFrame:
    """df with its place from 1 in the given order. The order must be total for a defined result."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", _BITS)
    counts = rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_p", F.coalesce(before, F.lit(0)).alias("_o"))
    return rows.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn(place, F.col("_o") + F.col("_id").bitwiseAND((1 << _BITS) - 1) + 1).drop("_id", "_p", "_o")


def ranked(df: DataFrame, groups: list[str], *order: Column | str, rank: str = "rank") -> DataFrame:
    """df with its rank from 1 inside its group; null is a group of its own."""
    rows = numbered(df, *groups, *order, place="_place")
    starts = rows.groupBy(*groups).agg(F.min("_place").alias("_start"))
    same = None
    for g in groups:
        eq = rows[g].eqNullSafe(starts[g])
        same = eq if same is None else same & eq
    joined = rows.join(starts, same).drop(*[starts[g] for g in groups])
    return joined.withColumn(rank, F.col("_place") - F.col("_start") + 1).drop("_place", "_start")


def with_next(df: DataFrame, groups: list[str], order: list[Column | str], columns: list[str]) -> DataFrame:
    """df with ``next_<column>`` of the row that follows in its group, null for the last one; joined by place, so no group is one task."""
    rows = numbered(df, *groups, *order, place="_place")
    after = rows.select((F.col("_place") - 1).alias("_place"), *[F.col(g).alias(f"_g_{g}") for g in groups], *[F.col(c).alias(f"next_{c}") for c in columns])
    joined = rows.join(after, "_place", "left")
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return joined.withColumns({f"next_{c}": F.when(same, F.col(f"next_{c}")) for c in columns}).drop("_place", *[f"_g_{g}" for g in groups])


def running_total(df: DataFrame, groups: list[str], order: list[Column | str], column: str, total: str = "total") -> DataFrame:
    """df with the running total of a column inside each group: windows over one sorted partition each, and offsets of the partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.orderBy(*groups, *order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", _BITS)
    inside = rows.withColumn("_p", part).withColumn("_in", F.sum(column).over(Window.partitionBy("_p").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)))
    sums = rows.groupBy(part.alias("_p")).agg(F.sum(column).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = inside.join(F.broadcast(sums.select("_p", before.alias("_o"))), "_p").withColumn("_all", F.col("_in") + F.col("_o"))
    starts = whole.groupBy(*groups).agg(F.min_by(F.col("_all") - F.col(column), F.col("_id")).alias("_start"))
    same = None
    for g in groups:
        eq = whole[g].eqNullSafe(starts[g])
        same = eq if same is None else same & eq
    return whole.join(starts, same).drop(*[starts[g] for g in groups]).withColumn(total, F.col("_all") - F.col("_start")).drop("_id", "_p", "_in", "_o", "_all", "_start")
