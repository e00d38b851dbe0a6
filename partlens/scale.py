"""Join and scan building blocks that keep one hot group from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
BLOCK_ROWS = 65_536


def shares(df: DataFrame, keys: Sequence[str], name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with over ``hot_rows`` rows, and how many shares of about that many each makes."""
    counted = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / hot_rows).cast("int").alias(name))
    return counted.where(F.col(name) > 1)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_by: Sequence[str],
    right_by: Sequence[str],
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner equi-join where a key may be heavy on either side, or on both.

    A heavy key's rows are dealt into shares by a hash of ``left_by`` and ``right_by``, and every
    share of one side meets every share of the other, so its pairs spread over the product
    of the two counts. The hash is stable: a task run again deals its rows as before. Heavy keys
    stay a table: Spark broadcasts it while it is small, and splits the join when not.

    A join with a side of few rows for each key needs none of this: Spark splits the other side.
    """
    keys = list(keys)
    heavy = shares(left, keys, "_m", hot_rows).join(shares(right, keys, "_n", hot_rows), keys, "full")
    heavy = heavy.select(*keys, F.coalesce("_m", F.lit(1)).alias("_m"), F.coalesce("_n", F.lit(1)).alias("_n"))

    def dealt(df: DataFrame, by: Sequence[str], own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        found = df.join(heavy, keys, "left")
        own_share = F.pmod(F.xxhash64(*by), F.coalesce(own_count, F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other_count, F.lit(1)) - 1))
        return found.withColumn(own, own_share).withColumn(other, every).drop("_m", "_n")

    here = dealt(left, left_by, "_i", "_m", "_j", "_n")
    there = dealt(right, right_by, "_j", "_n", "_i", "_m")
    return here.join(there, [*keys, "_i", "_j"]).drop("_i", "_j")


def running_last(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    marker: Column,
    name: str,
    *,
    before: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the marker seen last at (or, with ``before``, above) each row of its group.

    ``marker`` is null on rows that carry none, and its order must follow
    ``position``, an integer unique in the group, so that the last marker is the
    largest one. The scan runs per block of ``block_rows`` positions; one row per
    block then carries the state forward, so a group of any length is split over
    many tasks.
    """
    keyed = df.withColumn("_m", marker).withColumn(
        "_block", F.floor(F.col(position) / F.lit(block_rows))
    )
    inside = (
        W.partitionBy(*group, "_block")
        .orderBy(position)
        .rowsBetween(W.unboundedPreceding, -1 if before else W.currentRow)
    )
    earlier = (
        W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    )
    carried = (
        keyed.groupBy(*group, "_block")
        .agg(F.max("_m").alias("_last"))
        .withColumn("_carry", F.max("_last").over(earlier))
        .drop("_last")
    )
    return (
        keyed.withColumn("_here", F.max("_m").over(inside))
        .join(carried, [*group, "_block"], "left")
        .withColumn(name, F.coalesce("_here", "_carry"))
        .drop("_m", "_block", "_here", "_carry")
    )
