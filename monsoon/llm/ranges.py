"""A total order over a whole table by range partitioning: places, ranks and running sums without a window over all rows.

Rows are range-partitioned, sorted in each range and written, which fixes the ranges; what precedes a range is then known from
one row a range.  A key that many rows share is split by what comes after it in the order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch

_PLACE_BITS = 33  # of monotonically_increasing_id: the partition above, the row's place in it below


def ranges(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_ranges(scratch: Scratch, df: DataFrame, order: list[Column], name: str = "ranged", along: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """df, written in ranges of this order, with part (int: the range, ascending) and place (long: from 0 in each range).

    along may add columns partition by partition, in whose tasks rows come in this order.
    """
    ranged = df.repartitionByRange(ranges(scratch.spark), *order).sortWithinPartitions(*order)
    at = F.col("at_")
    written = scratch.table(along(ranged.withColumn("at_", F.monotonically_increasing_id())), name)
    return written.withColumns({"part": F.shiftright(at, _PLACE_BITS).cast("int"), "place": at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}).drop("at_")


def ranked(scratch: Scratch, df: DataFrame, order: list[Column], name: str = "ranged") -> DataFrame:
    """df with rank: 1, 2, 3... in this order, equal rows in any order among themselves.  Broadcasts a row a range."""
    placed = in_ranges(scratch, df, order, name)
    before, rows = 0, []
    for r in sorted(placed.groupBy("part").agg(F.count("*").alias("n")).collect()):
        rows.append((r.part, before))
        before += r.n
    offsets = scratch.spark.createDataFrame(rows, "part int, before long")
    return placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")
