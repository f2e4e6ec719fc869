"""Positions of rows in a global order, numbered where the sorted rows are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portolan.llm.store import cut

#: Bits below a partition's number in ``monotonically_increasing_id``.
_PART_BITS = 33


def sorted_table(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` sorted by range partitions and written, with ``_part`` (the range)
    and ``_at`` (a number that grows along the order).  The table is written
    once, so every later plan sees the same ranges."""
    numbered = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    return cut(numbered, name).withColumn("_part", F.shiftright("_at", _PART_BITS))


def ranked(df: DataFrame, order: list[Column], name: str, rank_as: str) -> DataFrame:
    """``df`` with its rank from 1 on in ``order``.

    Rows are range-partitioned; a range's offset is the number of rows before
    it.  No task sees more than its range; the offsets are one row per range
    (at most ``spark.sql.shuffle.partitions``).  Rows that are equal in every
    sort column may take each other's rank.
    """
    table = sorted_table(df, order, name)
    sizes = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return (table.join(F.broadcast(offsets), "_part")
            .withColumn(rank_as, F.col("_before") + within + 1)
            .drop("_part", "_at", "_before"))
