"""Global row numbers without passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotledger.session import cut

ROW_BITS = 33  # monotonically_increasing_id keeps the row in its low 33 bits


def _part_offsets(stored: DataFrame, amount: Column) -> DataFrame:
    """What the parts before each part add up to: one row per part."""
    totals = stored.groupBy("_part").agg(F.sum(amount).alias("_total"))
    # One row per range partition, so this window is as small as the task list.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )


def with_global_ids(
    df: DataFrame, order: list[Column], name: str = "id", keep: list[str] | None = None
) -> DataFrame:
    """Number all rows 1..n in the given order; ``keep`` names the columns to go on with, if not all.

    Rows are range-partitioned and sorted once, the row's place in its partition
    is kept in a written table, and the sizes of the partitions before it are
    added. ``order`` should be total: rows that tie are numbered in any order.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", ROW_BITS))
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    )
    keep = keep or df.columns
    stored = cut(placed.select(*keep, "_place", "_part"), "ordered")
    offsets = _part_offsets(stored, F.lit(1))
    return stored.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_place") + 1).cast("bigint").alias(name), *keep
    )


def with_global_starts(
    df: DataFrame, order: list[Column], width: Column, name: str
) -> DataFrame:
    """Give each row the first number of a run of ``width`` numbers, in the given order.

    A row that later unfolds into ``width`` rows can so be numbered before it does.
    """
    spread = df.withColumn("_width", width).repartitionByRange(*order)
    stored = cut(spread.withColumn("_part", F.spark_partition_id()), "ordered")
    offsets = _part_offsets(stored, F.col("_width"))
    before = Window.partitionBy("_part").orderBy(*order)
    local = stored.withColumn(
        "_before", F.sum("_width").over(before.rowsBetween(Window.unboundedPreceding, -1))
    )
    start = F.col("_offset") + F.coalesce(F.col("_before"), F.lit(0)) + 1
    return local.join(F.broadcast(offsets), "_part").select(
        *df.columns, start.cast("bigint").alias(name)
    )
