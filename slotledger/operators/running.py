"""Running values over ordered groups of any size.

A window runs one group in one task. That is fine for most groups, but one item
may hold a third of all rows. Groups above ``hot_rows`` are therefore cut into
chunks: their rows are range-partitioned and sorted on (group, order), a partition is
cut after every ``hot_rows`` rows, each chunk runs its own window, and what earlier
chunks of the same group add up to is carried in.
Chunks are contiguous, so at most one group enters each chunk from an earlier one, and the carry table has no more rows than there are chunks. All
other groups take the ordinary window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotledger.operators.ids import ROW_BITS
from slotledger.session import cut

HOT_ROWS = 4_000_000
PART_ROWS = 1_000_000  # of groups in chunks, that one task sorts
BUCKETS = 65_536  # of keys, counted before any key is


def bucket_rows(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """The most rows that a group can have, by hashed keys alone, and the rows of all.

    Buckets are few, so their counts combine before the shuffle, however many keys there are.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")
    counted = df.groupBy(bucket).agg(F.count("*").alias("_rows"))
    largest, rows = counted.agg(F.max("_rows"), F.sum("_rows")).first()
    return largest or 0, rows or 0


def heavy_groups(df: DataFrame, keys: list[str], hot_rows: int | None) -> DataFrame | None:
    """Keys of the groups with more than ``hot_rows`` rows; None when there are none.

    Counts combine before the shuffle, and at most rows / hot_rows keys remain.
    With ``hot_rows`` None the caller has made sure already that there are none.
    """
    if hot_rows is None or bucket_rows(df, keys)[0] <= hot_rows:
        return None
    heavy = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows)
    heavy = heavy.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_rows")
    if heavy.isEmpty():
        return None
    return cut(heavy, "heavy-groups")


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def _apart(df: DataFrame, heavy: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    same = _same(df, heavy, [(k, f"_hot_{k}") for k in keys])
    return df.join(heavy, same, "left_anti"), df.join(heavy, same, "left_semi")


def _part_count(heavy: DataFrame, hot_rows: int) -> int:
    """Enough range partitions that one sorts about ``PART_ROWS`` rows, or a larger ``hot_rows``."""
    rows = heavy.agg(F.sum("_rows")).first()[0]
    usual = int(heavy.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, -(-rows // max(hot_rows, PART_ROWS)))


def _chunks(
    df: DataFrame, heavy: DataFrame, keys: list[str], order: list[Column], hot_rows: int
) -> DataFrame:
    """Rows in chunks of ``hot_rows`` at most, numbered in order.

    A range partition may hold many chunks, so small ones cost no tasks or files of their own.
    """
    grouped = [F.col(k).asc_nulls_last() for k in keys]
    spread = df.repartitionByRange(_part_count(heavy, hot_rows), *grouped, *order)
    placed = spread.sortWithinPartitions(*grouped, *order).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return cut(placed.withColumn("_chunk", F.col("_place") - row % hot_rows).drop("_place"), "chunks")


def _carry_in(chunked: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the carry of earlier chunks: at most one row per chunk, hence the broadcast."""
    renamed = carry.select(
        F.col("_chunk").alias("_carry_chunk"),
        *[F.col(k).alias(f"_carry_{k}") for k in keys],
        "_carry",
    )
    same = _same(chunked, renamed, [("_chunk", "_carry_chunk"), *[(k, f"_carry_{k}") for k in keys]])
    return chunked.join(F.broadcast(renamed), same, "left").drop(
        "_carry_chunk", *[f"_carry_{k}" for k in keys]
    )


def _window_sums(
    df: DataFrame, keys: list[str], order: list[Column], amount: Column, opening: str, closing: str
) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(*order)
    first = Window.unboundedPreceding
    return df.withColumns(
        {
            opening: F.coalesce(F.sum(amount).over(ordered.rowsBetween(first, -1)), F.lit(0)),
            closing: F.coalesce(
                F.sum(amount).over(ordered.rowsBetween(first, Window.currentRow)), F.lit(0)
            ),
        }
    )


def _chunked_sums(
    df: DataFrame,
    heavy: DataFrame,
    keys: list[str],
    order: list[Column],
    amount: Column,
    opening: str,
    closing: str,
    hot_rows: int,
) -> DataFrame:
    chunked = _chunks(df.withColumn("_amount", amount), heavy, keys, order, hot_rows)
    totals = chunked.groupBy("_chunk", *keys).agg(F.sum("_amount").alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("_carry", F.sum("_total").over(earlier)).filter(
        F.col("_carry").isNotNull()
    )
    local = _window_sums(chunked, ["_chunk", *keys], order, F.col("_amount"), "_open", "_close")
    carried = F.coalesce(F.col("_carry"), F.lit(0))
    return (
        _carry_in(local, carry, keys)
        .withColumn(opening, F.col("_open") + carried)
        .withColumn(closing, F.col("_close") + carried)
        .drop("_chunk", "_amount", "_open", "_close", "_carry")
    )


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    amount: Column,
    opening: str,
    closing: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the sum of ``amount`` over earlier rows, and up to and with the row itself.

    ``order`` must be total within a group.
    """
    heavy = heavy_groups(df, keys, hot_rows)
    if heavy is None:
        return _window_sums(df, keys, order, amount, opening, closing)
    rest, hot = _apart(df, heavy, keys)
    plain = _window_sums(rest, keys, order, amount, opening, closing)
    chunked = _chunked_sums(hot, heavy, keys, order, amount, opening, closing, hot_rows)
    kinds = {f.name: f.dataType for f in plain.schema.fields}
    return plain.unionByName(chunked.select(*[F.col(c).cast(t) for c, t in kinds.items()]))


def day_totals(df: DataFrame, keys: list[str], day: Column, amount: Column) -> DataFrame:
    """Rows and the sum of ``amount`` of each group's days, stored; combines before the shuffle."""
    by_day = df.groupBy(*keys, day.alias("_day")).agg(
        F.sum(amount).alias("_total"), F.count("*").alias("_rows")
    )
    return cut(by_day, "day-totals")


def running_sums_by_day(
    df: DataFrame,
    totals: DataFrame,
    keys: list[str],
    day: Column,
    order: list[Column],
    amount: Column,
    opening: str,
    closing: str,
) -> DataFrame:
    """As ``running_sums`` where ``order`` starts with a time: a day is summed alone, on top of
    what the days before it add up to.

    ``totals`` are the ``day_totals`` of the same rows. No task sorts or buffers more than
    days of a group, and nothing is stored for it but the totals.
    """
    earlier = Window.partitionBy(*keys).orderBy(F.col("_day").asc_nulls_last())
    carry = totals.withColumn(
        "_carry", F.sum("_total").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    ).select(*[F.col(k).alias(f"_carry_{k}") for k in [*keys, "_day"]], "_carry")
    whole = _window_sums(df, keys, order, amount, opening, closing).schema
    local = _window_sums(
        df.withColumn("_day", day), [*keys, "_day"], order, amount, "_open", "_close"
    )
    same = _same(local, carry, [(k, f"_carry_{k}") for k in [*keys, "_day"]])
    carried = F.coalesce(F.col("_carry"), F.lit(0))
    return local.join(carry, same, "left").select(
        *df.columns,
        (F.col("_open") + carried).cast(whole[opening].dataType).alias(opening),
        (F.col("_close") + carried).cast(whole[closing].dataType).alias(closing),
    )


def previous_value(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    value: str,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``value`` of the row before in the same group; NULL on the first."""

    def lagged(part: DataFrame, by: list[str]) -> DataFrame:
        return part.withColumn(name, F.lag(value).over(Window.partitionBy(*by).orderBy(*order)))

    heavy = heavy_groups(df, keys, hot_rows)
    if heavy is None:
        return lagged(df, keys)
    rest, hot = _apart(df, heavy, keys)
    chunked = _chunks(hot, heavy, keys, order, hot_rows)
    in_chunk = Window.partitionBy("_chunk", *keys).orderBy(*order)
    marked = lagged(chunked, ["_chunk", *keys]).withColumn("_row", F.row_number().over(in_chunk))
    last = marked.groupBy("_chunk", *keys).agg(F.max_by(value, "_row").alias("_last"))
    carry = last.withColumn(
        "_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk"))
    ).filter(F.col("_carry").isNotNull())
    joined = _carry_in(marked, carry, keys)
    filled = joined.withColumn(
        name, F.when(F.col("_row") == 1, F.col("_carry")).otherwise(F.col(name))
    )
    return lagged(rest, keys).unionByName(filled.drop("_chunk", "_row", "_carry"))
