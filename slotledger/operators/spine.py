"""Gap-free daily balances per store, slot and item.

A balance changes only on days with movements, so the work is done on intervals:
one row per change day that stands until the next one. Intervals are clipped to
calendar months, meet the item totals and the slot counts of that month as short
arrays indexed by the day, and unfold into days in the very last step. The daily
grid, by far the largest table, is never shuffled, sorted or joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotledger import schemas as S
from slotledger.functions import as_day, balance_tags, nulls_last, occupancy
from slotledger.operators.ids import with_global_starts
from slotledger.operators.joins import left_join_known
from slotledger.session import cut

Day = dt.date | str | Column | None

# Columns of a spine row, in the order readers expect.
SPINE_COLUMNS = [
    "id", "store_id", "slot_id", "item_id", "depositor_id", "moment_day", "store_name",
    "zone_name", "slot_name", "item_name", "depositor_inn", "depositor_name", "article",
    "product", "lot", "mfg_date", "expected_bin_qty", "open_slot_balance", "quantity",
    "close_slot_balance", "open_total_balance", "close_total_balance", "real_in", "move_in",
    "real_out", "move_out", "items_in_slot", "slot_balance_errors", "is_used",
]

_MONTH_DAYS = range(1, 32)
_COUNT_BITS = 21  # of a day's count, three of which share a number
_MOST_COUNTED = (1 << _COUNT_BITS) - 1
_FLOWS = ["quantity", *S.PARTS]
_PLACE = ["store_id", "slot_id"]

PART_ROWS = 16_384  # change days that one task takes on; each stands for up to some hundreds of days
HOT_PLACE_ROWS = 1_000_000  # a slot of more change days is dealt by item too
SENT_TOTALS = 32_768  # months of items, of some 600 bytes each, that every task may hold


def daily_movements(operations: DataFrame) -> DataFrame:
    """Movements summed per store, slot, item and day; combines before the shuffle."""
    return operations.groupBy("moment_day", *S.GRAIN).agg(
        *[F.sum(name).alias(name) for name in _FLOWS]
    )


def reportable(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Days the grid can show: up to the reporting day and of a known store."""
    return daily.filter((F.col("moment_day") <= as_day(as_of)) & F.col("store_id").isNotNull())


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY")))


def date_spine(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Every day from a grain's first movement to the reporting day."""
    first = daily.groupBy(*S.GRAIN).agg(F.min("moment_day").alias("seek_start"))
    # A grain that starts later has no days; a sequence would fail or run backwards.
    started = first.filter(F.col("seek_start") <= as_day(as_of))
    return started.select(_days(F.col("seek_start"), as_day(as_of)).alias("moment_day"), *S.GRAIN)


def _places_fit(rows: DataFrame, hot_rows: int, keys: list[str] = _PLACE) -> bool:
    """Whether each slot's rows may go to one task; goods off the slots count as one slot per store."""
    most = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).agg(F.max("_rows")).first()[0]
    return (most or 0) <= hot_rows


def _dealt(rows: DataFrame, keys: list[str], least: int = 1) -> DataFrame:
    """Rows dealt by ``keys`` into as many parts as it takes to bound what a part unfolds into.

    What follows by month, grain or day is then made where the rows lie, so the grid meets
    no shuffle and a task's share of it does not grow with the table. ``rows`` are counted
    and best come from a stored table.
    """
    usual = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(usual, least, -(-rows.count() // PART_ROWS)), *keys)


def by_place(rows: DataFrame, hot_rows: int = HOT_PLACE_ROWS) -> DataFrame:
    """Rows dealt by store and slot, or by grain where a slot has too many of them."""
    return _dealt(rows, _PLACE if _places_fit(rows, hot_rows) else S.GRAIN)


def _running(amount: str, keys: list[str], upto: int) -> Column:
    """Sum over a group's days; a group has at most one row per calendar day here."""
    frame = Window.partitionBy(*keys).orderBy("moment_day")
    return F.coalesce(
        F.sum(amount).over(frame.rowsBetween(Window.unboundedPreceding, upto)), F.lit(0)
    )


def item_totals(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Stock of each item over all slots on its change days, each standing to ``last_day``."""
    by_day = (
        reportable(daily, as_of)
        .groupBy("item_id", "moment_day")
        .agg(F.sum(F.col("real_in") + F.col("real_out")).alias("_real"))
    )
    following = F.lead("moment_day").over(Window.partitionBy("item_id").orderBy("moment_day"))
    return by_day.select(
        "item_id",
        F.col("moment_day").alias("first_day"),
        F.coalesce(F.date_sub(following, 1), as_day(as_of)).alias("last_day"),
        _running("_real", ["item_id"], -1).alias("open_total_balance"),
        _running("_real", ["item_id"], 0).alias("close_total_balance"),
    )


def _known_flows(daily: DataFrame) -> DataFrame:
    """Movements that a grain's days can show: a grain with a missing key has days, but no movements."""
    known = F.lit(True)
    for key in S.GRAIN:
        known = known & F.col(key).isNotNull()
    return daily.withColumns({name: F.when(known, F.col(name)) for name in _FLOWS})


def daily_balances_dense(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Balances on the whole grid, unused days included.

    Stretches of days are clipped to months, meet the item totals and unfold; the grid is
    neither sorted nor shuffled. ``daily`` is read more than once and best comes from a
    stored table.
    """
    stretches = balance_stretches(_known_flows(by_place(daily)), as_of)
    tiles = _with_totals(by_month(stretches), daily, as_of)
    # Slots are not counted here.
    days = unfold(tiles.withColumn("_counts", F.lit(None).cast("array<bigint>")))
    return days.select(
        "item_id", "moment_day", "store_id", "slot_id", "open_slot_balance", "close_slot_balance",
        *_FLOWS, "open_total_balance", "close_total_balance",
    )


def balance_stretches(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Stretches of days with one closing balance: from a change day to the day before the next.

    The first day carries the movements; on the others the balance only stands.
    """
    following = F.lead("moment_day").over(Window.partitionBy(*S.GRAIN).orderBy("moment_day"))
    return daily.filter(F.col("moment_day") <= as_day(as_of)).select(
        *S.GRAIN,
        F.col("moment_day").alias("first_day"),
        F.coalesce(F.date_sub(following, 1), as_day(as_of)).alias("last_day"),
        _running("quantity", S.GRAIN, -1).alias("open_slot_balance"),
        _running("quantity", S.GRAIN, 0).alias("close_slot_balance"),
        *[F.coalesce(name, F.lit(0)).alias(name) for name in _FLOWS],
    )


def balance_intervals(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Stretches of days with one closing balance, those with a free slot left out.

    With nothing left in the slot no more than the change day itself can count.
    """
    stretches = balance_stretches(reportable(daily, as_of), as_of)
    last = F.when(F.col("close_slot_balance") == 0, F.col("first_day")).otherwise(F.col("last_day"))
    return (
        stretches.withColumn("is_used", occupancy(F.col("close_slot_balance"), F.col("real_out")))
        .filter("is_used != 0")
        .withColumn("last_day", last)
    )


def occupancy_days(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Closing balance, real outflow and occupancy flag on the whole grid, free days included.

    Stretches are flagged as they unfold, so the grid is not shuffled. Goods of an unknown
    store have their days, but no movements. ``daily`` is read more than once and best comes
    from a stored table.
    """
    moved = by_place(daily).withColumns(
        {name: F.when(F.col("store_id").isNotNull(), F.col(name)) for name in _FLOWS}
    )
    days = balance_stretches(moved, as_of).withColumn(
        "moment_day", _days(F.col("first_day"), F.col("last_day"))
    )
    on_change = F.col("moment_day") == F.col("first_day")
    shown = days.withColumn("real_out", F.when(on_change, F.col("real_out")).otherwise(F.lit(0)))
    return shown.select(
        *S.GRAIN, "moment_day", "close_slot_balance", "real_out",
        occupancy(F.col("close_slot_balance"), F.col("real_out")).alias("is_used"),
    )


def number_intervals(intervals: DataFrame) -> DataFrame:
    """Number the days of all intervals in (store, slot, item, day) order.

    The days of an interval are neighbours in that order, so the row number of a
    day is the first number of its interval plus the days since it began.
    """
    width = F.datediff("last_day", "first_day") + 1
    return with_global_starts(intervals, nulls_last([*S.GRAIN, "first_day"]), width, "_first_id")


def by_month(intervals: DataFrame) -> DataFrame:
    """Clip intervals to calendar months: ``month``, ``from_day`` and ``to_day``."""
    months = F.sequence(
        F.trunc("first_day", "MM"), F.trunc("last_day", "MM"), F.expr("INTERVAL 1 MONTH")
    )
    return (
        intervals.withColumn("month", F.explode(months))
        .withColumn("from_day", F.greatest("first_day", "month"))
        .withColumn("to_day", F.least("last_day", F.last_day("month")))
    )


def slot_item_counts(tiles: DataFrame) -> DataFrame:
    """How many items each real slot holds on each day of a month, as an array of 31."""
    stocked = tiles.filter((F.col("close_slot_balance") > 0) & (F.col("slot_id") != S.OFF_SLOT))
    first, last = F.dayofmonth("from_day"), F.dayofmonth("to_day")
    held = [
        F.sum(F.when((first <= d) & (last >= d), 1).otherwise(0)).alias(f"_{d}")
        for d in _MONTH_DAYS
    ]
    counts = stocked.groupBy("store_id", "slot_id", "month").agg(*held)
    return counts.select(
        "store_id", "slot_id", "month",
        F.array(*[F.col(f"_{d}") for d in _MONTH_DAYS]).alias("_counts"),
    )


def item_totals_by_month(totals: DataFrame) -> DataFrame:
    """Opening and closing totals on each day of a month, as arrays of 31.

    At most one stretch per day, so at most 31 are gathered for an item and month.
    """
    stretch = F.struct(
        F.dayofmonth("from_day").alias("a"),
        F.dayofmonth("to_day").alias("b"),
        (F.col("from_day") == F.col("first_day")).alias("changes"),
        F.col("open_total_balance").alias("open"),
        F.col("close_total_balance").alias("close"),
    )
    gathered = by_month(totals).groupBy("item_id", "month").agg(
        F.collect_list(stretch).alias("_stretches")
    )
    # Each day lies in one stretch, which opens with its own figure on the day it changes.
    at = F.transform(
        F.sequence(F.lit(1), F.lit(31)),
        lambda d: F.get(
            F.filter("_stretches", lambda s: (s["a"] <= d) & (s["b"] >= d)), F.lit(0)
        ),
    )
    opens = F.transform(
        F.sequence(F.lit(1), F.lit(31)),
        lambda d: F.when(
            F.get("_at", d - 1)["changes"] & (F.get("_at", d - 1)["a"] == d),
            F.get("_at", d - 1)["open"],
        ).otherwise(F.get("_at", d - 1)["close"]),
    )
    return (
        gathered.withColumn("_at", at)
        .withColumn("_opens", opens)
        .select("item_id", "month", "_opens", F.col("_at.close").alias("_closes"))
    )


def _with_totals(tiles: DataFrame, daily: DataFrame, as_of: Day) -> DataFrame:
    """Item totals of a month beside each of its tiles.

    Totals are stored and counted. Up to ``SENT_TOTALS`` of them go to all tasks, whatever the
    session broadcasts by itself: by far the larger tiles stay where they were dealt, and so do
    the days they unfold into. Of more of them their size decides.
    """
    return _beside_totals(tiles, cut(item_totals_by_month(item_totals(daily, as_of)), "totals"))


def _beside_totals(tiles: DataFrame, totals: DataFrame) -> DataFrame:
    """Tiles with the item totals of their month, which are stored."""
    if totals.count() <= SENT_TOTALS:
        totals = F.broadcast(totals)
    return tiles.join(totals, ["item_id", "month"], "left")


def _with_counts(tiles: DataFrame) -> DataFrame:
    """Slot counts of a month beside each of its tiles, counted where the slot's tiles lie.

    Three days are counted in one number, so that rows are sorted and summed with eleven
    columns in place of 31; no slot has more than ``_MOST_COUNTED`` tiles.
    """
    stocked = (F.col("close_slot_balance") > 0) & (F.col("slot_id") != S.OFF_SLOT)
    month = Window.partitionBy(*_PLACE, "month")
    held = F.expr("shiftleft(1L, dayofmonth(to_day)) - shiftleft(1L, dayofmonth(from_day) - 1)")
    marked = tiles.withColumn("_held", F.when(stocked, held).otherwise(F.lit(0).cast("bigint")))

    def three(day: int) -> Column:
        bits = [
            F.shiftleft(F.shiftright("_held", day - 1 + place).bitwiseAND(F.lit(1)), place * _COUNT_BITS)
            for place in range(3)
        ]
        return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])

    summed = marked.withColumns(
        {f"_held_{day}": F.sum(three(day)).over(month) for day in _MONTH_DAYS[::3]}
    )
    counts = [
        F.shiftright(f"_held_{d - (d - 1) % 3}", (d - 1) % 3 * _COUNT_BITS).bitwiseAND(F.lit(_MOST_COUNTED))
        for d in _MONTH_DAYS
    ]
    shown = summed.withColumn("_counts", F.array(*counts))
    return shown.drop("_held", *[f"_held_{day}" for day in _MONTH_DAYS[::3]])


def month_tiles(
    daily: DataFrame,
    intervals: DataFrame,
    as_of: Day = None,
    hot_rows: int = HOT_PLACE_ROWS,
    slots: DataFrame | None = None,
) -> DataFrame:
    """Intervals clipped to months, with that month's slot counts and item totals.

    Intervals are dealt by slot once, and a slot's months are counted in its part. Where a
    slot has more than ``hot_rows`` of them, the counts are made apart and joined.
    ``intervals`` are read more than once and best come from a stored table.

    Names of ``slots``, if given, are attached before item totals are. Dealt by the slot
    alone, tiles meet them in their part: it is the directory that is shuffled.
    """
    most = min(hot_rows, _MOST_COUNTED)
    if slots is not None and _places_fit(intervals, most, ["slot_id"]):
        # With fewer parts than Spark's own shuffles have, it would deal the tiles again.
        usual = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        counted = _with_counts(by_month(_dealt(intervals, ["slot_id"], usual)))
        listed = _slot_names(slots).filter(F.col("slot_id") != S.OFF_SLOT).hint("shuffle_hash")
        return _with_totals(counted.join(listed, "slot_id", "left"), daily, as_of)
    if _places_fit(intervals, most):
        counted = _with_counts(by_month(_dealt(intervals, _PLACE)))
    else:
        tiles = by_month(_dealt(intervals, S.GRAIN))
        counted = left_join_known(
            tiles, slot_item_counts(tiles), ["store_id", "slot_id", "month"],
            F.col("slot_id") != S.OFF_SLOT, ["item_id", "from_day"],
        )
    named = counted if slots is None else _with_slots(counted, slots)
    return _with_totals(named, daily, as_of)


def _slot_names(slots: DataFrame) -> DataFrame:
    return slots.select("slot_id", "slot_name", "zone_name")


def _with_slots(tiles: DataFrame, slots: DataFrame) -> DataFrame:
    return left_join_known(
        tiles, _slot_names(slots), ["slot_id"], F.col("slot_id") != S.OFF_SLOT, ["item_id", "from_day"]
    )


def unfold(tiles: DataFrame) -> DataFrame:
    """One row per day of each tile: the only step that runs on the daily grid."""
    days = tiles.withColumn("moment_day", _days(F.col("from_day"), F.col("to_day")))
    place = F.dayofmonth("moment_day") - 1
    on_change = F.col("moment_day") == F.col("first_day")
    zero = F.lit(0)
    filled = {
        "open_slot_balance": F.when(on_change, F.col("open_slot_balance")).otherwise(
            F.col("close_slot_balance")
        ),
        **{name: F.when(on_change, F.col(name)).otherwise(zero) for name in _FLOWS},
        "open_total_balance": F.coalesce(F.get("_opens", place), zero),
        "close_total_balance": F.coalesce(F.get("_closes", place), zero),
        "items_in_slot": F.coalesce(F.get("_counts", place), zero),
    }
    if "_first_id" in tiles.columns:
        filled["id"] = F.col("_first_id") + F.datediff("moment_day", "first_day")
    spare = ["_opens", "_closes", "_counts", "_first_id", "month", "from_day", "to_day",
             "first_day", "last_day"]
    return days.withColumns(filled).drop(*spare)


def daily_balances(daily: DataFrame, as_of: Day = None) -> DataFrame:
    """Balances, occupancy and items per slot on every day a slot is used.

    ``daily`` is read more than once and best comes from a stored table.
    """
    intervals = cut(balance_intervals(daily, as_of), "intervals")
    return unfold(month_tiles(daily, intervals, as_of))


def enrich_tiles(
    tiles: DataFrame, items: DataFrame, slots: DataFrame | None, stores: DataFrame
) -> DataFrame:
    """Attach attributes while a row still stands for up to a month of days.

    Without ``slots`` the tiles have their names already.
    """
    named = tiles.join(
        items.select(
            "item_id", "depositor_id", F.col("name").alias("item_name"), "depositor_inn",
            "depositor_name", "article", "product", "lot", "mfg_date", "expected_bin_qty",
        ),
        "item_id",
        "left",
    )
    placed = named if slots is None else _with_slots(named, slots)
    return (
        placed.join(stores.select("store_id", F.col("name").alias("store_name")), "store_id", "left")
        .withColumn("slot_name", F.coalesce("slot_name", F.lit(S.OFF_SLOT)))
        .withColumn("zone_name", F.coalesce("zone_name", F.lit(S.OFF_ZONE)))
    )


def with_month_arrays(tiles: DataFrame, totals: DataFrame, counts: DataFrame | None) -> DataFrame:
    """Tiles stored without them, beside that month's item totals and slot counts.

    All tiles of an item, or of a slot, share the arrays of a month: kept in tables of their
    own they are stored once, and never travel with the tiles. ``counts`` may be left out for
    those who read none: then the tiles are not shuffled.
    """
    if counts is None:
        counted = tiles.withColumn("_counts", F.lit(None).cast("array<bigint>"))
    else:
        counted = left_join_known(
            tiles, counts, [*_PLACE, "month"], F.col("slot_id") != S.OFF_SLOT, ["item_id", "from_day"]
        )
    return _beside_totals(counted, totals)


def without_month_arrays(tiles: DataFrame) -> DataFrame:
    """The same tiles for those who read neither item totals nor slot counts: no join."""
    return tiles.withColumns(
        {name: F.lit(None).cast("array<bigint>") for name in ("_opens", "_closes", "_counts")}
    )


def spine_tiles(
    operations: DataFrame,
    items: DataFrame,
    slots: DataFrame,
    stores: DataFrame,
    as_of: Day = None,
) -> DataFrame:
    """The daily spine in its compact form: enriched, numbered month tiles; ``read_spine`` unfolds it."""
    daily = cut(daily_movements(operations), "daily")  # for balances and for item totals
    intervals = cut(number_intervals(balance_intervals(daily, as_of)), "intervals")
    tiles = month_tiles(daily, intervals, as_of, slots=slots)
    return enrich_tiles(tiles, items, None, stores)


def neighbours(tiles: DataFrame) -> DataFrame:
    """Tiles of an item and month next to one another within their part, for days that are to be stored.

    They share the totals of each day, which make up a large part of the stored days: repeated at a
    short distance they compress, and a writer meets the same few values again. Only tiles are
    sorted, where they lie.
    """
    return tiles.sortWithinPartitions("item_id", "month", *_PLACE, "from_day")


def read_spine(tiles: DataFrame, first_day: Day = None, last_day: Day = None) -> DataFrame:
    """Daily rows of stored tiles, optionally of some days only.

    The day bounds also skip whole months and tiles, before any of them unfolds.
    """
    return _spine_rows(_within(tiles, first_day, last_day)).select(*SPINE_COLUMNS)


def _within(tiles: DataFrame, first_day: Day, last_day: Day) -> DataFrame:
    """Tiles clipped to some days."""
    if first_day is not None:
        tiles = tiles.filter(F.col("month") >= F.trunc(as_day(first_day), "MM"))
        tiles = tiles.filter(F.col("to_day") >= as_day(first_day))
        tiles = tiles.withColumn("from_day", F.greatest("from_day", as_day(first_day)))
    if last_day is not None:
        tiles = tiles.filter(F.col("month") <= as_day(last_day))
        tiles = tiles.filter(F.col("from_day") <= as_day(last_day))
        tiles = tiles.withColumn("to_day", F.least("to_day", as_day(last_day)))
    return tiles


def _spine_rows(tiles: DataFrame) -> DataFrame:
    tags = balance_tags(
        F.col("items_in_slot"), F.col("close_slot_balance"), F.col("expected_bin_qty")
    )
    return unfold(tiles).withColumn("slot_balance_errors", tags)


def spine_days(tiles: DataFrame, days: DataFrame) -> DataFrame:
    """Spine rows of the grains and days listed, beside the other columns of ``days``.

    Each listed day meets the tile it lies in and only that day of it unfolds: the
    same rows as a join with the whole grid, without the grid. ``days`` may not hold
    a grain's day twice.
    """
    listed = days.withColumn("month", F.trunc("moment_day", "MM")).withColumnRenamed(
        "moment_day", "_day"
    )
    met = tiles.join(listed, [*S.GRAIN, "month"]).filter(
        F.col("_day").between(F.col("from_day"), F.col("to_day"))
    )
    clipped = met.withColumns({"from_day": F.col("_day"), "to_day": F.col("_day")}).drop("_day")
    shown = [c for c in days.columns if c not in SPINE_COLUMNS]
    return _spine_rows(clipped).select(*SPINE_COLUMNS, *shown)


def last_anomalous_day() -> Column:
    """The last day of a tile with stock and a balance anomaly; NULL without one.

    An unexpected balance lasts as long as its tile; a mixed slot is looked up in
    the month's counts.
    """
    close = F.col("close_slot_balance")
    mixed = F.filter(
        F.sequence(F.dayofmonth("from_day"), F.dayofmonth("to_day")),
        lambda day: F.get("_counts", day - 1) > 1,
    )
    return F.when((close > 0) & (close != F.col("expected_bin_qty")), F.col("to_day")).when(
        (close != 0) & F.col("_counts").isNotNull(), F.date_add("month", F.array_max(mixed) - 1)
    )


def daily_spine(
    operations: DataFrame,
    items: DataFrame,
    slots: DataFrame,
    stores: DataFrame,
    as_of: Day = None,
) -> DataFrame:
    """The enriched daily rows, straight from operations."""
    return read_spine(spine_tiles(operations, items, slots, stores, as_of))
