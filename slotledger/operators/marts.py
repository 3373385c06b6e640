"""Published tables. Bodies are unordered; ``ordered`` sorts for a reader.

Storing a total order would cost a global sort that no later reader can rely on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotledger.functions import nulls_last
from slotledger.operators.billing import slots_used_monthly
from slotledger.operators.spine import Day, item_totals, last_anomalous_day, read_spine

# Mart columns.
OPERATIONS_COLUMNS = [
    "id", "agent_name", "depositor_name", "item_name", "store_name", "slot_name", "doc_name",
    "moment_day", "doc_type", "op_type", "open_slot_balance", "quantity", "close_slot_balance",
    "open_total_balance", "close_total_balance", "real_in", "move_in", "real_out", "move_out",
    "uom", "expected_bin_qty", "slot_oper_errors", "moment", "article", "product", "lot",
    "mfg_date", "weight", "volume", "zone_name", "agent_inn", "depositor_inn",
]
BALANCE_DAILY_COLUMNS = [
    "id", "depositor_name", "item_name", "store_name", "slot_name", "moment_day",
    "open_slot_balance", "quantity", "close_slot_balance", "open_total_balance",
    "close_total_balance", "real_in", "move_in", "real_out", "move_out", "depositor_inn",
    "zone_name", "article", "product", "lot", "mfg_date",
]
BALANCE_NO_SLOTS_COLUMNS = [
    "depositor_name", "item_name", "moment_day", "open_total_balance", "real_quantity",
    "close_total_balance", "depositor_inn", "article", "product", "lot", "mfg_date",
]
PARTNER_COLUMNS = [
    "depositor_name", "depositor_inn", "article", "item_name", "product", "lot", "mfg_date",
    "doc_time", "doc_type", "doc_name", "open_balance", "quantity", "close_balance",
]
OPERATION_ERROR_COLUMNS = [
    "id_operations_with_balance__slot_item", "store_name", "slot_oper_errors", "moment_day",
    "doc_name", "doc_type", "op_type", "slot_name", "item_name", "open_slot_balance", "quantity",
    "close_slot_balance",
]
BALANCE_ERROR_COLUMNS = [
    "slot_item_daily_spine_id", "store_name", "slot_balance_errors", "moment_day", "slot_name",
    "item_name", "close_slot_balance", "expected_bin_qty",
]
# The order readers get the rows in.
READING_ORDER = {
    "operations": [
        "agent_name", "depositor_name", "item_name", "store_name", "slot_name", "moment",
    ],
    "balance_daily": ["item_name", "store_name", "slot_name", "moment_day"],
    "balance_daily_no_slots": ["item_name", "moment_day"],
    "slots_used_daily": ["depositor_name", "moment_day"],
    "partner_movements": ["depositor_name", "item_name", "doc_time"],
    "operation_errors": ["slot_oper_errors", "moment_day", "slot_name"],
    "balance_errors": ["slot_balance_errors", "slot_name"],
    "slots_used_monthly": ["depositor_name", "moment_month"],
}
# Tie-breaks after them. Rows that tie all land in one sort task, however many they are.
TIE_BREAK = {
    "operations": ["id"],
    "balance_daily": ["id"],
    "balance_daily_no_slots": ["depositor_name", "open_total_balance", "close_total_balance"],
    "operation_errors": ["id_operations_with_balance__slot_item"],
    "balance_errors": ["slot_item_daily_spine_id"],
    "partner_movements": ["doc_name", "doc_type", "open_balance", "quantity"],
}


def ordered(mart: DataFrame, name: str) -> DataFrame:
    """The mart's rows in its reading order, NULLs last."""
    return mart.orderBy(*nulls_last(READING_ORDER[name] + TIE_BREAK.get(name, [])))


def operations_mart(operations: DataFrame) -> DataFrame:
    return operations.select(*OPERATIONS_COLUMNS)


def balance_daily(spine: DataFrame) -> DataFrame:
    return spine.select(*BALANCE_DAILY_COLUMNS)


def balance_daily_no_slots(spine: DataFrame) -> DataFrame:
    """Item and day without slots, from daily rows.

    Texts are keys of a first aggregate, which so hashes the daily rows; their largest
    is taken of what that leaves, mostly one row per item and day.
    """
    texts = ["depositor_name", "item_name", "depositor_inn", "article", "product", "lot", "mfg_date"]
    totals = [F.max(name).alias(name) for name in ("open_total_balance", "close_total_balance")]
    by_text = spine.groupBy("item_id", "moment_day", *texts).agg(
        *totals, F.sum(F.col("real_in") + F.col("real_out")).alias("real_quantity")
    )
    return (
        by_text.groupBy("item_id", "moment_day")
        .agg(*[F.max(name).alias(name) for name in texts], *totals, F.sum("real_quantity").alias("real_quantity"))
        .select(*BALANCE_NO_SLOTS_COLUMNS)
    )


def balance_daily_no_slots_from_intervals(
    daily: DataFrame, intervals: DataFrame, items: DataFrame, as_of: Day = None
) -> DataFrame:
    """The same rollup without the daily grid.

    Per item and day it sums what begins, what ends and what moved. Running over
    the days this tells on which of them any slot holds the item; the totals
    stand between changes. Only item days unfold, not slot days.
    """
    zero = F.lit(0)
    begins = intervals.select(
        "item_id",
        F.col("first_day").alias("day"),
        F.lit(1).alias("step"),
        (F.col("real_in") + F.col("real_out")).alias("real"),
    )
    ends = intervals.select(
        "item_id", F.date_add("last_day", 1).alias("day"), F.lit(-1).alias("step")
    )
    # An item has one row per change day in its totals, so max merely picks it.
    changes = item_totals(daily, as_of).select(
        "item_id",
        F.col("first_day").alias("day"),
        F.col("open_total_balance").alias("opens"),
        F.col("close_total_balance").alias("closes"),
    )
    points = (
        begins.unionByName(ends, allowMissingColumns=True)
        .unionByName(changes, allowMissingColumns=True)
        .groupBy("item_id", "day")
        .agg(
            F.sum("step").alias("step"),
            F.sum("real").alias("real"),
            F.max("opens").alias("opens"),
            F.max("closes").alias("closes"),
        )
    )
    by_item = Window.partitionBy("item_id").orderBy("day")
    upto = by_item.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stretches = points.select(
        "item_id",
        F.col("day").alias("first_day"),
        F.date_sub(F.lead("day").over(by_item), 1).alias("last_day"),
        F.sum("step").over(upto).alias("holders"),
        F.coalesce("real", zero).alias("real"),
        "opens",
        F.last("closes", ignorenulls=True).over(upto).alias("closes"),
    ).filter("holders > 0")
    described = stretches.join(items.withColumnRenamed("name", "item_name"), "item_id", "left")
    days = described.withColumn(
        "moment_day", F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY")))
    )
    on_change = F.col("moment_day") == F.col("first_day")
    opening = F.when(on_change, F.coalesce("opens", "closes")).otherwise(F.col("closes"))
    return days.withColumns(
        {
            "open_total_balance": F.coalesce(opening, zero),
            "close_total_balance": F.coalesce("closes", zero),
            "real_quantity": F.when(on_change, F.col("real")).otherwise(zero),
        }
    ).select(*BALANCE_NO_SLOTS_COLUMNS)


def partner_movements(operations: DataFrame) -> DataFrame:
    """Receipts and shipments with item balances; moves left their balances untouched."""
    return (
        operations.filter("doc_type != 'move'")
        .withColumnsRenamed(
            {
                "moment": "doc_time",
                "open_total_balance": "open_balance",
                "close_total_balance": "close_balance",
            }
        )
        .select(*PARTNER_COLUMNS)
    )


def operation_errors(operations: DataFrame) -> DataFrame:
    return (
        operations.filter("slot_oper_errors != ''")
        .withColumnRenamed("id", "id_operations_with_balance__slot_item")
        .select(*OPERATION_ERROR_COLUMNS)
    )


def balance_errors(spine: DataFrame) -> DataFrame:
    """Balance anomalies of the last day that has any."""
    errors = (
        spine.filter("slot_balance_errors != '' AND close_slot_balance != 0")
        .withColumnRenamed("id", "slot_item_daily_spine_id")
        .select(*BALANCE_ERROR_COLUMNS)
    )
    last_day = errors.agg(F.max("moment_day")).scalar()
    return errors.filter(F.col("moment_day") == last_day)


def balance_errors_from_tiles(tiles: DataFrame) -> DataFrame:
    """The same from stored tiles: only the day in question is unfolded."""
    last_day = tiles.agg(F.max(last_anomalous_day())).first()[0]
    if last_day is None:
        return balance_errors(read_spine(tiles.limit(0)))
    return balance_errors(read_spine(tiles, last_day, last_day))


__all__ = [
    "balance_daily", "balance_daily_no_slots", "balance_daily_no_slots_from_intervals",
    "balance_errors", "balance_errors_from_tiles", "operation_errors", "operations_mart", "ordered", "partner_movements",
    "slots_used_monthly",
]
