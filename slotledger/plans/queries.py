"""Registered queries over the sample tables, each with its SQL counterpart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger import schemas as S
from slotledger.functions import exact_number, loses_digits, movement_parts
from slotledger.operators import billing, bronze, ledger, marts, quality, spine, upsert
from slotledger.operators.bronze import time_literal
from slotledger.operators.ids import with_global_ids
from slotledger.plans.balance_book import BalanceBook
from slotledger.plans.oracle import DAILY, on_both, on_ledger, on_operations, on_spine
from slotledger.plans.pipeline import Warehouse
from slotledger.plans.sample_ledger import AS_OF, POSTING_ORDER, SampleLedger, text
from slotledger.session import cut, scratch_path
from slotledger.sources.raw import read_landing, tag
from slotledger.sources.tables import Changes, TableStore
from slotledger.streaming import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CUTOVER = "2024-01-15 00:00:00"  # splits the events into a stored part and a later batch
_DOC = "doc_id, applicable, moment, number, agent_id, store_id, item_id, quantity, slot_id"


def query(sql: str | None = None):
    """Register a function of a ``SampleLedger`` under its own name."""

    def register(build: Callable[[SampleLedger], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(SampleLedger(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def _daily(sample: SampleLedger) -> DataFrame:
    return spine.daily_movements(sample.movements())


def _stored_daily(sample: SampleLedger) -> DataFrame:
    """For queries that read the daily movements more than once."""
    return cut(_daily(sample), "daily")


def _tiles(sample: SampleLedger) -> DataFrame:
    return spine.spine_tiles(
        sample.movements(), sample.items(), sample.slots(), sample.stores(), AS_OF
    )


def _spine(sample: SampleLedger) -> DataFrame:
    return spine.read_spine(_tiles(sample))


def _whole_spine(sample: SampleLedger) -> DataFrame:
    """For queries that give all daily rows."""
    return spine.read_spine(spine.neighbours(_tiles(sample)))


# --- the ledger ------------------------------------------------------------

@query(on_ledger("SELECT * FROM operations_all"))
def unify_operations(sample):
    return sample.operations_all()


@query(on_ledger(f"SELECT {_DOC}, doc_type, op_type FROM united"))
def union_documents(sample):
    united = ledger.union_documents(list(sample.documents().values()))
    return united.select(*_DOC.split(", "), "doc_type", "op_type")


@query(on_ledger(f"SELECT {_DOC}, doc_type, op_type FROM united WHERE doc_type = 'move'"))
def move_fan_out(sample):
    moves = sample.legs(sample.base().filter("doc_type = 'move'"))
    return moves.select(*_DOC.split(", "), "doc_type", "op_type")


@query(on_ledger("SELECT * FROM audit_latest"))
def latest_status(sample):
    return ledger.latest_status(*sample.audit_sides())


@query("""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY item_id) AS BIGINT) AS id, *
FROM (
  SELECT variant_id AS item_id, p_partkey AS depositor_id, p_size * CAST(10 AS DOUBLE)
           AS expected_bin_qty,
         p_name || ' (' || lot || ', ' || ifnull(mfg_date, '') || ')' AS name,
         first_ship AS updated, p_name AS product, lot, mfg_date, p_type AS article,
         CAST(p_size AS DOUBLE) AS weight, p_retailprice AS volume, r_name AS uom,
         c_name AS depositor_name, c_mktsegment AS depositor_inn
  FROM (SELECT l_partkey, CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
                 AS variant_id, 'L' || l_suppkey AS lot, MIN(l_shipdate) AS first_ship,
               CASE WHEN MIN(l_shipdate) >= TIMESTAMP '1999-01-01'
                    THEN strftime(MIN(l_shipdate), '%Y-%m-%d') END AS mfg_date
        FROM lineitem GROUP BY l_partkey, l_suppkey) lots
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN region ON r_regionkey = p_size % 7
  LEFT JOIN customer ON c_custkey = p_partkey
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_partkey, p_size * CAST(10 AS DOUBLE), p_name, NULL, NULL,
         NULL, NULL, p_type, CAST(p_size AS DOUBLE), p_retailprice, r_name, c_name, c_mktsegment
  FROM part
  LEFT JOIN region ON r_regionkey = p_size % 7
  LEFT JOIN customer ON c_custkey = p_partkey
) both_kinds""")
def items_dim(sample):
    return ledger.items(
        sample.product_lots(), sample.products(), sample.uoms(), sample.agents()
    )


@query(on_ledger("""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY slot_id) AS BIGINT) AS id, * FROM slots_all"""))
def slots_dim(sample):
    return ledger.slots(sample.slot_directory(), sample.zones())


@query(on_ledger("SELECT * FROM ops"))
def filter_operations(sample):
    return sample.operations()


@query(on_ledger("""
SELECT id, doc_type, quantity, moment_day, real_in, real_out, move_in, move_out FROM split"""))
def split_movements(sample):
    return sample.split().select(
        "id", "doc_type", "quantity", "moment_day", "real_in", "real_out", "move_in", "move_out"
    )


@query(on_operations("""
SELECT id, store_id, slot_id, item_id, moment, quantity, open_slot_balance, close_slot_balance
FROM balanced"""))
def slot_running_balance(sample):
    return ledger.slot_running_balance(sample.operations()).select(
        "id", *S.GRAIN, "moment", "quantity", "open_slot_balance", "close_slot_balance"
    )


@query(on_operations("""
SELECT id, item_id, moment, real_in, real_out, open_total_balance, close_total_balance
FROM balanced"""))
def item_running_balance(sample):
    return ledger.item_running_balance(sample.split()).select(
        "id", "item_id", "moment", "real_in", "real_out",
        "open_total_balance", "close_total_balance",
    )


HOT = 500  # a group of more rows is cut into chunks


@query(on_operations("""
SELECT id, store_id, slot_id, item_id, open_slot_balance, close_slot_balance, open_total_balance,
       close_total_balance
FROM balanced"""))
def chunked_running_balances(sample):
    """Both balances with groups cut into chunks, as very large groups are."""
    balanced = ledger.running_balances(sample.split(), HOT)
    return balanced.select(
        "id", *S.GRAIN, "open_slot_balance", "close_slot_balance", "open_total_balance",
        "close_total_balance",
    )


@query(on_operations("SELECT * FROM opsb"))
def enrich_operations(sample):
    return sample.operations_with_balance()


# --- the daily grid --------------------------------------------------------

# Columns of the grid.
_BALANCES = [
    "open_slot_balance", "quantity", "close_slot_balance", "open_total_balance",
    "close_total_balance", "real_in", "move_in", "real_out", "move_out",
]


def _months(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """A daily grid month by month, so that it can be compared at any size: how many days, and
    of each number the sum and the sum weighted by the day of the month. Texts are among the keys."""
    day = F.dayofmonth("moment_day")
    return rows.groupBy(*keys, F.trunc("moment_day", "month").alias("month")).agg(
        F.count("*").alias("days"),
        F.sum(day).cast("double").alias("day"),
        *[F.sum(F.col(c).cast("double")).alias(c) for c in sums],
        *[F.sum(F.col(c).cast("double") * day).alias(f"{c}_dated") for c in sums],
    )


def _months_sql(rows: str, keys: list[str], sums: list[str]) -> str:
    both = [f"SUM(CAST({c} AS DOUBLE)) AS {c}, SUM(CAST({c} AS DOUBLE) * day(moment_day)) AS {c}_dated" for c in sums]
    shown = ", ".join([
        *keys, "CAST(date_trunc('month', moment_day) AS DATE) AS month", "COUNT(*) AS days",
        "CAST(SUM(day(moment_day)) AS DOUBLE) AS day", *both,
    ])
    return f"SELECT {shown} FROM {rows} GROUP BY {', '.join(keys)}, date_trunc('month', moment_day)"


@query(on_spine("SELECT * FROM daily"))
def daily_movements(sample):
    return _daily(sample)


@query(on_spine("SELECT * FROM grid"))
def date_spine(sample):
    return spine.date_spine(_daily(sample), AS_OF)


@query(on_spine(_months_sql("dense", S.GRAIN, _BALANCES)))
def daily_balances_dense(sample):
    return _months(spine.daily_balances_dense(_stored_daily(sample), AS_OF), S.GRAIN, _BALANCES)


@query(on_spine(_months_sql("counted WHERE is_used > 0", S.GRAIN, [*_BALANCES, "is_used", "items_in_slot"])))
def daily_balances_interval(sample):
    rows = spine.daily_balances(_stored_daily(sample), AS_OF)
    return _months(rows, S.GRAIN, [*_BALANCES, "is_used", "items_in_slot"])


@query(on_spine(_months_sql("counted", S.GRAIN, ["close_slot_balance", "real_out", "is_used"])))
def occupancy_flag(sample):
    rows = spine.occupancy_days(_stored_daily(sample), AS_OF)
    return _months(rows, S.GRAIN, ["close_slot_balance", "real_out", "is_used"])


@query(on_spine("""
SELECT store_id, slot_id, moment_day, COUNT(*) AS items_in_slot
FROM counted WHERE close_slot_balance > 0 AND slot_id <> 'off_slot' GROUP BY ALL"""))
def items_in_slot(sample):
    tiles = spine.by_month(spine.balance_intervals(_daily(sample), AS_OF))
    counts = spine.slot_item_counts(tiles).select(
        "store_id", "slot_id", "month", F.posexplode("_counts").alias("place", "items_in_slot")
    )
    return counts.filter("items_in_slot > 0").select(
        "store_id", "slot_id", F.date_add("month", F.col("place")).alias("moment_day"),
        "items_in_slot",
    )


_TAGGED = ["store_id", "slot_id", "item_id", "slot_balance_errors"]


@query(on_spine(_months_sql(
    "spine WHERE slot_balance_errors <> ''", [*_TAGGED, "expected_bin_qty"], ["id", "items_in_slot", "close_slot_balance"]
)))
def balance_anomalies(sample):
    rows = _spine(sample).filter("slot_balance_errors != ''")
    return _months(rows, [*_TAGGED, "expected_bin_qty"], ["id", "items_in_slot", "close_slot_balance"])


@query(on_spine("SELECT * FROM spine"))
def spine_enriched(sample):
    return _whole_spine(sample)


@query(on_ledger("""
, lots AS (
  SELECT * REPLACE (l_partkey || '-' || l_suppkey AS item_id, coalesce(slot_id, 'off_slot') AS slot_id),
         IF(doc_type = 'move', 0, quantity) AS real
  FROM united
), numbered AS (
  SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY doc_id, item_id, op_type, number, l_partkey, l_suppkey,
                                    l_extendedprice, quantity, doc_type, moment, slot_id, agent_id)
                 AS BIGINT) AS id
  FROM lots
), summed AS (
  SELECT *, SUM(quantity) OVER (PARTITION BY store_id, slot_id, item_id ORDER BY moment, id
                                ROWS UNBOUNDED PRECEDING) AS close_slot_balance,
         SUM(real) OVER (PARTITION BY item_id ORDER BY moment, id ROWS UNBOUNDED PRECEDING)
           AS close_total_balance
  FROM numbered)
SELECT id, item_id, slot_id, store_id, moment, close_slot_balance - quantity AS open_slot_balance,
       close_slot_balance, close_total_balance - real AS open_total_balance, close_total_balance
FROM summed"""))
def lot_balances(sample):
    """Slot and item balances of every posting, with the lots of parts as items."""
    postings = sample.legs(sample.base()).withColumns(
        {
            "item_id": F.concat_ws("-", text("l_partkey"), text("l_suppkey")),
            "slot_id": F.coalesce("slot_id", F.lit(S.OFF_SLOT)),
        }
    )
    numbered = with_global_ids(
        postings, [F.col(c).asc_nulls_last() for c in POSTING_ORDER],
        keep=["item_id", "slot_id", "store_id", "moment", "quantity", "doc_type"],
    )
    return ledger.split_movements(ledger.running_balances(numbered)).select(
        "id", "item_id", "slot_id", "store_id", "moment", "open_slot_balance",
        "close_slot_balance", "open_total_balance", "close_total_balance",
    )


# Lots as items; every fiftieth order with double quantities, every seventieth withdrawn.
_EDITED_LOTS = """
, sent AS (
  SELECT * REPLACE (l_partkey || '-' || l_suppkey AS item_id, coalesce(slot_id, 'off_slot') AS slot_id,
                    IF(doc_id % 50 = 0, 2, 1) * quantity AS quantity)
  FROM united WHERE doc_id % 70 <> 0 OR doc_id % 50 = 0
), split_lots AS (
  SELECT *, CAST(moment AS DATE) AS moment_day, IF(doc_type = 'move', 0, quantity) AS real,
         CASE WHEN doc_type <> 'move' AND quantity < 0 THEN quantity ELSE 0 END AS real_out
  FROM sent
)"""


def _edited_book(sample: SampleLedger) -> BalanceBook:
    """Balances of all lots, then the edits."""
    columns = ["doc_id", "moment", "item_id", "slot_id", "store_id", "quantity", *[c for c in POSTING_ORDER if c not in (
        "doc_id", "moment", "item_id", "slot_id", "quantity")]]
    lots = sample.legs(sample.base()).withColumns(
        {
            "item_id": F.concat_ws("-", text("l_partkey"), text("l_suppkey")),
            "slot_id": F.coalesce("slot_id", F.lit(S.OFF_SLOT)),
        }
    ).select(*columns)
    store = TableStore(sample.spark, scratch_path(sample.spark, "warehouse"))
    book = BalanceBook(store, POSTING_ORDER, AS_OF)
    book.build(lots)
    doubled = (F.col("doc_id") % 50) == 0
    edits = lots.filter(doubled | (F.col("doc_id") % 70 == 0))
    again = edits.filter(doubled).withColumn("quantity", 2 * F.col("quantity"))
    book.edit(edits.select("doc_id").distinct(), again)
    return book


@query(on_ledger(_EDITED_LOTS + """
, placed AS (
  SELECT *, row_number() OVER (ORDER BY moment, doc_id, item_id, op_type, number, l_partkey, l_suppkey,
                               l_extendedprice, quantity, doc_type, slot_id, agent_id) AS place
  FROM split_lots
), summed AS (
  SELECT *, SUM(quantity) OVER (PARTITION BY store_id, slot_id, item_id ORDER BY place) AS close_slot_balance,
         SUM(real) OVER (PARTITION BY item_id ORDER BY place) AS close_total_balance
  FROM placed)
SELECT doc_id, item_id, slot_id, store_id, moment, number, op_type, quantity,
       close_slot_balance - quantity AS open_slot_balance, close_slot_balance,
       close_total_balance - real AS open_total_balance, close_total_balance
FROM summed"""))
def balances_after_edits(sample):
    """Balances of every posting after edits, without a rebuild."""
    return _edited_book(sample).read("operations").select(
        "doc_id", "item_id", "slot_id", "store_id", "moment", "number", "op_type", "quantity", "open_slot_balance",
        "close_slot_balance", "open_total_balance", "close_total_balance",
    )


@query(on_ledger(_EDITED_LOTS + """
, by_day AS (
  SELECT store_id, slot_id, item_id, moment_day, SUM(quantity) AS quantity, SUM(real_out) AS real_out
  FROM split_lots GROUP BY ALL
), changes AS (
  SELECT *, SUM(quantity) OVER (PARTITION BY store_id, slot_id, item_id ORDER BY moment_day) AS balance,
         LEAD(moment_day) OVER (PARTITION BY store_id, slot_id, item_id ORDER BY moment_day) AS following
  FROM by_day
), item_days AS (
  SELECT item_id, moment_day, SUM(SUM(real)) OVER (PARTITION BY item_id ORDER BY moment_day) AS total
  FROM split_lots GROUP BY item_id, moment_day)
SELECT store_id, slot_id, item_id, moment_day AS first_day,
       CASE WHEN balance = 0 THEN moment_day ELSE coalesce(following - 1, DATE '2001-12-31') END AS last_day,
       balance AS close_balance
FROM changes WHERE balance <> 0 OR real_out <> 0
UNION ALL
SELECT NULL, NULL, item_id, moment_day,
       coalesce(LEAD(moment_day) OVER (PARTITION BY item_id ORDER BY moment_day) - 1, DATE '2001-12-31'), total
FROM item_days"""))
def stretches_after_edits(sample):
    """Stretches of days with one balance, of slots and of items, after edits."""
    book = _edited_book(sample)
    slots = book.read("intervals").select(
        *S.GRAIN, "first_day", "last_day", F.col("close_slot_balance").alias("close_balance")
    )
    items = book.read("item_totals").select(
        F.lit(None).cast(slots.schema["store_id"].dataType).alias("store_id"),
        F.lit(None).cast("string").alias("slot_id"),
        "item_id", "first_day", "last_day", F.col("close_total_balance").alias("close_balance"),
    )
    return slots.unionByName(items)


# --- billing and marts -----------------------------------------------------

def _used(sample: SampleLedger) -> DataFrame:
    return billing.slots_used_daily(
        spine.balance_intervals(_daily(sample), AS_OF), sample.items()
    )


@query(on_spine("SELECT * FROM used_daily"))
def slots_used_daily(sample):
    return _used(sample)


@query(on_spine("SELECT * FROM used_daily"))
def slots_used_daily_from_spine(sample):
    return billing.slots_used_daily_from_spine(_spine(sample))


_MONTHLY = on_spine("""
SELECT MAX(depositor_name) AS depositor_name, strftime(moment_day, '%Y-%m') AS moment_month,
       CAST(SUM(slots_used_day) AS BIGINT) AS slots_used_month
FROM used_daily GROUP BY depositor_id, strftime(moment_day, '%Y-%m')""")


@query(_MONTHLY)
def slots_used_monthly(sample):
    return marts.ordered(billing.slots_used_monthly(_used(sample)), "slots_used_monthly")


@query(on_operations(f"SELECT {', '.join(marts.OPERATIONS_COLUMNS)} FROM opsb"))
def mart_operations(sample):
    return marts.ordered(marts.operations_mart(sample.operations_with_balance()), "operations")


@query(on_spine(f"SELECT {', '.join(marts.BALANCE_DAILY_COLUMNS)} FROM spine"))
def mart_balance_daily(sample):
    return marts.balance_daily(_whole_spine(sample))


_NO_SLOTS = on_spine("""
SELECT MAX(depositor_name) AS depositor_name, MAX(item_name) AS item_name, moment_day,
       MAX(open_total_balance) AS open_total_balance, SUM(real_in + real_out) AS real_quantity,
       MAX(close_total_balance) AS close_total_balance, MAX(depositor_inn) AS depositor_inn,
       MAX(article) AS article, MAX(product) AS product, MAX(lot) AS lot,
       MAX(mfg_date) AS mfg_date
FROM spine GROUP BY item_id, moment_day""")


@query(_NO_SLOTS)
def mart_balance_no_slots(sample):
    daily = _stored_daily(sample)
    intervals = cut(spine.balance_intervals(daily, AS_OF), "intervals")
    rows = marts.balance_daily_no_slots_from_intervals(daily, intervals, sample.items(), AS_OF)
    return marts.ordered(rows, "balance_daily_no_slots")


@query(on_spine("""
SELECT item_name, strftime(moment_day, '%Y-%m') AS moment_month, CAST(COUNT(*) AS BIGINT) AS days,
       SUM(real_quantity) AS real_quantity
FROM (SELECT MAX(item_name) AS item_name, moment_day, SUM(real_in + real_out) AS real_quantity
      FROM spine GROUP BY item_id, moment_day) v
GROUP BY item_name, strftime(moment_day, '%Y-%m')"""))
def published_view(sample):
    """The rollup published as a view, stored nowhere, and read by its name."""
    daily = _stored_daily(sample)
    intervals = cut(spine.balance_intervals(daily, AS_OF), "intervals")
    rows = marts.balance_daily_no_slots_from_intervals(daily, intervals, sample.items(), AS_OF)
    store = TableStore(sample.spark, scratch_path(sample.spark, "warehouse"))
    store.view(rows, "warehouse_balance_daily_no_slots")
    return sample.spark.sql(
        "SELECT item_name, date_format(moment_day, 'yyyy-MM') AS moment_month, COUNT(*) AS days, "
        "SUM(real_quantity) AS real_quantity FROM warehouse_balance_daily_no_slots GROUP BY ALL"
    )


@query(on_spine("""
, changes AS (
  SELECT store_id, slot_id, item_id, moment_day, real_out,
         SUM(quantity) OVER (PARTITION BY store_id, slot_id, item_id ORDER BY moment_day) AS balance,
         LEAD(moment_day) OVER (PARTITION BY store_id, slot_id, item_id ORDER BY moment_day) AS following
  FROM daily)
SELECT store_id, slot_id, item_id, moment_day AS first_day, balance AS close_slot_balance,
       CASE WHEN balance = 0 THEN moment_day ELSE coalesce(following - 1, current_date) END AS last_day
FROM changes WHERE balance <> 0 OR real_out <> 0"""))
def balances_to_today(sample):
    """Without a reporting day, balances stand until the day of the clock."""
    return spine.balance_intervals(_stored_daily(sample)).select(
        *S.GRAIN, "first_day", "last_day", "close_slot_balance"
    )


@query(_NO_SLOTS)
def mart_balance_no_slots_from_spine(sample):
    return marts.balance_daily_no_slots(_spine(sample))


@query(on_spine("SELECT * FROM used_daily"))
def mart_slots_used_daily(sample):
    return marts.ordered(_used(sample), "slots_used_daily")


@query(on_operations("""
SELECT depositor_name, depositor_inn, article, item_name, product, lot, mfg_date,
       moment AS doc_time, doc_type, doc_name, open_total_balance AS open_balance, quantity,
       close_total_balance AS close_balance
FROM opsb WHERE doc_type <> 'move'"""))
def mart_partner_movements(sample):
    return marts.ordered(
        marts.partner_movements(sample.operations_with_balance()), "partner_movements"
    )


@query(on_operations("""
SELECT id AS id_operations_with_balance__slot_item, store_name, slot_oper_errors, moment_day,
       doc_name, doc_type, op_type, slot_name, item_name, open_slot_balance, quantity,
       close_slot_balance
FROM opsb WHERE slot_oper_errors <> ''"""))
def mart_operation_errors(sample):
    return marts.ordered(
        marts.operation_errors(sample.operations_with_balance()), "operation_errors"
    )


@query(on_spine("""
SELECT id AS slot_item_daily_spine_id, store_name, slot_balance_errors, moment_day, slot_name,
       item_name, close_slot_balance, expected_bin_qty
FROM spine
WHERE slot_balance_errors <> '' AND close_slot_balance <> 0
  AND moment_day = (SELECT MAX(moment_day) FROM spine
                    WHERE slot_balance_errors <> '' AND close_slot_balance <> 0)"""))
def mart_balance_errors(sample):
    return marts.ordered(marts.balance_errors_from_tiles(_tiles(sample)), "balance_errors")


# --- data quality ----------------------------------------------------------

_SPINE_CHECK_SQL = """
SELECT 'spine_arithmetic' AS check_name, COUNT(*) AS violations FROM s
  WHERE close_slot_balance <> open_slot_balance + quantity
UNION ALL SELECT 'spine_flag_domain', COUNT(*) FROM s WHERE is_used NOT IN (1, 2)
UNION ALL SELECT 'spine_move_signs', COUNT(*) FROM s WHERE move_in < 0 OR move_out > 0
UNION ALL SELECT 'spine_negative_flag', COUNT(*) FROM s WHERE close_slot_balance < 0 AND is_used <> 2
UNION ALL SELECT 'spine_duplicate_grain', COUNT(*) FROM
  (SELECT 1 FROM s GROUP BY store_id, slot_id, item_id, moment_day HAVING COUNT(*) > 1) g
UNION ALL SELECT 'spine_future_days', COUNT(*) FROM s WHERE moment_day > DATE '2001-12-31'
UNION ALL SELECT 'spine_day_continuity', COUNT(*) FROM s n JOIN s p
  ON n.store_id = p.store_id AND n.slot_id = p.slot_id AND n.item_id = p.item_id
  AND n.moment_day = p.moment_day + 1 WHERE n.open_slot_balance <> p.close_slot_balance
UNION ALL SELECT 'spine_parts_sum', COUNT(*) FROM s
  WHERE quantity <> real_in + real_out + move_in + move_out
UNION ALL SELECT 'spine_total_per_day', COUNT(*) FROM
  (SELECT 1 FROM s GROUP BY item_id, moment_day HAVING COUNT(DISTINCT close_total_balance) > 1) t
UNION ALL SELECT 'spine_unused_rows', COUNT(*) FROM s WHERE is_used = 0"""


@query(on_spine("SELECT * FROM (WITH s AS (SELECT * FROM spine) " + _SPINE_CHECK_SQL + ") c"))
def dq_spine_invariants(sample):
    """The checks hold on the real spine: every count is zero."""
    return quality.tile_counts(_tiles(sample), AS_OF)


@query(on_spine("""
SELECT * FROM (WITH s AS (
  SELECT * REPLACE (
    IF(real_in > 40, quantity + 1, quantity) AS quantity,
    IF(day(moment_day) = 13 AND close_slot_balance < 0, 0, is_used) AS is_used,
    IF(items_in_slot > 4, -1 * move_in - 1, move_in) AS move_in,
    IF(slot_id = 'off_slot' AND day(moment_day) = 1, moment_day + 31, moment_day) AS moment_day,
    IF(day(moment_day) = 20, close_total_balance + store_id, close_total_balance)
      AS close_total_balance)
  FROM spine) """ + _SPINE_CHECK_SQL + ") c"))
def dq_spine_injected(sample):
    """The same checks on a spine with planted faults."""
    rows = _spine(sample)
    day = F.dayofmonth("moment_day")

    def swap(when, value, column: str):
        return F.when(when, value).otherwise(F.col(column))

    faulty = rows.select(
        *[c for c in rows.columns
          if c not in ("quantity", "is_used", "move_in", "moment_day", "close_total_balance")],
        swap(F.col("real_in") > 40, F.col("quantity") + 1, "quantity").alias("quantity"),
        swap((day == 13) & (F.col("close_slot_balance") < 0), 0, "is_used").alias("is_used"),
        swap(F.col("items_in_slot") > 4, -F.col("move_in") - 1, "move_in").alias("move_in"),
        swap(
            (F.col("slot_id") == S.OFF_SLOT) & (day == 1), F.date_add("moment_day", 31),
            "moment_day",
        ).alias("moment_day"),
        swap(
            day == 20, F.col("close_total_balance") + F.col("store_id"), "close_total_balance"
        ).alias("close_total_balance"),
    )
    return quality.spine_counts(faulty, AS_OF)


@query(on_both("""
, o AS (SELECT store_id, slot_id, item_id, moment_day, SUM(quantity) AS q,
               SUM(real_in) AS i, SUM(real_out) AS r FROM opsb GROUP BY ALL),
partners AS (SELECT * FROM opsb WHERE doc_type IN ('supply', 'enter', 'demand', 'loss')),
counted_real AS (SELECT COUNT(*) AS n FROM opsb WHERE doc_type <> 'move')
SELECT 'spine_quantity_reconciles' AS check_name, COUNT(*) AS violations
  FROM spine s JOIN o USING (store_id, slot_id, item_id, moment_day)
  WHERE s.quantity <> o.q
UNION ALL SELECT 'spine_real_reconciles', COUNT(*)
  FROM spine s JOIN o USING (store_id, slot_id, item_id, moment_day)
  WHERE s.real_in <> o.i OR s.real_out <> o.r
UNION ALL SELECT 'filtered_within_all', CAST(
  (SELECT COUNT(*) FROM ops) > (SELECT COUNT(*) FROM operations_all) AS BIGINT)
UNION ALL SELECT 'shipments_only', COUNT(*)
  FROM spine s JOIN (SELECT store_id, slot_id, item_id, moment_day, SUM(quantity) AS q
                     FROM opsb WHERE doc_type <> 'move' GROUP BY ALL) p
       USING (store_id, slot_id, item_id, moment_day)
  WHERE s.quantity <> p.q
UNION ALL SELECT 'partners_match', CAST((SELECT COUNT(*) FROM partners) <> n AS BIGINT) FROM counted_real
UNION ALL SELECT 'partners_match_cut', CAST((SELECT COUNT(*) FROM partners WHERE quantity <= 45) <> n AS BIGINT)
  FROM counted_real
UNION ALL SELECT 'partners_match_all', CAST((SELECT COUNT(*) FROM opsb) <> n AS BIGINT) FROM counted_real
UNION ALL SELECT 'union_match', CAST((SELECT COUNT(*) FROM operations_all) <> COUNT(*) AS BIGINT) FROM united
UNION ALL SELECT 'union_match_cut', CAST((SELECT COUNT(*) FROM operations_all) <> COUNT(*) AS BIGINT)
  FROM united WHERE doc_type <> 'loss'
UNION ALL SELECT 'mart_match', CAST((SELECT COUNT(*) FROM (SELECT store_name FROM opsb)) <> COUNT(*) AS BIGINT)
  FROM opsb
UNION ALL SELECT 'mart_match_cut', CAST(COUNT(*) FILTER (WHERE quantity <= 45) <> COUNT(*) AS BIGINT) FROM opsb"""))
def dq_reconcile_layers(sample):
    """Reconciliations between layers; two compare what must differ, and are counted too."""
    everything = cut(sample.operations_all(), "ledger")
    filtered = sample.operations(everything)
    operations = cut(
        ledger.operations_with_balance(
            filtered, sample.items(), sample.slots(), sample.agents(), sample.stores()
        ),
        "operations",
    )
    tiles = spine.spine_tiles(
        operations, sample.items(), sample.slots(), sample.stores(), AS_OF
    )
    shipped = F.when(F.col("doc_type") != "move", F.col("quantity"))
    # Tiles are read once, and only their numbers: storing them would store the arrays of their months too.
    joined = quality.rule_counts(
        quality.tiles_with_operations(tiles, operations, {"shipped": shipped}),
        {**quality.RECONCILIATION_RULES, "shipments_only": "spine_qty != shipped"},
    )
    others = quality.violations(
        {
            "filtered_within_all": quality.filtered_within_all(filtered, everything),
            "partners_match": quality.partners_match_operations(
                marts.partner_movements(operations), operations
            ),
            "partners_match_cut": quality.partners_match_operations(
                marts.partner_movements(operations).filter("quantity <= 45"), operations
            ),
            "partners_match_all": quality.partners_match_operations(operations, operations),
            "union_match": quality.union_matches_documents(
                everything, list(sample.documents().values())
            ),
            "union_match_cut": quality.union_matches_documents(
                everything, [d for kind, d in sample.documents().items() if kind != "loss"]
            ),
            "mart_match_cut": quality.mart_matches_operations(
                marts.operations_mart(operations).filter("quantity <= 45"), operations
            ),
            "mart_match": quality.mart_matches_operations(
                marts.operations_mart(operations), operations
            ),
        }
    )
    return joined.unionAll(others)


@query(on_ledger("""
SELECT DISTINCT slot_id FROM ops
WHERE slot_id <> 'off_slot' AND slot_id NOT IN (SELECT slot_id FROM slots_all)"""))
def dq_referential(sample):
    return quality.unknown_slots(sample.operations(), sample.slot_directory())


@query(on_operations("""
SELECT * FROM (
  SELECT item_id, id, moment, open_total_balance, close_total_balance,
         LAG(close_total_balance) OVER (PARTITION BY item_id ORDER BY moment, id)
           AS prev_close_total_balance
  FROM (SELECT * REPLACE (IF(quantity > 45, close_total_balance + 1, close_total_balance)
                          AS close_total_balance) FROM opsb) faulty) seen
WHERE open_total_balance <> prev_close_total_balance"""))
def dq_continuity(sample):
    """Breaks in the item totals after one is planted behind each large receipt."""
    balanced = ledger.item_running_balance(sample.split())
    faulty = balanced.withColumn(
        "close_total_balance",
        F.when(F.col("quantity") > 45, F.col("close_total_balance") + 1).otherwise(
            F.col("close_total_balance")
        ),
    )
    return quality.operations_total_continuity(faulty)


@query(on_operations("""
SELECT 'arithmetic' AS check_name, COUNT(*) AS violations FROM opsb
  WHERE close_slot_balance <> open_slot_balance + quantity
UNION ALL SELECT 'no_depositor', COUNT(*) FROM opsb WHERE depositor_id IS NULL
UNION ALL SELECT 'real_in', COUNT(*) FROM opsb WHERE real_in < 0
UNION ALL SELECT 'real_out', COUNT(*) FROM opsb WHERE real_out > 0
UNION ALL SELECT 'real_out_as_in', COUNT(*) FROM opsb WHERE real_out < 0
UNION ALL SELECT 'audit_duplicates', COUNT(*) FROM
  (SELECT doc_id FROM audit_latest GROUP BY doc_id HAVING COUNT(*) > 1) d
UNION ALL SELECT 'event_duplicates', COUNT(*) FROM
  (SELECT doc_id FROM audit_events GROUP BY doc_id HAVING COUNT(*) > 1) d
UNION ALL SELECT 'errors_without_tag', COUNT(*) FROM (SELECT * FROM opsb WHERE length(slot_oper_errors) > 0) e
  WHERE coalesce(slot_oper_errors, '') = ''
UNION ALL SELECT 'rows_without_tag', COUNT(*) FROM opsb WHERE slot_oper_errors = ''
UNION ALL SELECT 'partners_with_moves', COUNT(*) FROM
  (SELECT * FROM opsb WHERE doc_type IN ('supply', 'enter', 'demand', 'loss')) p WHERE doc_type = 'move'
UNION ALL SELECT 'moves', COUNT(*) FROM opsb WHERE doc_type = 'move'"""))
def dq_operations(sample):
    """Checks on operations and marts; some also on rows that must fail them."""
    operations = cut(sample.operations_with_balance(), "operations")
    swapped = operations.withColumn("real_in", F.col("real_out"))
    return quality.violations(
        {
            "arithmetic": quality.operations_arithmetic(operations),
            "no_depositor": quality.operations_without_depositor(operations),
            "real_in": quality.operations_real_in_sign(operations),
            "real_out": quality.operations_real_out_sign(operations),
            "real_out_as_in": quality.operations_real_in_sign(swapped),
            "audit_duplicates": quality.audit_duplicates(ledger.last_events(*sample.audit_sides())),
            "event_duplicates": quality.audit_duplicates(sample.audit_events()),
            "errors_without_tag": quality.errors_without_tag(marts.operation_errors(operations)),
            "rows_without_tag": quality.errors_without_tag(operations),
            "partners_with_moves": quality.partners_without_moves(
                marts.partner_movements(operations)
            ),
            "moves": quality.partners_without_moves(
                operations.withColumnsRenamed(
                    {
                        "moment": "doc_time",
                        "open_total_balance": "open_balance",
                        "close_total_balance": "close_balance",
                    }
                )
            ),
        }
    )


@query(on_operations("""
SELECT 'not_null.operations.' || name AS check_name, missing AS violations FROM (
  SELECT COUNT(*) - COUNT(agent_id) AS agent_id, COUNT(*) - COUNT(store_id) AS store_id,
         COUNT(*) - COUNT(item_id) AS item_id, COUNT(*) - COUNT(expected_bin_qty)
           AS expected_bin_qty FROM opsb) n
  UNPIVOT (missing FOR name IN (agent_id, store_id, item_id, expected_bin_qty))
UNION ALL SELECT 'unique.id', COUNT(*) FROM
  (SELECT id FROM opsb GROUP BY id HAVING COUNT(*) > 1) u
UNION ALL SELECT 'unique.agent_id', COUNT(*) FROM
  (SELECT agent_id FROM opsb WHERE agent_id IS NOT NULL GROUP BY agent_id HAVING COUNT(*) > 1) u
UNION ALL SELECT 'accepted.op_type', COUNT(DISTINCT op_type) FROM opsb WHERE op_type NOT IN ('in', 'out')
UNION ALL SELECT 'accepted.op_type_in', COUNT(DISTINCT op_type) FROM opsb WHERE op_type NOT IN ('in')
UNION ALL SELECT 'accepted.doc_type', CAST(SUM(n) AS BIGINT) FROM
  (SELECT COUNT(DISTINCT doc_type) AS n FROM opsb WHERE doc_type IN ('enter', 'loss')) a"""))
def dq_generic(sample):
    operations = cut(sample.operations_with_balance(), "operations")
    columns = ["agent_id", "store_id", "item_id", "expected_bin_qty"]
    missing = quality.null_counts(operations, columns).withColumn(
        "check_name", F.concat(F.lit("not_null.operations."), "check_name")
    )
    others = quality.violations(
        {
            "unique.id": quality.unique(operations, "id"),
            "unique.agent_id": quality.unique(operations, "agent_id"),
            "accepted.op_type": quality.accepted_values(operations, "op_type", ["in", "out"]),
            "accepted.op_type_in": quality.accepted_values(operations, "op_type", ["in"]),
            "accepted.doc_type": quality.accepted_values(
                operations, "doc_type", ["supply", "demand", "move"]
            ),
        }
    )
    return missing.unionAll(others)


# --- JSON ------------------------------------------------------------------

@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_number,
       json_extract_string(props, '$.missing.id') AS nothing
FROM events""")
def json_extract(sample):
    shape = "k STRING, missing STRUCT<id: STRING>"
    events = sample.table("events").select("event_id", F.from_json("props", shape).alias("j"))
    return events.select(
        "event_id",
        F.col("j.k").alias("k"),
        exact_number("j.k").cast("double").alias("k_number"),
        F.col("j.missing.id").alias("nothing"),
    )


_DOCUMENT_SQL = """
WITH lines AS (
  SELECT l.*, o.*, CASE WHEN l_returnflag = 'R' THEN 'move'
           WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'supply'
           WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'enter'
           WHEN l_returnflag = 'N' THEN 'demand' ELSE 'loss' END AS doc_type
  FROM lineitem l JOIN orders o ON o_orderkey = l_orderkey
), legs AS (
  SELECT *, CASE WHEN doc_type IN ('supply', 'enter') THEN 'in' ELSE 'out' END AS op_type
  FROM lines WHERE doc_type <> 'move'
  UNION ALL SELECT *, unnest(['in', 'out']) FROM lines WHERE doc_type = 'move'
)
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, o_orderstatus <> 'P' AS applicable,
       o_orderdate AS moment, 'N' || l_orderkey AS number,
       IF(doc_type = 'move', NULL, CAST(o_custkey AS VARCHAR)) AS agent_id,
       CAST(l_suppkey % 3 AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS item_id,
       IF(op_type = 'in', l_quantity, -l_quantity) AS quantity,
       CASE WHEN doc_type = 'move' AND op_type = 'in' THEN CAST(l_suppkey + 3 AS VARCHAR)
            WHEN doc_type = 'move' OR l_tax <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS slot_id,
       o_orderdate AS updated, doc_type, op_type
FROM legs"""

_DOCUMENT_PARSERS = [bronze.supply, bronze.enter, bronze.demand, bronze.loss, bronze.move]


@query("""
SELECT p_partkey, written, length(rtrim(split_part(written, '.', 2), '0')) > 6 AS refused
FROM (SELECT p_partkey, p_size || '.' || repeat('0', CAST(p_partkey % 24 AS INTEGER)) || p_size % 10
             || repeat('0', CAST(p_partkey % 3 AS INTEGER)) AS written FROM part) w""")
def exact_numbers(sample):
    """Numbers with up to 26 decimals: those that the ledger would round are refused."""
    size = F.col("p_size")
    written = F.concat(
        text(size), F.lit("."), F.repeat(F.lit("0"), (F.col("p_partkey") % 24).cast("int")), text(size % 10),
        F.repeat(F.lit("0"), (F.col("p_partkey") % 3).cast("int")),
    )
    return sample.table("part").select("p_partkey", written.alias("written")).withColumn(
        "refused", loses_digits("written")
    )


def _flat(documents: DataFrame) -> DataFrame:
    """Documents as in the SQL: quantities as doubles, without the position."""
    return documents.withColumn("quantity", F.col("quantity").cast("double")).drop("position")


@query(_DOCUMENT_SQL)
def json_explode_documents(sample):
    """All line items packed into JSON documents and parsed back by kind."""
    raw = cut(sample.raw_documents(), "raw", by="entity")
    return _flat(ledger.union_documents([parse(raw) for parse in _DOCUMENT_PARSERS]))


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS id, 'slot' AS kind, CAST(n_regionkey AS VARCHAR) AS store_id,
       CAST(s_nationkey AS VARCHAR) AS zone_id, s_name AS name,
       TIMESTAMP '2000-01-01' AS updated
FROM supplier JOIN nation ON n_nationkey = s_nationkey
UNION ALL
SELECT CAST(n_nationkey AS VARCHAR), 'zone', CAST(n_regionkey AS VARCHAR), NULL, n_name,
       TIMESTAMP '2000-01-01'
FROM nation""")
def json_store_directory(sample):
    raw = sample.raw_stores()
    slots = bronze.slots(raw).select(
        F.col("slot_id").alias("id"), F.lit("slot").alias("kind"),
        "store_id", "zone_id", "name", "updated",
    )
    zones = bronze.zones(raw).select(
        F.col("zone_id").alias("id"), F.lit("zone").alias("kind"),
        "store_id", F.lit(None).cast("string").alias("zone_id"), "name", "updated",
    )
    return slots.unionByName(zones)


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS article,
       CAST(p_size AS DOUBLE) AS weight, p_retailprice AS volume,
       CAST(p_size % 7 AS VARCHAR) AS uom_id,
       IF(p_size > 5, CAST(p_partkey AS VARCHAR), NULL) AS depositor_id,
       CAST(p_size * 10 AS DOUBLE) AS expected_bin_qty, TIMESTAMP '2000-01-01' AS updated
FROM part""")
def json_products(sample):
    products = bronze.products(sample.raw_products())
    numbers = ["weight", "volume", "expected_bin_qty"]
    return products.withColumns({n: F.col(n).cast("double") for n in numbers})


@query("""
SELECT l_partkey || '-' || l_suppkey AS variant_id, CAST(l_partkey AS VARCHAR) AS product_id,
       'L' || l_suppkey AS lot,
       CASE WHEN MIN(l_shipdate) >= TIMESTAMP '1999-01-01'
            THEN strftime(MIN(l_shipdate), '%Y-%m-%d') END AS mfg_date,
       MIN(l_shipdate) AS updated
FROM lineitem GROUP BY l_partkey, l_suppkey""")
def json_variants(sample):
    return bronze.variants(sample.raw_variants())


@query("""
SELECT 'agent' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS inn,
       TIMESTAMP '2000-01-01' AS updated FROM customer
UNION ALL SELECT 'uom', CAST(n_nationkey AS VARCHAR), n_name, NULL, TIMESTAMP '2000-01-01'
FROM nation
UNION ALL SELECT 'store', CAST(r_regionkey AS VARCHAR), r_name, NULL, TIMESTAMP '2000-01-01'
FROM region""")
def json_directories(sample):
    """Customers, nations and regions as counterparties, units and stores."""
    changed = F.lit("2000-01-01 00:00:00").alias("updated")

    def objects(table: str, entity: str, key: str, name: str, *more) -> DataFrame:
        body = F.struct(text(key).alias("id"), F.col(name).alias("name"), changed, *more)
        return tag(sample.table(table).select(F.to_json(body).alias("raw_json")), entity)

    raw = (
        objects(
            "customer", "counterparty", "c_custkey", "c_name", F.col("c_mktsegment").alias("inn")
        )
        .unionByName(objects("nation", "uom", "n_nationkey", "n_name"))
        .unionByName(objects("region", "store", "r_regionkey", "r_name"))
    )

    def shown(rows: DataFrame, kind: str, key: str) -> DataFrame:
        inn = F.col("inn") if "inn" in rows.columns else F.lit(None).cast("string")
        return rows.select(
            F.lit(kind).alias("kind"), F.col(key).alias("id"), "name", inn.alias("inn"), "updated"
        )

    return (
        shown(bronze.agents(raw), "agent", "agent_id")
        .unionByName(shown(bronze.uoms(raw), "uom", "uom_id"))
        .unionByName(shown(bronze.stores(raw), "store", "store_id"))
    )


@query("""
SELECT IF(value >= 5, CAST(user_id AS VARCHAR), NULL) AS doc_id, 'demand' AS entity_type,
       CASE event_type WHEN 'error' THEN 'puttorecyclebin' ELSE 'restorefromrecyclebin' END
         AS event_type,
       CAST(ts AS VARCHAR) AS moment, CAST(event_id AS VARCHAR) AS name
FROM events WHERE event_type IN ('error', 'signup')""")
def audit_flatten(sample):
    return bronze.flatten_audit(sample.raw_audit_contexts())


# --- incremental loading ---------------------------------------------------

def _taken_in(sample, existing: DataFrame, batch: DataFrame, changes: Changes, since: dt.datetime | None = None) -> DataFrame:
    """A stored table after a batch, by default of what is newer than all of it."""
    store = TableStore(sample.spark, scratch_path(sample.spark, "warehouse"))
    store.write(existing, "bronze", "stored", changed=changes.changed)
    if since is None:
        since = store.latest("bronze", "stored", changes.changed) or upsert.EPOCH
        batch = upsert.newer_than(batch, changes.changed, since)
    store.merge(batch, "bronze", "stored", changes, since=since)
    return store.read("bronze", "stored")


def _last_events(rows: DataFrame) -> DataFrame:
    """One row per user: the latest event, as a directory keyed by user."""
    latest = rows.groupBy("user_id").agg(
        F.max_by(F.struct("event_type", "value", "ts"), F.struct("ts", "event_id")).alias("last")
    )
    return latest.select(
        "user_id", F.col("last.event_type").alias("name"), F.col("last.value").alias("value"),
        F.col("last.ts").alias("updated"),
    )


@query(f"""
WITH latest AS (
  SELECT user_id, event_type AS name, value, ts AS updated, ts >= TIMESTAMP '{CUTOVER}' AS later,
         ROW_NUMBER() OVER (PARTITION BY user_id, ts >= TIMESTAMP '{CUTOVER}'
                            ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
SELECT user_id, name, value, updated FROM latest WHERE rn = 1 AND later
UNION ALL
SELECT user_id, name, value, updated FROM latest l WHERE rn = 1 AND NOT later
  AND NOT EXISTS (SELECT 1 FROM latest n WHERE n.user_id = l.user_id AND n.later)""")
def merge_by_key(sample):
    """A directory of users kept up to date: stored part, then the batch above its watermark."""
    events = sample.table("events")
    existing = _last_events(events.filter(f"ts < TIMESTAMP_NTZ '{CUTOVER}'"))
    batch = _last_events(events.filter(f"ts >= TIMESTAMP_NTZ '{CUTOVER}'"))
    return _taken_in(sample, existing, batch, Changes(["user_id"], "updated"))


@query("""
SELECT doc_id, entity_type, event_type, name || '+' AS name, moment FROM (
  SELECT user_id AS doc_id, 'order' AS entity_type, CAST(event_id AS VARCHAR) AS name,
         CASE event_type WHEN 'error' THEN 'puttorecyclebin'
                         ELSE 'restorefromrecyclebin' END AS event_type, ts AS moment
  FROM events WHERE event_type IN ('error', 'signup') AND ts >= TIMESTAMP '2024-01-10') later
UNION ALL
SELECT user_id, 'order', CASE event_type WHEN 'error' THEN 'puttorecyclebin'
         ELSE 'restorefromrecyclebin' END, CAST(event_id AS VARCHAR), ts
FROM events WHERE event_type IN ('error', 'signup') AND ts < TIMESTAMP '2024-01-10'""")
def merge_composite_key(sample):
    """A batch that overlaps the stored audit: matches are updated, the rest is added."""
    audit = sample.audit_events().select("doc_id", "entity_type", "event_type", "name", "moment")
    existing = audit.filter(f"moment < TIMESTAMP_NTZ '{CUTOVER}'")
    batch = audit.filter("moment >= TIMESTAMP_NTZ '2024-01-10 00:00:00'").withColumn(
        "name", F.concat("name", F.lit("+"))
    )
    return _taken_in(sample, existing, batch, Changes(["doc_id", "event_type", "moment"], "moment"), upsert.EPOCH)


@query(on_ledger("""
SELECT doc_id, moment, number, item_id, quantity, slot_id, doc_type, op_type FROM united u
LEFT JOIN (SELECT DISTINCT doc_id AS sent FROM united WHERE moment >= TIMESTAMP '1998-07-01') b
  ON sent = doc_id
WHERE moment >= TIMESTAMP '1998-07-01' OR sent IS NULL"""))
def replace_by_document(sample):
    """Postings of the later half of the years replace all stored rows of their documents."""
    rows = sample.legs(sample.base()).select(
        "doc_id", "moment", "number", "item_id", "quantity", "slot_id", "doc_type", "op_type"
    )
    later = F.col("moment") >= F.lit("1998-07-01 00:00:00").cast(S.TIME)
    sent = F.when(later, "2002-01-02 00:00:00").otherwise("2002-01-01 00:00:00").cast(S.TIME)
    rows = cut(rows.withColumn("updated", sent), "versions")
    existing, batch = rows.filter(~later), rows.filter(later)
    return _taken_in(sample, existing, batch, Changes(["doc_id"], "updated")).drop("updated")


@query(f"""
SELECT MAX(ts) + INTERVAL 1 MILLISECOND AS next_request,
       (SELECT COUNT(*) FROM events WHERE ts >= (
          SELECT MAX(ts) + INTERVAL 1 MILLISECOND FROM events WHERE ts < TIMESTAMP '{CUTOVER}'))
         AS to_fetch
FROM events WHERE ts < TIMESTAMP '{CUTOVER}'""")
def high_watermark(sample):
    """Where the next load starts after the stored part, and how much it fetches."""
    events = sample.table("events")
    store = TableStore(sample.spark, scratch_path(sample.spark, "warehouse"))
    store.write(events.filter(f"ts < TIMESTAMP_NTZ '{CUTOVER}'"), "bronze", "events", changed="ts")
    since = store.latest("bronze", "events", "ts") + upsert.STEP
    fetched = upsert.changed_since(events, "ts", since).agg(F.count("*").alias("to_fetch"))
    return fetched.select(time_literal(since).alias("next_request"), "to_fetch")


@query(on_ledger("SELECT doc_id, status FROM audit_latest"))
def audit_two_level(sample):
    """Contexts to events, events merged into the stored audit, then the status per document."""
    flat = bronze.flatten_audit(
        sample.raw_audit_contexts()
    ).select(
        F.col("name").cast("bigint").alias("event_id"), "entity_type", "event_type",
        F.col("moment").cast(S.TIME).alias("moment"), "name",
    )
    owners = sample.table("events").select("event_id", F.col("user_id").alias("doc_id"))
    events = flat.join(owners, "event_id").drop("event_id")
    existing = events.filter(f"moment < TIMESTAMP_NTZ '{CUTOVER}'")
    batch = events.filter(f"moment >= TIMESTAMP_NTZ '{CUTOVER}'")
    merged = upsert.merge_by_key(existing, batch, ["doc_id", "event_type", "moment"])
    status = ledger.last_events(
        merged.filter(F.col("event_type") == S.EVENT_DELETED),
        merged.filter(F.col("event_type") == S.EVENT_RESTORED),
    )
    return status.select("doc_id", "status")


@query(f"""
WITH parsed AS (
  SELECT CASE event_type WHEN 'error' THEN 'audit_deleted' ELSE 'audit_restored' END AS side,
         CAST(user_id AS VARCHAR) AS doc_id, 'order' AS entity_type,
         CASE event_type WHEN 'error' THEN 'puttorecyclebin'
                         ELSE 'restorefromrecyclebin' END AS event_type,
         CAST(event_id AS VARCHAR) AS name, ts AS moment
  FROM events WHERE event_type IN ('error', 'signup'))
SELECT 'all' AS part, * FROM parsed
UNION ALL SELECT 'new', * FROM parsed WHERE moment > TIMESTAMP '{CUTOVER}'""")
def audit_parsers(sample):
    """Landed audit events typed by both parsers, all of them and those above a watermark."""
    raw = cut(sample.raw_audit(), "raw", by="entity")
    since = dt.datetime.fromisoformat(CUTOVER)
    parts = [
        parse(raw, bound).select(F.lit(part).alias("part"), F.lit(side).alias("side"), "*")
        for side, parse in (("audit_deleted", bronze.audit_deleted), ("audit_restored", bronze.audit_restored))
        for part, bound in (("all", None), ("new", since))
    ]
    return reduce(DataFrame.unionByName, parts)


@query(f"""
SELECT 'slot' AS kind, CAST(s_suppkey AS VARCHAR) AS id, CAST(n_regionkey AS VARCHAR) AS store_id,
       TIMESTAMP '2000-01-01' + to_days(CAST(s_suppkey % 60 AS INTEGER)) AS updated
FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 60 > 31
UNION ALL
SELECT 'zone', CAST(n_nationkey AS VARCHAR), CAST(n_regionkey AS VARCHAR), TIMESTAMP '2000-01-01'
FROM nation WHERE n_regionkey * 20 > 31""")
def nested_watermark(sample):
    """Objects inside stores above a watermark: a slot's own change time counts, a zone's store's."""

    def day(number: Column) -> Column:
        return text(F.date_add(F.lit("2000-01-01").cast("date"), number.cast("int")))

    raw = sample.raw_stores(day(F.col("r_regionkey") * 20), day(F.col("s_suppkey") % 60))
    since = dt.datetime(2000, 2, 1)
    slots = bronze.slots(raw, since).select(
        F.lit("slot").alias("kind"), F.col("slot_id").alias("id"), "store_id", "updated"
    )
    return slots.unionByName(
        bronze.zones(raw, since).select(
            F.lit("zone").alias("kind"), F.col("zone_id").alias("id"), "store_id", "updated"
        )
    )


@query(f"""
SELECT entity, CAST(COUNT(*) AS BIGINT) AS objects, CAST(0 AS BIGINT) AS before_first_run,
       MIN(ts) AS first_moment
FROM (SELECT CASE event_type WHEN 'error' THEN 'audit_deleted' ELSE 'audit_restored' END AS entity, ts
      FROM events WHERE event_type IN ('error', 'signup')) fetched
WHERE ts >= (SELECT MAX(ts) + INTERVAL 1 MILLISECOND FROM events
             WHERE event_type IN ('error', 'signup') AND ts < TIMESTAMP '{CUTOVER}')
GROUP BY entity""")
def cross_layer_watermark(sample):
    """The audit is fetched from the latest change in silver on, and not at all before there is one."""
    warehouse = Warehouse(sample.spark, scratch_path(sample.spark, "warehouse"), AS_OF)
    audit = sample.raw_audit()
    cold = warehouse.select_new(audit).count()
    seen = sample.audit_events().filter(f"moment < TIMESTAMP_NTZ '{CUTOVER}'")
    warehouse.store.write(seen.withColumnRenamed("moment", "updated"), "silver", "operations_filtered")
    happened = F.get_json_object("raw_json", "$.moment").cast(S.TIME)
    return (
        warehouse.select_new(audit)
        .groupBy("entity")
        .agg(F.count("*").alias("objects"), F.min(happened).alias("first_moment"))
        .withColumn("before_first_run", F.lit(cold).cast("bigint"))
    )


def _customers(sample: SampleLedger, changed: str) -> DataFrame:
    """Customers as counterparties last changed at one time."""
    body = F.struct(
        text("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("inn"), F.lit(changed).alias("updated"),
    )
    return tag(sample.table("customer").select("*", F.to_json(body).alias("raw_json")), "counterparty")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS agent_id, 'incremental' AS load, TIMESTAMP '2000-01-02' AS updated
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'full refresh', TIMESTAMP '2000-01-01'
FROM customer WHERE c_mktsegment = 'BUILDING'""")
def full_refresh(sample):
    """An older, smaller batch after a whole one: a load adds nothing of it, a refresh keeps it alone."""
    warehouse = Warehouse(sample.spark, scratch_path(sample.spark, "warehouse"), AS_OF)
    building = F.get_json_object("raw_json", "$.inn") == "BUILDING"
    older = _customers(sample, "2000-01-01 00:00:00").filter(building)
    loads = []
    warehouse.load_table(_customers(sample, "2000-01-02 00:00:00"), "agents")
    for refresh, load in ((False, "incremental"), (True, "full refresh")):
        warehouse.load_table(older, "agents", full_refresh=refresh)
        stored = warehouse.table("bronze", "agents")
        loads.append(cut(stored.select("agent_id", F.lit(load).alias("load"), "updated"), load.split()[0]))
    return loads[0].unionByName(loads[1])


# --- whole runs ------------------------------------------------------------

@query("SELECT entity, CAST(COUNT(*) AS BIGINT) AS objects FROM (" + """
  SELECT 'product' AS entity FROM part
  UNION ALL SELECT 'counterparty' FROM customer
  UNION ALL SELECT 'uom' FROM nation) landed GROUP BY entity""")
def landing_union(sample):
    """JSON-line files of several kinds of objects, read and tagged as one raw table."""
    kinds = {"product": "part", "counterparty": "customer", "uom": "nation"}
    folders = {}
    for entity, table in kinds.items():
        rows = sample.table(table)
        folders[entity] = scratch_path(sample.spark, f"landing-{entity}")
        rows.select(F.to_json(F.struct(*rows.columns))).write.text(folders[entity])
    raw = read_landing(sample.spark, folders)
    return raw.groupBy("entity").agg(F.count("raw_json").alias("objects"))


@query("""
SELECT 'counterparty' AS entity, CAST(COUNT(*) AS BIGINT) AS objects, 'true, false, false' AS landed
FROM customer""")
def landing_empty(sample):
    """A batch landed, then one in which nothing is new, then one without rows: the first stays."""
    warehouse = Warehouse(sample.spark, scratch_path(sample.spark, "warehouse"), AS_OF)
    objects = _customers(sample, "2000-01-01 00:00:00")
    landed = [warehouse.land(objects)]
    warehouse.load_table(warehouse.table("raw", "raw"), "agents")
    landed += [warehouse.land(objects), warehouse.land(objects.filter("entity = 'none'"))]
    raw = warehouse.table("raw", "raw").groupBy("entity").agg(F.count("raw_json").alias("objects"))
    return raw.withColumn("landed", F.lit(", ".join(str(done).lower() for done in landed)))


@query(_DOCUMENT_SQL)
def stream_ingest(sample):
    """The JSON documents arriving as files, taken in by a stream into the typed tables."""
    landing = scratch_path(sample.spark, "stream")
    sample.raw_documents().write.json(landing, compression="lz4")
    warehouse = Warehouse(sample.spark, scratch_path(sample.spark, "warehouse"), AS_OF)
    ingest_stream(warehouse, landing, scratch_path(sample.spark, "state")).awaitTermination()
    return _flat(
        ledger.union_documents([warehouse.table("bronze", k) for k in S.DOCUMENT_ENTITIES])
    )


@query("""
SELECT CAST(user_id AS VARCHAR) AS agent_id, event_type AS name, CAST(event_id AS VARCHAR) AS inn,
       ts AS updated
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) last_of_user
WHERE rn = 1""")
def stream_any_order(sample):
    """Each event as a new version of its user, landed in parts that overlap in time and taken
    in by two streams with checkpoints of their own: the newest version stays."""
    landing = scratch_path(sample.spark, "stream")
    # Versions of one user at one time are one object here, as a source would have it.
    last = F.struct(text("ts").alias("updated"), "event_id", "event_type")
    versions = sample.table("events").groupBy("user_id", "ts").agg(
        F.max(F.struct("event_id", last.alias("last"))).alias("v")
    )
    body = F.struct(
        text("user_id").alias("id"),
        F.col("v.last.event_type").alias("name"),
        text("v.event_id").alias("inn"),
        F.col("v.last.updated").alias("updated"),
    )
    parts = [versions.filter(F.col("v.event_id") % 3 == part) for part in (2, 0, 1)]
    warehouse = Warehouse(sample.spark, scratch_path(sample.spark, "warehouse"), AS_OF)
    checkpoints = [scratch_path(sample.spark, "state") for _ in range(2)]
    for rows, checkpoint in zip(parts, [checkpoints[0], checkpoints[0], checkpoints[1]]):
        tag(rows.select(F.to_json(body).alias("raw_json")), "counterparty").write.mode("append").json(landing)
        ingest_stream(warehouse, landing, checkpoint).awaitTermination()
    return warehouse.table("bronze", "agents")


_EDITED = on_ledger("SELECT 0").split("\nSELECT 0")[0].replace(
    "SELECT l.*, p.p_brand",
    "SELECT l.* REPLACE (IF(l_orderkey % 50 = 0, 2, 1) * l_quantity AS l_quantity), p.p_brand",
)


@query(_EDITED + DAILY + """
SELECT u.depositor_name, u.moment_month, u.slots_used_month, q.quantity, q.operations, 'ok, ok' AS runs
FROM (SELECT depositor_id, MAX(depositor_name) AS depositor_name,
             strftime(moment_day, '%Y-%m') AS moment_month,
             CAST(SUM(slots_used_day) AS BIGINT) AS slots_used_month
      FROM used_daily GROUP BY depositor_id, strftime(moment_day, '%Y-%m')) u
JOIN (SELECT depositor_name, strftime(moment_day, '%Y-%m') AS moment_month,
             SUM(quantity) AS quantity, COUNT(*) AS operations
      FROM split JOIN items_all USING (item_id)
      GROUP BY depositor_name, strftime(moment_day, '%Y-%m')) q
  USING (depositor_name, moment_month)""")
def daily_runs(sample):
    """Two whole days through all gates: a cold start, then edits and the audit.

    The first run fetches no audit; the second takes it in, with some documents
    re-sent in a later version. Billing, moved quantities and the run log are shown.
    """
    warehouse = Warehouse(sample.spark, scratch_path(sample.spark, "warehouse"), AS_OF)
    warehouse.run(sample.raw_ledger().unionByName(sample.raw_audit()))
    warehouse.run(sample.edited_documents().unionByName(sample.raw_audit()))
    moved = (
        warehouse.table("silver", "operations")
        .groupBy("depositor_name", F.date_format("moment", "yyyy-MM").alias("moment_month"))
        .agg(F.sum("quantity").cast("double").alias("quantity"), F.count("*").alias("operations"))
    )
    runs = warehouse.store.run_log().agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "status"))), lambda r: r["status"]), ", ").alias("runs")
    )
    months = warehouse.table("gold", "focus_slots_used_monthly")
    return months.join(moved, ["depositor_name", "moment_month"]).join(runs)


@query("""
SELECT 'not_null.agents.name' AS check_name, COUNT(*) AS violations, 'error' AS run
FROM customer WHERE c_custkey % 10 = 0""")
def gate_stops(sample):
    """A run on counterparties some of which have lost their names: the gate after the typed
    tables stops it, and the run log says so."""
    customers = sample.table("customer").select(
        text("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("name"),
        F.lit("2000-01-01 00:00:00").alias("updated"),
    )
    warehouse = Warehouse(sample.spark, scratch_path(sample.spark, "warehouse"), AS_OF)
    found = {}
    try:
        warehouse.run(tag(customers.select(F.to_json(F.struct("*")).alias("raw_json")), "counterparty"))
    except quality.QualityError as stopped:
        found = stopped.found
    rows = sample.spark.createDataFrame(list(found.items()), "check_name string, violations bigint")
    return rows.join(warehouse.store.run_log().select(F.col("status").alias("run")))
