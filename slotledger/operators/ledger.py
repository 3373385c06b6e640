"""From typed documents and reference data to operations with running balances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger import schemas as S
from slotledger.functions import join_text, movement_parts, nulls_last, operation_tags
from slotledger.operators.ids import with_global_ids
from slotledger.operators.joins import left_join_known
from slotledger.operators.running import HOT_ROWS, day_totals, heavy_groups, running_sums, running_sums_by_day
from slotledger.session import cut

# Columns of an item and of an operation, in the order readers expect.
ITEM_COLUMNS = [
    "item_id", "depositor_id", "expected_bin_qty", "name", "updated", "product", "lot",
    "mfg_date", "article", "weight", "volume", "uom", "depositor_name", "depositor_inn",
]
OPERATION_COLUMNS = [
    "id", "item_id", "slot_id", "store_id", "agent_id", "depositor_id", "expected_bin_qty",
    "store_name", "zone_name", "doc_type", "doc_name", "moment", "moment_day", "op_type",
    "slot_name", "quantity", "real_in", "real_out", "move_in", "move_out", "uom", "item_name",
    "product", "lot", "mfg_date", "article", "weight", "volume", "agent_name", "agent_inn",
    "depositor_name", "depositor_inn", "open_slot_balance", "close_slot_balance",
    "open_total_balance", "close_total_balance", "slot_oper_errors",
]

MOMENT_ORDER = ["moment", "id"]
DEALT_ROWS = 100_000  # items up to this size are dealt whole, with all their slots


def union_documents(documents: list[DataFrame]) -> DataFrame:
    """All document tables under one another, columns matched by name."""
    return reduce(DataFrame.unionByName, documents)


def unify_operations(
    documents: list[DataFrame], order: list[str] | None = None, keep: list[str] | None = None
) -> DataFrame:
    """One signed movement ledger with a default slot and a global row number.

    ``order`` must tell any two rows apart, or running balances could differ
    between runs; ``number`` and what follows it only break ties. ``keep`` names the
    columns to go on with, where some only order the rows.
    """
    united = union_documents(documents)
    numbered = with_global_ids(united, nulls_last(order or S.LEDGER_ORDER), keep=keep)
    return numbered.withColumn("slot_id", F.coalesce("slot_id", F.lit(S.OFF_SLOT)))


def last_events(deleted: DataFrame, restored: DataFrame) -> DataFrame:
    """The last audit event per document and the status it leaves.

    An event without a time counts as the last one. At equal times a restored
    document stays visible. Maxima combine before the shuffle.
    """
    events = deleted.unionByName(restored)
    rank = F.struct(
        F.col("moment").isNull(),
        "moment",
        F.col("event_type").eqNullSafe(S.EVENT_RESTORED),
        "event_type",
        "entity_type",
        "name",
    )
    row = F.struct("entity_type", "event_type", "moment", "name")
    last = events.groupBy("doc_id").agg(F.max_by(row, rank).alias("last")).select("doc_id", "last.*")
    status = F.when(F.col("event_type") == S.EVENT_DELETED, S.STATUS_DELETED).when(
        F.col("event_type") == S.EVENT_RESTORED, S.STATUS_ACTIVE
    )
    return last.withColumn("status", status)


def latest_status(deleted: DataFrame, restored: DataFrame) -> DataFrame:
    """``last_events`` as a stored table has them: numbered by document."""
    return with_global_ids(last_events(deleted, restored), nulls_last(["doc_id"]))


def items(variants: DataFrame, products: DataFrame, uoms: DataFrame, agents: DataFrame) -> DataFrame:
    """Everything a document may refer to: each variant and each product.

    A variant is called ``product (lot, date)`` and takes all else from its product.
    """
    described = (
        products.withColumnRenamed("name", "product_name")
        .join(uoms.select("uom_id", F.col("name").alias("uom")), "uom_id", "left")
        .join(
            agents.select(
                F.col("agent_id").alias("depositor_id"),
                F.col("name").alias("depositor_name"),
                F.col("inn").alias("depositor_inn"),
            ),
            "depositor_id",
            "left",
        )
    )
    none = F.lit(None).cast("string")
    plain = described.withColumns(
        {
            "item_id": F.col("product_id"),
            "name": F.col("product_name"),
            "product": none,
            "lot": none,
            "mfg_date": none,
        }
    )
    title = join_text(F.col("product_name"), " (", F.col("lot"), ", ", F.col("mfg_date"), ")")
    versions = (
        variants.select("variant_id", "product_id", "lot", "mfg_date", "updated")
        .join(described.drop("updated"), "product_id", "left")
        .withColumns(
            {"item_id": F.col("variant_id"), "name": title, "product": F.col("product_name")}
        )
    )
    both = versions.select(*ITEM_COLUMNS).unionByName(plain.select(*ITEM_COLUMNS))
    return with_global_ids(both, nulls_last(["item_id", "updated", "name"]))


def named_slots(slot_directory: DataFrame, zones: DataFrame) -> DataFrame:
    """Slot directory with zone names."""
    return (
        slot_directory.select("slot_id", "zone_id", F.col("name").alias("slot_name"))
        .join(zones.select("zone_id", F.col("name").alias("zone_name")), "zone_id", "left")
        .select("slot_id", "slot_name", "zone_name")
    )


def slots(slot_directory: DataFrame, zones: DataFrame) -> DataFrame:
    """``named_slots`` as a stored table has them: numbered by slot."""
    named = named_slots(slot_directory, zones)
    return with_global_ids(named, nulls_last(["slot_id", "slot_name", "zone_name"]))


def filter_operations(ledger: DataFrame, items: DataFrame, audit: DataFrame) -> DataFrame:
    """Applied documents of depositors' goods that are not in the recycle bin.

    An unknown depositor drops the row as the own stock does.
    """
    deposited = items.filter(F.col("depositor_name") != S.OWN_STOCK).select("item_id")
    hidden = audit.filter(F.col("status") != S.STATUS_ACTIVE).select("doc_id")
    return (
        ledger.filter("applicable")
        .join(deposited, "item_id")
        .join(hidden, "doc_id", "left_anti")
        .select(*ledger.columns)
    )


def split_movements(operations: DataFrame) -> DataFrame:
    """Add the day and the quantity sorted into real or relocated, in or out."""
    return operations.withColumns(
        {
            "moment_day": F.to_date("moment"),
            **movement_parts(F.col("quantity"), F.col("doc_type")),
        }
    )


def real_quantity(operations: DataFrame) -> Column:
    """What counts for the item; made of quantity and kind where the parts are not there yet."""
    parts = movement_parts(F.col("quantity"), F.col("doc_type"))
    real_in, real_out = (
        F.col(c) if c in operations.columns else parts[c] for c in ("real_in", "real_out")
    )
    return real_in + real_out


def slot_running_balance(operations: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Stock of the item in its slot before and after each operation."""
    return running_sums(
        operations, S.GRAIN, nulls_last(MOMENT_ORDER), F.col("quantity"),
        "open_slot_balance", "close_slot_balance", hot_rows,
    )


def item_running_balance(operations: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Stock of the item over all stores before and after each operation; moves do not count."""
    return running_sums(
        operations, ["item_id"], nulls_last(MOMENT_ORDER), real_quantity(operations),
        "open_total_balance", "close_total_balance", hot_rows,
    )


def running_balances(
    operations: DataFrame, hot_rows: int = HOT_ROWS, by_day: bool = False, dealt_rows: int = DEALT_ROWS
) -> DataFrame:
    """Slot and item balances of operations.

    Small items are dealt once, and their slots with them. Large ones are summed ``by_day``
    if wanted, as long as no day is hot, or else cut into chunks where they are hot.
    """
    if heavy_groups(operations, ["item_id"], min(dealt_rows, hot_rows)) is None:
        # An item's slots are part of it, so one shuffle and one check serve both windows.
        dealt = operations.repartition("item_id")
        return item_running_balance(slot_running_balance(dealt, None), None)
    if by_day:
        keys, day, real = ["item_id"], F.to_date("moment"), real_quantity(operations)
        totals = day_totals(operations, keys, day, real)
        if (totals.agg(F.max("_rows")).first()[0] or 0) <= hot_rows:
            by_slot = slot_running_balance(operations, hot_rows)
            return running_sums_by_day(
                by_slot, totals, keys, day, nulls_last(MOMENT_ORDER), real,
                "open_total_balance", "close_total_balance",
            )
    # Where ``hot_rows`` is the smaller limit, the first check has found such groups already.
    if hot_rows > dealt_rows and heavy_groups(operations, ["item_id"], hot_rows) is None:
        # An item's slots are no larger than the item, so one check serves both windows.
        return item_running_balance(slot_running_balance(operations, None), None)
    by_slot = cut(slot_running_balance(operations, hot_rows), "slot-balances")
    return item_running_balance(by_slot, hot_rows)


def tag_operations(operations: DataFrame) -> DataFrame:
    return operations.withColumn(
        "slot_oper_errors", operation_tags(F.col("close_slot_balance"), F.col("slot_id"))
    )


def enrich_operations(
    operations: DataFrame, items: DataFrame, slots: DataFrame, agents: DataFrame, stores: DataFrame
) -> DataFrame:
    """Attach item, slot, agent and store attributes.

    The sizes of the directories decide between broadcast and shuffle; hot keys
    of a shuffled join are split at run time, and rows without a slot or an agent spread.
    """
    partners = agents.select(
        "agent_id", F.col("name").alias("agent_name"), F.col("inn").alias("agent_inn")
    )
    # Agents are the largest directory: rows shuffled for them are still narrow.
    traded = left_join_known(
        operations.withColumnRenamed("number", "doc_name"), partners, ["agent_id"], F.lit(True), ["id"]
    )
    placed = left_join_known(
        traded, slots.select("slot_id", "slot_name", "zone_name"), ["slot_id"],
        F.col("slot_id") != S.OFF_SLOT, ["id"],
    )
    return (
        placed.join(
            items.drop("id", "updated").withColumnRenamed("name", "item_name"), "item_id", "left"
        )
        .join(stores.select("store_id", F.col("name").alias("store_name")), "store_id", "left")
        .withColumn("slot_name", F.coalesce("slot_name", F.lit(S.OFF_SLOT)))
        .withColumn("zone_name", F.coalesce("zone_name", F.lit(S.OFF_ZONE)))
    )


def operations_with_balance(
    operations: DataFrame,
    items: DataFrame,
    slots: DataFrame,
    agents: DataFrame,
    stores: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Operations with balances, attributes and anomalies.

    Balances come first, on narrow rows, so the wide attributes are never
    shuffled for a window; the parts of a quantity are made after them.
    """
    narrow = operations.select(
        "id", "item_id", "slot_id", "store_id", "agent_id", "doc_type", "number", "moment",
        "op_type", "quantity",
    )
    balanced = running_balances(narrow, hot_rows, by_day=True)
    enriched = enrich_operations(balanced, items, slots, agents, stores)
    return tag_operations(split_movements(enriched)).select(*OPERATION_COLUMNS)
