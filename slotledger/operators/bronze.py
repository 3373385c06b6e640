"""Typed tables from raw JSON objects.

One pass per entity over ``(entity, raw_json)``. ``since`` keeps only objects
changed after it, as an incremental load does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger import schemas as S
from slotledger.functions import exact_number, last_segment, named_value

Since = dt.datetime | None


def time_literal(moment: dt.datetime) -> Column:
    """A zoneless time as a literal the scan can use."""
    return F.lit(moment.isoformat(sep=" ")).cast(S.TIME)


def payload(raw: DataFrame, entity: str, shape: str) -> DataFrame:
    """Objects of one entity as a struct ``j``; malformed JSON fails the query."""
    parsed = F.from_json("raw_json", S.PAYLOADS[shape], {"mode": "FAILFAST"})
    return raw.filter(F.col("entity") == entity).select(parsed.alias("j"))


def _time(text: Column | str) -> Column:
    return (F.col(text) if isinstance(text, str) else text).cast(S.TIME)


def _changed(df: DataFrame, column: str, since: Since) -> DataFrame:
    if since is None:
        return df
    return df.filter(_time(column) > time_literal(since))


def _dimension(raw: DataFrame, entity: str, since: Since, columns: dict[str, Column]) -> DataFrame:
    rows = payload(raw, entity, entity).filter(F.col("j.id").isNotNull())
    rows = _changed(rows, "j.updated", since)
    return rows.select(
        *[value.alias(name) for name, value in columns.items()],
        _time("j.updated").alias("updated"),
    )


def agents(raw: DataFrame, since: Since = None) -> DataFrame:
    return _dimension(
        raw, "counterparty", since,
        {"agent_id": F.col("j.id"), "name": F.col("j.name"), "inn": F.col("j.inn")},
    )


def uoms(raw: DataFrame, since: Since = None) -> DataFrame:
    return _dimension(raw, "uom", since, {"uom_id": F.col("j.id"), "name": F.col("j.name")})


def stores(raw: DataFrame, since: Since = None) -> DataFrame:
    return _dimension(raw, "store", since, {"store_id": F.col("j.id"), "name": F.col("j.name")})


def products(
    raw: DataFrame,
    since: Since = None,
    depositor: str = S.ATTRIBUTE_DEPOSITOR,
    bin_qty: str = S.ATTRIBUTE_BIN_QTY,
) -> DataFrame:
    """Products with their owner and expected quantity per bin, both custom fields."""
    attributes = F.col("j.attributes")
    return _dimension(
        raw, "product", since,
        {
            "product_id": F.col("j.id"),
            "name": F.col("j.name"),
            "article": F.col("j.article"),
            "weight": exact_number("j.weight"),
            "volume": exact_number("j.volume"),
            "uom_id": F.col("j.uom.id"),
            "depositor_id": named_value(attributes, depositor, "id"),
            "expected_bin_qty": exact_number(named_value(attributes, bin_qty)),
        },
    )


def variants(
    raw: DataFrame,
    since: Since = None,
    lot: str = S.CHARACTERISTIC_LOT,
    mfg_date: str = S.CHARACTERISTIC_MFG_DATE,
) -> DataFrame:
    """Lots of a product; a variant without a product is left out."""
    characteristics = F.col("j.characteristics")
    rows = _dimension(
        raw, "variant", since,
        {
            "variant_id": F.col("j.id"),
            "product_id": F.col("j.product.id"),
            "lot": named_value(characteristics, lot),
            "mfg_date": named_value(characteristics, mfg_date),
        },
    )
    return rows.filter(F.col("product_id").isNotNull())


def zones(raw: DataFrame, since: Since = None) -> DataFrame:
    """Zones inside stores; it is the store's change time that counts."""
    rows = _changed(payload(raw, "store", "store"), "j.updated", since)
    return rows.select(F.col("j.id").alias("store_id"), F.explode("j.zones.rows").alias("z")).select(
        F.col("z.id").alias("zone_id"),
        "store_id",
        F.col("z.name").alias("name"),
        _time("z.updated").alias("updated"),
    )


def slots(raw: DataFrame, since: Since = None) -> DataFrame:
    """Slots inside stores; here each slot's own change time counts."""
    rows = payload(raw, "store", "store").select(
        F.col("j.id").alias("store_id"), F.explode("j.slots.rows").alias("s")
    )
    return _changed(rows, "s.updated", since).select(
        F.col("s.id").alias("slot_id"),
        "store_id",
        F.col("s.zone.id").alias("zone_id"),
        F.col("s.name").alias("name"),
        _time("s.updated").alias("updated"),
    )


def _positions(raw: DataFrame, entity: str, shape: str, since: Since) -> DataFrame:
    """One row per position; a document without positions gives none."""
    rows = _changed(payload(raw, entity, shape), "j.updated", since)
    return rows.select(
        F.col("j.id").alias("doc_id"),
        F.col("j.applicable").cast("boolean").alias("applicable"),
        _time("j.moment").alias("moment"),
        F.col("j.name").alias("number"),
        _time("j.updated").alias("updated"),
        F.lit(entity).alias("doc_type"),
        "j",
        F.posexplode("j.positions.rows").alias("position", "p"),
    ).withColumn("_quantity", exact_number("p.quantity"))


def _posting(raw: DataFrame, entity: str, inward: bool, since: Since) -> DataFrame:
    quantity = F.col("_quantity") if inward else -F.col("_quantity")
    return _positions(raw, entity, "posting", since).withColumns(
        {
            "agent_id": F.col("j.agent.id"),
            "store_id": F.col("j.store.id"),
            "item_id": F.col("p.assortment.id"),
            "quantity": quantity,
            "slot_id": F.col("p.slot.id"),
            "op_type": F.lit("in" if inward else "out"),
        }
    ).select(*S.DOCUMENT_COLUMNS)


def supply(raw: DataFrame, since: Since = None) -> DataFrame:
    """Receipts: stock comes in."""
    return _posting(raw, "supply", True, since)


def enter(raw: DataFrame, since: Since = None) -> DataFrame:
    """Stock found: comes in."""
    return _posting(raw, "enter", True, since)


def demand(raw: DataFrame, since: Since = None) -> DataFrame:
    """Shipments: stock goes out."""
    return _posting(raw, "demand", False, since)


def loss(raw: DataFrame, since: Since = None) -> DataFrame:
    """Write-offs: stock goes out."""
    return _posting(raw, "loss", False, since)


def move(raw: DataFrame, since: Since = None) -> DataFrame:
    """Relocations: each position leaves one slot and enters another, in one pass."""
    leaves = F.struct(
        F.col("j.sourceStore.id").alias("store_id"),
        (-F.col("_quantity")).alias("quantity"),
        F.col("p.sourceSlot.id").alias("slot_id"),
        F.lit("out").alias("op_type"),
    )
    enters = F.struct(
        F.col("j.targetStore.id").alias("store_id"),
        F.col("_quantity").alias("quantity"),
        F.col("p.targetSlot.id").alias("slot_id"),
        F.lit("in").alias("op_type"),
    )
    legs = _positions(raw, "move", "move", since).select(
        "*", F.explode(F.array(leaves, enters)).alias("leg")
    )
    return legs.select(
        "*",
        F.lit(None).cast("string").alias("agent_id"),
        F.col("p.assortment.id").alias("item_id"),
        "leg.*",
    ).select(*S.DOCUMENT_COLUMNS)


def _audit(raw: DataFrame, entity: str, since: Since) -> DataFrame:
    rows = _changed(payload(raw, entity, "audit"), "j.moment", since)
    return rows.select(
        "j.doc_id", "j.entity_type", "j.event_type", "j.name", _time("j.moment").alias("moment")
    )


def audit_deleted(raw: DataFrame, since: Since = None) -> DataFrame:
    return _audit(raw, "audit_deleted", since)


def audit_restored(raw: DataFrame, since: Since = None) -> DataFrame:
    return _audit(raw, "audit_restored", since)


def flatten_audit(contexts: DataFrame) -> DataFrame:
    """Audit contexts (column ``raw_json``) to one row per deletion or restoration.

    The time is the context's; the document is the last part of the entity link.
    """
    parsed = F.from_json("raw_json", S.PAYLOADS["audit_context"], {"mode": "FAILFAST"})
    events = contexts.select(parsed.alias("c")).select(
        F.col("c.moment").alias("moment"), F.explode("c.events").alias("e")
    )
    return events.filter(
        F.col("e.eventType").isin(S.EVENT_DELETED, S.EVENT_RESTORED)
    ).select(
        last_segment(F.col("e.entity.meta.href")).alias("doc_id"),
        F.col("e.entityType").alias("entity_type"),
        F.col("e.eventType").alias("event_type"),
        "moment",
        F.col("e.name").alias("name"),
    )


Parser = Callable[[DataFrame, Since], DataFrame]

# table: (parser, key, how a new version of the key is taken in, change time)
TABLES: dict[str, tuple[Parser, list[str], str, str]] = {
    "agents": (agents, ["agent_id"], "merge", "updated"),
    "products": (products, ["product_id"], "merge", "updated"),
    "variants": (variants, ["variant_id"], "merge", "updated"),
    "uoms": (uoms, ["uom_id"], "merge", "updated"),
    "stores": (stores, ["store_id"], "merge", "updated"),
    "zones": (zones, ["zone_id"], "merge", "updated"),
    "slots": (slots, ["slot_id"], "merge", "updated"),
    "supply": (supply, ["doc_id"], "replace", "updated"),
    "enter": (enter, ["doc_id"], "replace", "updated"),
    "demand": (demand, ["doc_id"], "replace", "updated"),
    "loss": (loss, ["doc_id"], "replace", "updated"),
    "move": (move, ["doc_id"], "replace", "updated"),
    "audit_deleted": (audit_deleted, ["doc_id", "event_type", "moment"], "merge", "moment"),
    "audit_restored": (audit_restored, ["doc_id", "event_type", "moment"], "merge", "moment"),
}
