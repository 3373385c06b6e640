"""Explicit schemas of the raw envelope, its JSON payloads and the typed tables.

Numbers, booleans and times are read from JSON as text and cast afterwards, so
that bad text fails the query instead of turning into NULL.
"""

from __future__ import annotations

# Entity tags of the raw envelope.
DIMENSION_ENTITIES = ["store", "uom", "product", "variant", "counterparty"]
DOCUMENT_ENTITIES = ["demand", "supply", "loss", "enter", "move"]
AUDIT_ENTITIES = ["audit_deleted", "audit_restored"]
AUDIT_CONTEXTS = "audit"

# Sentinels, event types and report tags.
OFF_SLOT = "off_slot"
OFF_ZONE = "off_zone"
OWN_STOCK = "not_3pl"
EVENT_DELETED = "puttorecyclebin"
EVENT_RESTORED = "restorefromrecyclebin"
STATUS_DELETED = "deleted"
STATUS_ACTIVE = "active"
TAG_OVERDRAFT = "OPER_ERROR: slot overdraft"
TAG_OUT_OF_SLOT = "OPER_WARNING: Out-of-slot operation"
TAG_MIXED_SLOT = "BALANCE_WARNING: slot has > 1 items"
TAG_UNEXPECTED = "BALANCE_WARNING: unexpected slot balance"
TAG_SEPARATOR = " | "

# Names of the custom product and variant fields.
ATTRIBUTE_DEPOSITOR = "Поклажедатель"
ATTRIBUTE_BIN_QTY = "Кол-во в ячейке"
CHARACTERISTIC_LOT = "Партия товара"
CHARACTERISTIC_MFG_DATE = "Дата выработки"

RAW = "entity STRING, raw_json STRING"
NUMERIC = "DECIMAL(18,6)"
TIME = "TIMESTAMP_NTZ"

_REF = "STRUCT<id: STRING>"
_NAMED = "ARRAY<MAP<STRING, STRING>>"
_HEAD = "id STRING, name STRING, moment STRING, updated STRING, applicable STRING"

PAYLOADS = {
    "counterparty": "id STRING, name STRING, inn STRING, updated STRING",
    "uom": "id STRING, name STRING, updated STRING",
    "store": (
        "id STRING, name STRING, updated STRING, "
        "zones STRUCT<rows: ARRAY<STRUCT<id: STRING, name: STRING, updated: STRING>>>, "
        f"slots STRUCT<rows: ARRAY<STRUCT<id: STRING, name: STRING, updated: STRING, zone: {_REF}>>>"
    ),
    "product": (
        "id STRING, name STRING, article STRING, weight STRING, volume STRING, updated STRING, "
        f"uom {_REF}, attributes {_NAMED}"
    ),
    "variant": f"id STRING, updated STRING, product {_REF}, characteristics {_NAMED}",
    "posting": (
        f"{_HEAD}, agent {_REF}, store {_REF}, "
        f"positions STRUCT<rows: ARRAY<STRUCT<quantity: STRING, assortment: {_REF}, slot: {_REF}>>>"
    ),
    "move": (
        f"{_HEAD}, sourceStore {_REF}, targetStore {_REF}, positions STRUCT<rows: ARRAY<STRUCT<"
        f"quantity: STRING, assortment: {_REF}, sourceSlot: {_REF}, targetSlot: {_REF}>>>"
    ),
    "audit": "doc_id STRING, entity_type STRING, event_type STRING, name STRING, moment STRING",
    "audit_context": (
        "id STRING, moment STRING, events ARRAY<STRUCT<eventType: STRING, entityType: STRING, "
        "name: STRING, entity: STRUCT<meta: STRUCT<href: STRING>>>>"
    ),
}

# One ledger row per signed position; ``position`` makes the order of a document's rows total.
DOCUMENT_COLUMNS = [
    "doc_id", "applicable", "moment", "number", "agent_id", "store_id",
    "item_id", "quantity", "slot_id", "updated", "doc_type", "op_type", "position",
]
LEDGER_ORDER = [
    "doc_id", "item_id", "op_type", "position", "number", "slot_id", "quantity", "doc_type",
    "moment", "store_id", "agent_id", "applicable", "updated",
]

GRAIN = ["store_id", "slot_id", "item_id"]
PARTS = ["real_in", "move_in", "real_out", "move_out"]
