"""A small source of JSON objects whose state can be edited and sent again."""

from __future__ import annotations

import json

from slotledger import schemas as S

OWNER, BIN = "Поклажедатель", "Кол-во в ячейке"


def at(day: int, hour: int = 0) -> str:
    return f"2024-01-{day:02d} {hour:02d}:00:00.000"


def position(item, quantity, slot=None):
    return {"quantity": quantity, "assortment": {"id": item},
            **({"slot": {"id": slot}} if slot else {})}


class Source:
    """Current objects by (entity, id)."""

    def __init__(self):
        self.objects: dict[tuple[str, str], dict] = {}

    def put(self, entity: str, key: str, **body) -> None:
        self.objects[entity, key] = {"id": key, **body}

    def document(self, entity, key, moment, *rows, updated=None, store="st1", applicable=True):
        self.put(
            entity, key, name=f"N{key}", moment=moment, updated=updated or moment,
            applicable=applicable, agent={"id": "a1"}, store={"id": store},
            positions={"rows": list(rows)},
        )

    def move(self, key, moment, item, quantity, source, target):
        self.put(
            "move", key, name=f"N{key}", moment=moment, updated=moment, applicable=True,
            sourceStore={"id": "st1"}, targetStore={"id": "st1"},
            positions={"rows": [{"quantity": quantity, "assortment": {"id": item},
                                 "sourceSlot": {"id": source}, "targetSlot": {"id": target}}]},
        )

    def event(self, kind, doc, moment):
        entity = {"puttorecyclebin": "audit_deleted"}.get(kind, "audit_restored")
        self.objects[entity, f"{doc}{moment}"] = {
            "doc_id": doc, "entity_type": "demand", "event_type": kind, "name": "n",
            "moment": moment,
        }

    def frame(self, spark):
        rows = [(entity, json.dumps(body)) for (entity, _), body in self.objects.items()]
        return spark.createDataFrame(rows, S.RAW)


def first_day() -> Source:
    source = Source()
    source.put("counterparty", "a1", name="Owner", inn="77", updated=at(1))
    source.put("counterparty", "a2", name="not_3pl", inn="78", updated=at(1))
    source.put("uom", "u1", name="pcs", updated=at(1))
    source.put(
        "store", "st1", name="Store", updated=at(1),
        zones={"rows": [{"id": "z1", "name": "Zone", "updated": at(1)}]},
        slots={"rows": [
            {"id": "s1", "name": "A", "updated": at(1), "zone": {"id": "z1"}},
            {"id": "s2", "name": "B", "updated": at(1)},
        ]},
    )
    for key, owner in [("p1", "a1"), ("p2", "a2")]:
        source.put(
            "product", key, name=key.upper(), updated=at(1), uom={"id": "u1"},
            attributes=[{"name": OWNER, "value": {"id": owner}}, {"name": BIN, "value": 5}],
        )
    source.put(
        "variant", "v1", product={"id": "p1"}, updated=at(1),
        characteristics=[{"name": "Партия товара", "value": "L1"}],
    )
    source.document("supply", "r1", at(2), position("v1", 5, "s1"), position("v1", 2))
    source.document("supply", "r2", at(2), position("p2", 9, "s1"))
    source.document("demand", "o1", at(4), position("v1", 2, "s1"))
    source.move("m1", at(5), "v1", 3, "s1", "s2")
    return source


def second_day(source: Source) -> None:
    source.document(  # an old document, edited: fewer positions, another quantity
        "supply", "r1", at(2), position("v1", 6, "s1"), updated=at(6)
    )
    source.document("demand", "o2", at(6), position("v1", 1, "s2"))
    source.document("loss", "l1", at(7), position("v1", 1, "s2"))
    source.document("enter", "e1", at(7), position("v1", 4, "s2"), applicable=False)
    source.put("counterparty", "a1", name="Owner Ltd", inn="77", updated=at(6))
    source.put("counterparty", "a3", name="Late", inn="79", updated=at(1))  # below the watermark
