import datetime as dt
import json
from decimal import Decimal

import pytest

from slotledger import schemas as S
from slotledger.operators import bronze
from slotledger.sources.raw import land_audit

TIME = "2024-01-02 03:04:05.678"
MOMENT = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)


def raw(spark, *objects):
    return spark.createDataFrame(
        [(entity, body if isinstance(body, str) else json.dumps(body)) for entity, body in objects],
        S.RAW,
    )


def document(**more):
    base = {
        "id": "d1", "name": "N1", "moment": TIME, "updated": TIME, "applicable": True,
        "agent": {"id": "a1"}, "store": {"id": "st1", "name": "ignored"},
        "positions": {"rows": [
            {"quantity": 2.5, "assortment": {"id": "i1"}, "slot": {"id": "s1"}},
            {"quantity": 1, "assortment": {"id": "i1"}},
        ]},
    }
    return {**base, **more}


def test_postings_carry_sign_direction_and_position(spark, rows):
    df = raw(spark, *[(kind, document()) for kind in ("supply", "enter", "demand", "loss")])
    for parse, sign, way in [
        (bronze.supply, 1, "in"), (bronze.enter, 1, "in"),
        (bronze.demand, -1, "out"), (bronze.loss, -1, "out"),
    ]:
        got = parse(df)
        assert got.columns == S.DOCUMENT_COLUMNS
        assert dict(got.dtypes)["quantity"] == "decimal(18,6)"
        kind = parse.__name__
        assert rows(got) == sorted(
            [
                ("d1", True, MOMENT, "N1", "a1", "st1", "i1", sign * Decimal("2.500000"), "s1",
                 MOMENT, kind, way, 0),
                ("d1", True, MOMENT, "N1", "a1", "st1", "i1", sign * Decimal("1.000000"), None,
                 MOMENT, kind, way, 1),
            ],
            key=lambda r: [str(v) for v in r],
        )


@pytest.mark.parametrize("positions", [None, {}, {"rows": None}, {"rows": []}])
def test_a_document_without_positions_gives_no_rows(spark, positions):
    assert bronze.demand(raw(spark, ("demand", document(positions=positions)))).isEmpty()


def test_a_move_leaves_one_slot_and_enters_another(spark, rows):
    body = {
        "id": "m1", "name": "M", "moment": TIME, "updated": TIME, "applicable": False,
        "sourceStore": {"id": "st1"}, "targetStore": {"id": "st2"},
        "positions": {"rows": [
            {"quantity": 3, "assortment": {"id": "i1"}, "sourceSlot": {"id": "s1"},
             "targetSlot": {"id": "s2"}},
        ]},
    }
    got = bronze.move(raw(spark, ("move", body)))
    assert got.columns == S.DOCUMENT_COLUMNS
    assert rows(got, "store_id", "slot_id", "quantity", "op_type", "agent_id", "applicable") == [
        ("st1", "s1", Decimal(-3), "out", None, False),
        ("st2", "s2", Decimal(3), "in", None, False),
    ]


def test_bad_text_fails_instead_of_turning_null(spark):
    body = document(positions={"rows": [{"quantity": "abc", "assortment": {"id": "i1"}}]})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bronze.demand(raw(spark, ("demand", body))).collect()
    with pytest.raises(Exception, match="MALFORMED"):
        bronze.demand(raw(spark, ("demand", "{broken"))).collect()


def product(*attributes, **more):
    return {"id": "p1", "name": "P", "updated": TIME, "attributes": list(attributes), **more}


def attribute(name, *value):
    return {"id": "x", "meta": {"type": "t"}, "name": name, **({"value": value[0]} if value else {})}


OWNER, BIN = "Поклажедатель", "Кол-во в ячейке"


@pytest.mark.parametrize(
    ("attributes", "owner", "expected"),
    [
        ([attribute(OWNER, {"id": "a1", "name": "A"}), attribute(BIN, 25)], "a1", Decimal(25)),
        ([attribute(OWNER, {"name": "no id"}), attribute(OWNER, {"id": "a2"})], "a2", None),
        ([attribute(OWNER, {"id": None}), attribute(OWNER, {"id": "a2"})], None, None),
        ([attribute(OWNER, "text"), attribute(OWNER, {"id": "a3"})], "a3", None),
        ([attribute(BIN), attribute(BIN, "7.5")], None, Decimal("7.5")),
        ([attribute(BIN, None), attribute(BIN, 3)], None, None),
        ([attribute("other", 1)], None, None),
        ([], None, None),
    ],
)
def test_custom_fields_of_products(spark, attributes, owner, expected):
    got = bronze.products(raw(spark, ("product", product(*attributes)))).first()
    assert (got["depositor_id"], got["expected_bin_qty"]) == (owner, expected)


def test_product_columns_and_missing_attributes(spark):
    body = {"id": "p1", "name": "P", "article": "A", "weight": 1.5, "volume": 0.000001,
            "uom": {"id": "u1"}, "updated": TIME}
    got = bronze.products(raw(spark, ("product", body), ("product", {"name": "no id"}))).collect()
    assert [tuple(r) for r in got] == [
        ("p1", "P", "A", Decimal("1.5"), Decimal("0.000001"), "u1", None, None, MOMENT)
    ]


def test_attribute_names_are_parameters(spark):
    body = product(attribute("Owner", {"id": "a1"}), attribute("Per bin", 4))
    got = bronze.products(raw(spark, ("product", body)), None, "Owner", "Per bin").first()
    assert (got["depositor_id"], got["expected_bin_qty"]) == ("a1", Decimal(4))


def test_variants_need_a_product(spark, rows):
    body = {
        "id": "v1", "product": {"id": "p1"}, "updated": TIME,
        "characteristics": [
            {"name": "Дата выработки", "value": "2024-01-01"}, {"name": "Партия товара", "value": "L1"},
        ],
    }
    df = raw(
        spark, ("variant", body), ("variant", {"id": "v2", "updated": TIME}),
        ("variant", {"id": "v3", "product": {"id": "p1"}, "updated": TIME}),
    )
    assert rows(bronze.variants(df), "variant_id", "product_id", "lot", "mfg_date") == [
        ("v1", "p1", "L1", "2024-01-01"), ("v3", "p1", None, None),
    ]


def test_directories_inside_stores_and_their_change_times(spark, rows):
    old, new = "2024-01-01 00:00:00.000", "2024-02-01 00:00:00.000"
    body = {
        "id": "st1", "name": "S", "updated": old,
        "zones": {"rows": [{"id": "z1", "name": "Z", "updated": new}]},
        "slots": {"rows": [
            {"id": "s1", "name": "A", "updated": new, "zone": {"id": "z1"}},
            {"id": "s2", "name": "B", "updated": old},
        ]},
    }
    df = raw(spark, ("store", body), ("store", {"id": "st2", "name": "no slots", "updated": old}))
    assert rows(bronze.stores(df), "store_id", "name") == [("st1", "S"), ("st2", "no slots")]
    assert rows(bronze.zones(df), "zone_id", "store_id", "name") == [("z1", "st1", "Z")]
    assert rows(bronze.slots(df), "slot_id", "store_id", "zone_id", "name") == [
        ("s1", "st1", "z1", "A"), ("s2", "st1", None, "B"),
    ]
    since = dt.datetime(2024, 1, 15)
    assert rows(bronze.slots(df, since), "slot_id") == [("s1",)]  # the slot's own time
    assert bronze.zones(df, since).isEmpty()  # the store's time
    assert bronze.stores(df, since).isEmpty()


def test_watermark_is_exclusive_to_the_millisecond(spark):
    df = raw(spark, ("counterparty", {"id": "a1", "name": "A", "inn": "1", "updated": TIME}))
    assert bronze.agents(df, MOMENT).isEmpty()
    assert bronze.agents(df, MOMENT - dt.timedelta(milliseconds=1)).count() == 1
    null_time = raw(spark, ("uom", {"id": "u1", "name": "U"}))
    assert bronze.uoms(null_time).count() == 1
    assert bronze.uoms(null_time, dt.datetime(1970, 1, 1)).isEmpty()


def test_audit_contexts_to_events(spark, rows):
    def event(kind, href):
        return {"eventType": kind, "entityType": "demand", "name": "N",
                "entity": {"meta": {"href": href}}}

    contexts = spark.createDataFrame(
        [(json.dumps({"id": "c1", "moment": TIME, "events": [
            event("puttorecyclebin", "https://h/entity/demand/d1"),
            event("restorefromrecyclebin", ""),
            event("update", "https://h/entity/demand/d2"),
            {"eventType": "puttorecyclebin"},
        ]}),)],
        "raw_json STRING",
    )
    flat = bronze.flatten_audit(contexts)
    assert rows(flat, "doc_id", "entity_type", "event_type", "moment", "name") == [
        (None, None, "puttorecyclebin", TIME, None),
        (None, "demand", "restorefromrecyclebin", TIME, "N"),
        ("d1", "demand", "puttorecyclebin", TIME, "N"),
    ]
    landed = bronze.audit_deleted(land_audit(contexts))
    assert rows(landed, "doc_id", "name", "moment") == [
        (None, None, MOMENT), ("d1", "N", MOMENT),
    ]
    assert rows(bronze.audit_restored(land_audit(contexts)), "doc_id", "name") == [(None, "N")]
    body = {"doc_id": "d1", "entity_type": "demand", "event_type": "puttorecyclebin",
            "name": "N", "moment": TIME}
    df = raw(spark, ("audit_deleted", body), ("audit_restored", body))
    assert rows(bronze.audit_deleted(df)) == [("d1", "demand", "puttorecyclebin", "N", MOMENT)]
    assert bronze.audit_restored(df, MOMENT).isEmpty()


def test_numbers_that_do_not_fit_fail_the_load(spark):
    from pyspark.sql import functions as F

    from slotledger.functions import exact_number

    def parsed(text):
        return spark.createDataFrame([(text,)], "t string").select(exact_number(F.col("t")).alias("n")).first().n

    assert str(parsed("1.123456")) == "1.123456" and str(parsed("-1e2")) == "-100.000000"
    assert str(parsed("1.12345600")) == "1.123456" and parsed(None) is None
    assert str(parsed("15e-5")) == "0.000150" and str(parsed("120e-7")) == "0.000012" and str(parsed("0.0e-9")) == "0.000000"
    for text in ("1.1234567", "abc", "1e20", "1.0000000000000000004", "1e-19", "12e-7", "0.000000000000000000000001"):
        with pytest.raises(Exception):
            parsed(text)
