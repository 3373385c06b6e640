import datetime as dt
from decimal import Decimal

import pytest

from slotledger.operators import ledger, marts, quality
from tests.ledgers import items_frame, op_frame_columns, ops_frame

AUDIT = "doc_id STRING, entity_type STRING, event_type STRING, name STRING, moment TIMESTAMP_NTZ"
DELETED, RESTORED = "puttorecyclebin", "restorefromrecyclebin"


def at(day):
    return None if day is None else dt.datetime(2024, 1, day)


def statuses(spark, deleted, restored):
    def frame(events, kind):
        return spark.createDataFrame(
            [(doc, "demand", kind, "n", at(day)) for doc, day in events], AUDIT
        )

    return ledger.latest_status(frame(deleted, DELETED), frame(restored, RESTORED))


def test_latest_status(spark, rows):
    got = statuses(
        spark,
        [("gone", 1), ("back", 1), ("tie", 2), ("again", 3), ("again", 1), ("untimed", None)],
        [("back", 2), ("tie", 2), ("again", 2), ("untimed", 5)],
    )
    assert rows(got, "doc_id", "status") == [
        ("again", "deleted"), ("back", "active"), ("gone", "deleted"), ("tie", "active"),
        ("untimed", "deleted"),
    ]
    assert [r["id"] for r in got.orderBy("doc_id").collect()] == [1, 2, 3, 4, 5]
    assert quality.audit_duplicates(got).isEmpty()


def test_unknown_event_has_no_status_and_hides_nothing(spark):
    odd = spark.createDataFrame([("d1", "x", "other", "n", at(1))], AUDIT)
    got = ledger.latest_status(odd, odd.limit(0))
    assert got.first()["status"] is None


def items_of(spark):
    variants = spark.createDataFrame(
        [("v1", "p1", "L", "2024", at(1)), ("v2", "p1", None, None, at(1)),
         ("v3", "nowhere", "L", None, at(1))],
        "variant_id STRING, product_id STRING, lot STRING, mfg_date STRING, updated TIMESTAMP_NTZ",
    )
    products = spark.createDataFrame(
        [("p1", "P", "A", Decimal(1), Decimal(2), "u1", "a1", Decimal(25), at(2)),
         ("p2", "Q", None, None, None, None, None, None, at(2))],
        "product_id STRING, name STRING, article STRING, weight DECIMAL(18,6), "
        "volume DECIMAL(18,6), uom_id STRING, depositor_id STRING, "
        "expected_bin_qty DECIMAL(18,6), updated TIMESTAMP_NTZ",
    )
    uoms = spark.createDataFrame([("u1", "pcs")], "uom_id STRING, name STRING")
    agents = spark.createDataFrame(
        [("a1", "Owner", "77"), ("a2", "Other", "78")], "agent_id STRING, name STRING, inn STRING"
    )
    return ledger.items(variants, products, uoms, agents)


def test_items_are_variants_and_all_products(spark, rows):
    got = items_of(spark)
    assert got.columns == ["id", *ledger.ITEM_COLUMNS]
    assert rows(got, "item_id", "name", "product", "lot", "uom", "depositor_name") == [
        ("p1", "P", None, None, "pcs", "Owner"),
        ("p2", "Q", None, None, None, None),
        ("v1", "P (L, 2024)", "P", "L", "pcs", "Owner"),
        ("v2", "P (, )", "P", None, "pcs", "Owner"),
        ("v3", " (L, )", None, "L", None, None),
    ]
    assert rows(got.filter("item_id = 'v1'"), "expected_bin_qty", "updated", "article") == [
        (Decimal(25), at(1), "A")
    ]


def test_slots_take_zone_names(spark, rows):
    directory = spark.createDataFrame(
        [("s2", "st", "z1", "B"), ("s1", "st", None, "A"), ("s3", "st", "lost", "C")],
        "slot_id STRING, store_id STRING, zone_id STRING, name STRING",
    )
    zones = spark.createDataFrame([("z1", "Z")], "zone_id STRING, name STRING")
    assert rows(ledger.slots(directory, zones)) == [
        (1, "s1", "A", None), (2, "s2", "B", "Z"), (3, "s3", "C", None),
    ]


def operation(number, **more):
    base = {
        "id": number, "doc_id": f"d{number}", "applicable": True, "moment": at(1), "number": "1",
        "agent_id": None, "store_id": "st", "item_id": "i1", "quantity": Decimal(1),
        "slot_id": "s1", "updated": at(1), "doc_type": "supply", "op_type": "in",
    }
    return {**base, **more}


def test_filter_keeps_applied_deposited_and_visible(spark, rows):
    ops = [
        operation(1), operation(2, applicable=False), operation(3, item_id="own"),
        operation(4, item_id="unknown owner"), operation(5, item_id="service"),
        operation(6, doc_id="deleted"), operation(7, doc_id="restored"),
        operation(8, doc_id="odd"), operation(9, applicable=None),
    ]
    items = spark.createDataFrame(
        [("i1", "D"), ("own", "not_3pl"), ("unknown owner", None)],
        "item_id STRING, depositor_name STRING",
    )
    audit = spark.createDataFrame(
        [("deleted", "deleted"), ("restored", "active"), ("odd", None)],
        "doc_id STRING, status STRING",
    )
    frame = ops_frame(spark, ops)
    got = ledger.filter_operations(frame, items, audit)
    assert got.columns == frame.columns
    assert rows(got, "id") == [(1,), (7,), (8,)]
    assert quality.filtered_within_all(got, frame).isEmpty()
    assert rows(quality.filtered_within_all(frame, got)) == [(9, 3, 6)]


def test_unify_numbers_rows_and_names_missing_slots(spark, rows):
    columns = op_frame_columns()[1:] + ["position"]
    ops = [
        operation(0, doc_id="b", slot_id=None), operation(0, doc_id="a", op_type="out"),
        operation(0, doc_id="a"),
    ]
    frames = [
        ops_frame(spark, [op]).selectExpr(*columns[:-1], f"{i} AS position")
        for i, op in enumerate(ops)
    ]
    got = ledger.unify_operations(frames)
    assert rows(got, "id", "doc_id", "op_type", "slot_id") == [
        (1, "a", "in", "s1"), (2, "a", "out", "s1"), (3, "b", "in", "off_slot"),
    ]
    assert quality.union_matches_documents(got, frames).isEmpty()
    assert not quality.union_matches_documents(got, frames[:2]).isEmpty()


def test_equal_positions_of_one_document_follow_their_ordinal(spark):
    columns = op_frame_columns()[1:]
    plus = ops_frame(spark, [operation(0, doc_id="d", quantity=Decimal(q)) for q in (7, -3, 2)])
    # The same document, item and direction: only the position tells them apart.
    placed = plus.selectExpr(*columns, "CAST(10 - quantity AS INT) AS position")
    ops = ledger.split_movements(ledger.unify_operations([placed]))
    got = ledger.running_balances(ops).orderBy("id").collect()
    assert [int(r["quantity"]) for r in got] == [7, 2, -3]
    assert [int(r["close_slot_balance"]) for r in got] == [7, 9, 6]


@pytest.fixture(scope="module")
def balanced(spark):
    ops = [
        operation(1, quantity=Decimal(5), agent_id="a1"),
        operation(2, quantity=Decimal(-7), doc_type="demand", moment=at(2)),
        operation(3, quantity=Decimal(2), slot_id="off_slot", moment=at(3)),
        operation(4, quantity=Decimal(-9), doc_type="move", slot_id="off_slot", moment=at(4)),
        operation(5, quantity=Decimal(9), doc_type="move", slot_id="lost", moment=at(4)),
    ]
    slots = spark.createDataFrame(
        [("s1", "A", None)], "slot_id STRING, slot_name STRING, zone_name STRING"
    )
    agents = spark.createDataFrame([("a1", "Ag", "77")], "agent_id STRING, name STRING, inn STRING")
    stores = spark.createDataFrame([("st", "Store")], "store_id STRING, name STRING")
    return ledger.operations_with_balance(
        ops_frame(spark, ops), items_frame(spark, ops), slots, agents, stores
    ).cache()


def test_operations_carry_attributes_and_anomalies(balanced, rows):
    assert balanced.columns == ledger.OPERATION_COLUMNS
    error, warning = "OPER_ERROR: slot overdraft", "OPER_WARNING: Out-of-slot operation"
    got = rows(balanced, "id", "slot_id", "slot_name", "zone_name", "agent_name", "slot_oper_errors")
    assert got == [
        (1, "s1", "A", "off_zone", "Ag", ""),
        (2, "s1", "A", "off_zone", None, error),
        (3, "off_slot", "off_slot", "off_zone", None, warning),
        (4, "off_slot", "off_slot", "off_zone", None, f"{error} | {warning}"),
        (5, "lost", "off_slot", "off_zone", None, ""),
    ]


def test_moves_change_slots_but_not_totals(balanced, rows):
    got = rows(balanced, "id", "close_slot_balance", "open_total_balance", "close_total_balance")
    assert [tuple(map(int, r)) for r in got] == [
        (1, 5, 0, 5), (2, -2, 5, -2), (3, 2, -2, 0), (4, -7, 0, 0), (5, 9, 0, 0),
    ]


def test_marts_of_operations(balanced, rows):
    whole = marts.operations_mart(balanced)
    assert len(whole.columns) == 32
    assert quality.mart_matches_operations(whole, balanced).isEmpty()
    assert not quality.mart_matches_operations(whole.limit(2), balanced).isEmpty()
    partner = marts.partner_movements(balanced)
    assert partner.columns == marts.PARTNER_COLUMNS
    assert [int(r["close_balance"]) for r in marts.ordered(partner, "partner_movements").collect()] \
        == [5, -2, 0]
    assert quality.partners_match_operations(partner, balanced).isEmpty()
    assert quality.partners_without_moves(partner).isEmpty()
    errors = marts.operation_errors(balanced)
    assert errors.columns == marts.OPERATION_ERROR_COLUMNS
    assert rows(errors, "id_operations_with_balance__slot_item") == [(2,), (3,), (4,)]
    assert quality.errors_without_tag(errors).isEmpty()
