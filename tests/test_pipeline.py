import datetime as dt
import json
import os
import random

import pytest

from slotledger import schemas as S
from slotledger.__main__ import main
from slotledger.operators import bronze, spine, upsert
from slotledger.operators.marts import READING_ORDER
from slotledger.operators.quality import QualityError
from slotledger.plans.pipeline import Warehouse
from slotledger.session import shared_folder
from slotledger.sources.raw import entity_scan, read_landing, read_raw, tag
from slotledger.sources.tables import TableStore
from slotledger.streaming import ingest_stream
from slotledger.streaming.ingest import each_once, newest, take_in
from tests.objects import at, first_day, position, second_day

AS_OF = dt.date(2024, 1, 10)


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """A warehouse after two daily runs, and the source as it then is."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("two")), AS_OF)
    source = first_day()
    source.event("puttorecyclebin", "r1", at(3))  # ignored: nothing has been loaded yet
    warehouse.run(source.frame(spark))
    first = warehouse.table("gold", "focus_slots_used_monthly").collect()
    second_day(source)
    source.event("puttorecyclebin", "o1", at(8))
    warehouse.run(source.frame(spark))
    return warehouse, source, first


def ledger_rows(warehouse, rows):
    return rows(
        warehouse.table("silver", "operations"),
        "doc_name", "doc_type", "slot_id", "quantity", "close_slot_balance",
        "close_total_balance", "slot_oper_errors", "agent_name",
    )


def test_first_day_bills_two_slots(two_days):
    _, _, first = two_days
    # s1 is held from the 2nd to the 4th, s2 from the 5th to the 10th
    assert [tuple(r) for r in first] == [("Owner", "2024-01", 9)]


def test_second_day_takes_in_edits_and_deletions(two_days, rows):
    warehouse, _, _ = two_days
    got = [(r[0], int(r[3]), int(r[4]), int(r[5]), r[7]) for r in ledger_rows(warehouse, rows)]
    assert got == [
        ("Nl1", -1, 1, 4, "Owner Ltd"),
        ("Nm1", -3, 3, 6, None),
        ("Nm1", 3, 3, 6, None),
        ("No2", -1, 2, 5, "Owner Ltd"),
        ("Nr1", 6, 6, 6, "Owner Ltd"),
    ]
    assert rows(warehouse.table("bronze", "agents"), "agent_id", "name") == [
        ("a1", "Owner Ltd"), ("a2", "not_3pl"),
    ]


def test_month_arrays_are_stored_once(two_days, rows):
    warehouse, _, _ = two_days
    tiles = warehouse.table("silver", "spine_tiles")
    assert not {"_opens", "_closes", "_counts"} & set(tiles.columns)
    totals = warehouse.table("silver", "item_month_totals")
    counts = warehouse.table("silver", "slot_month_counts")
    assert totals.count() == totals.select("item_id", "month").distinct().count() > 0
    assert counts.count() == counts.select("store_id", "slot_id", "month").distinct().count() > 0
    whole = spine.daily_spine(
        warehouse.table("silver", "operations"), warehouse.table("silver", "items_all"),
        warehouse.table("silver", "slots_all"), warehouse.table("bronze", "stores"), AS_OF,
    )
    assert rows(warehouse.spine()) == rows(whole)


def test_checks_read_tiles_without_a_shuffle(two_days, rows):
    """No rule reads slot counts, and few item totals go to the tiles whatever the session broadcasts."""
    warehouse, _, _ = two_days
    spark, setting = warehouse.spark, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        days = spine.read_spine(warehouse.tiles(counted=False)).drop("items_in_slot", "slot_balance_errors")
        assert "Exchange hashpartitioning" not in days._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert rows(days) == rows(warehouse.spine().select(*days.columns))


def test_daily_loads_equal_one_full_load(two_days, spark, tmp_path, rows):
    warehouse, source, _ = two_days
    source.objects = {k: v for k, v in source.objects.items() if k != ("counterparty", "a3")}
    whole = Warehouse(spark, str(tmp_path), AS_OF, hot_rows=1)  # every group counts as hot
    whole.store.write(source.frame(spark), "raw", "raw")
    whole.build_bronze()
    # Events before the first load are of no concern to the daily runs.
    audit = whole.table("bronze", "audit_deleted").filter("doc_id = 'o1'")
    whole.store.write(audit, "bronze", "audit_deleted")
    whole.build_silver()
    assert ledger_rows(whole, rows) == ledger_rows(warehouse, rows)
    assert rows(whole.spine()) == rows(warehouse.spine())
    for name in ("items_all", "slots_all"):
        assert rows(whole.table("silver", name)) == rows(warehouse.table("silver", name))


def test_views_read_the_stored_tables(two_days, spark, rows):
    warehouse, _, _ = two_days
    shown = spark.sql("SELECT * FROM warehouse_balance_daily")
    assert rows(shown) == rows(warehouse.balance_daily()) and shown.count() > 0
    by_item = spark.sql("SELECT * FROM warehouse_balance_daily_no_slots")
    assert rows(by_item, "item_name", "moment_day")[0][0] == "P1 (L1, )"


def test_all_marts_can_be_read_in_order(two_days):
    warehouse, _, _ = two_days
    for mart in READING_ORDER:
        got = warehouse.ordered(mart)
        shown = [tuple(r[c] for c in READING_ORDER[mart]) for r in got.collect()]
        keys = [[(v is None, v) for v in row] for row in shown]
        assert shown or mart.endswith("errors")
        assert all(a <= b for a, b in zip(keys, keys[1:])), mart


def test_run_log_and_requests(two_days):
    warehouse, _, _ = two_days
    log = warehouse.store.run_log().orderBy("id").collect()
    assert [(r["id"], r["status"]) for r in log] == [(1, "ok"), (2, "ok")]
    assert all(r["total_run_time"] == r["finished_at"] - r["started_at"] for r in log)
    step = dt.timedelta(milliseconds=1)
    assert warehouse.requests()["supply"] == dt.datetime(2024, 1, 6) + step
    assert warehouse.audit_since() == dt.datetime(2024, 1, 7) + step


def test_rerun_on_the_same_batch_changes_nothing(two_days, spark, rows):
    warehouse, source, _ = two_days
    before = {n: rows(warehouse.table("bronze", n)) for n in ("supply", "agents", "audit_deleted")}
    assert not warehouse.land(source.frame(spark).limit(0))  # empty: the old batch stays
    warehouse.build_bronze()
    for name, old in before.items():
        assert rows(warehouse.table("bronze", name)) == old


def test_failed_check_stops_the_run_and_is_logged(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    source = first_day()
    source.document("supply", "bad", at(3), {"quantity": 1, "assortment": {}})
    with pytest.raises(QualityError) as raised:
        warehouse.run(source.frame(spark))
    assert raised.value.found == {"not_null.supply.item_id": 1}
    assert not warehouse.store.exists("silver", "operations_all")
    assert [r["status"] for r in warehouse.store.run_log().collect()] == ["error"]


def test_document_resent_without_positions(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    source = first_day()
    warehouse.land(source.frame(spark))
    warehouse.build_bronze()
    source.document("demand", "o1", at(4), updated=at(9))
    warehouse.land(source.frame(spark))
    raw = warehouse.table("raw", "raw")
    warehouse.load_table(raw, "demand")
    assert rows(warehouse.table("bronze", "demand"), "doc_id") == [("o1",)]
    warehouse.load_table(raw, "demand", strict=True)
    assert warehouse.table("bronze", "demand").isEmpty()


def test_full_refresh_forgets_what_the_batch_lacks(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    source = first_day()
    warehouse.land(source.frame(spark))
    warehouse.build_bronze()
    source.put("uom", "u2", name="kg", updated=at(9))
    warehouse.land(source.frame(spark))
    raw = warehouse.table("raw", "raw")
    warehouse.load_table(raw, "uoms")
    assert rows(warehouse.table("bronze", "uoms"), "uom_id") == [("u1",), ("u2",)]
    warehouse.load_table(raw, "uoms", full_refresh=True)
    assert rows(warehouse.table("bronze", "uoms"), "uom_id") == [("u2",)]


def test_a_key_twice_in_a_batch_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    raw = first_day().frame(spark)
    warehouse.load_table(raw, "uoms")
    twice = spark.createDataFrame(
        [("uom", f'{{"id": "u9", "name": "{n}", "updated": "{at(9)}"}}') for n in "xy"], S.RAW
    )
    with pytest.raises(ValueError, match="uoms"):
        warehouse.load_table(twice, "uoms")


def test_command_line_runs_a_day(spark, tmp_path):
    frame = first_day().frame(spark)
    entities = ["store", "uom", "product", "variant", "counterparty", "demand", "supply", "move"]
    for entity in entities:
        objects = frame.filter(f"entity = '{entity}'").select("raw_json")
        objects.write.text(str(tmp_path / "in" / entity))
    arguments = ["--landing", str(tmp_path / "in"), "--root", str(tmp_path / "out"), "--as-of", "2024-01-10"]
    main(arguments)  # folders of other entities and of the audit are missing: a cold start
    store = TableStore(spark, str(tmp_path / "out"))
    billed = store.read("gold", "focus_slots_used_monthly")
    assert [tuple(r) for r in billed.collect()] == [("Owner", "2024-01", 9)]
    href = {"meta": {"href": "https://h/entity/supply/r1"}}
    event = {"eventType": "puttorecyclebin", "entityType": "supply", "name": "r1", "entity": href}
    context = json.dumps({"moment": at(9), "events": [{"eventType": "update"}, event]})
    spark.createDataFrame([(context,)], "value string").write.text(str(tmp_path / "in" / "audit"))
    main(arguments)  # the audit has landed: the document is deleted
    assert [r.doc_id for r in store.read("bronze", "audit_deleted").collect()] == ["r1"]
    assert store.read("silver", "operations_filtered").filter("doc_id = 'r1'").isEmpty()


def test_steps_leave_no_scratch(spark, tmp_path):
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    warehouse.land(first_day().frame(spark))
    warehouse.build_bronze()
    warehouse.build_silver()
    warehouse.build_gold()
    assert set(os.listdir(folder)) == before


# --- upserts ---------------------------------------------------------------

def test_merge_updates_adds_and_keeps(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k INT, v STRING")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k INT, v STRING")
    assert rows(upsert.merge_by_key(old, new, ["k"])) == [
        (1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n"),
    ]


def test_documents_are_replaced_as_a_whole(spark, rows):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1)], "doc_id STRING, p INT")
    new = spark.createDataFrame([("a", 9), ("d", 1)], "doc_id STRING, p INT")
    assert rows(upsert.replace_by_document(old, new)) == [("a", 9), ("b", 1), ("c", 1), ("d", 1)]
    sent = spark.createDataFrame([("a",), ("c",), ("d",)], "doc_id STRING")
    assert rows(upsert.replace_by_document(old, new, sent)) == [("a", 9), ("b", 1), ("d", 1)]


def test_slices_taken_in_one_by_one_equal_the_last_state(spark, rows):
    """Random documents, edited over several batches: only their last versions remain."""
    rng = random.Random(7)
    state, batches = {}, []
    for version in range(4):
        sent = {f"d{rng.randint(0, 40)}" for _ in range(15)}
        for doc in sent:
            state[doc] = [(doc, place, version) for place in range(rng.randint(1, 3))]
        batches.append([row for doc in sorted(sent) for row in state[doc]])
    shape = "doc_id STRING, place INT, version INT"
    documents = spark.createDataFrame(batches[0], shape)
    firsts = documents.filter("place = 0")
    for batch in batches[1:]:
        frame = spark.createDataFrame(batch, shape)
        documents = upsert.replace_by_document(documents, frame)
        firsts = upsert.merge_by_key(firsts, frame.filter("place = 0"), ["doc_id"])
    last = sorted(row for rows_ in state.values() for row in rows_)
    assert sorted(map(tuple, documents.collect())) == last
    assert sorted(map(tuple, firsts.collect())) == [row for row in last if row[1] == 0]


def test_watermarks(spark):
    table = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0, 490000),), (None,)], "updated TIMESTAMP_NTZ"
    )
    seen = upsert.high_watermark(table)
    assert upsert.next_request(table) - seen == dt.timedelta(milliseconds=1)
    assert upsert.next_request(table.limit(0)) is None and upsert.next_request(None) is None
    assert upsert.newer_than(table, "updated", seen).isEmpty()
    assert upsert.newer_than(table, "updated", None).count() == 1
    assert upsert.changed_since(table, "updated", seen).count() == 1
    assert upsert.changed_since(table, "updated", None).count() == 2


# --- tables ----------------------------------------------------------------

def test_a_table_can_be_replaced_from_itself(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(3), "silver", "t")
    for _ in range(3):
        store.write(store.read("silver", "t").selectExpr("id + 1 AS id"), "silver", "t")
    assert rows(store.read("silver", "t")) == [(3,), (4,), (5,)]
    assert [number for number, _, _ in store.versions("silver", "t")] == [3, 4]


def test_an_incomplete_version_is_not_seen(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(2), "silver", "t")
    (tmp_path / "silver" / "t" / "v=00000002").mkdir()
    assert store.read("silver", "t").count() == 2
    store.write(spark.range(5), "silver", "t")
    assert store.read("silver", "t").count() == 5
    with pytest.raises(FileNotFoundError):
        store.read("silver", "missing")


def test_raw_is_pruned_by_entity(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    warehouse.land(first_day().frame(spark))
    scan = entity_scan(warehouse.table("raw", "raw"), "move")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(entity" in plan
    assert scan.count() == 1


def test_some_days_of_the_spine_read_their_months_only(two_days):
    warehouse, _, _ = two_days
    some = warehouse.spine(dt.date(2024, 1, 3), dt.date(2024, 1, 4))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert {r["moment_day"].day for r in some.collect()} == {3, 4}


def test_an_empty_table_keeps_its_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    empty = spark.range(0).selectExpr("id", "id % 2 AS half")
    assert store.write(empty, "silver", "t", by="half").columns == ["id", "half"]
    assert store.read("silver", "t").isEmpty()


def test_landed_files_become_one_raw_table(spark, tmp_path, rows):
    frame = first_day().frame(spark)
    for entity in ("uom", "move"):
        frame.filter(f"entity = '{entity}'").select("raw_json").write.text(str(tmp_path / entity))
    raw = read_landing(spark, {e: str(tmp_path / e) for e in ("uom", "move")})
    assert rows(raw, "entity") == [("move",), ("uom",)]
    raw.write.json(str(tmp_path / "raw"))
    assert rows(read_raw(spark, str(tmp_path / "raw"), "json")) == rows(raw)
    assert rows(tag(raw.select("raw_json"), "x"), "entity") == [("x",), ("x",)]


# --- streaming -------------------------------------------------------------

def test_stream_takes_each_file_once(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path / "w"), AS_OF)
    source, landing, state = first_day(), str(tmp_path / "in"), str(tmp_path / "state")
    source.frame(spark).coalesce(1).write.mode("append").json(landing)
    ingest_stream(warehouse, landing, state).awaitTermination()
    second_day(source)
    source.frame(spark).coalesce(1).write.mode("append").json(landing)
    ingest_stream(warehouse, landing, state).awaitTermination()
    ingest_stream(warehouse, landing, state).awaitTermination()
    assert rows(warehouse.table("bronze", "supply"), "doc_id", "position", "quantity") == [
        ("r1", 0, 6), ("r2", 0, 9),
    ]
    assert rows(warehouse.table("bronze", "agents"), "agent_id", "name") == [
        ("a1", "Owner Ltd"), ("a2", "not_3pl"), ("a3", "Late"),
    ]
    assert [n for n, _, _ in warehouse.store.versions("bronze", "supply")] == [1, 3]  # half of it was new


def test_a_repeated_batch_is_passed_over(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    source = first_day()
    take_in(warehouse, source.frame(spark), 0)
    take_in(warehouse, source.frame(spark), 0)
    assert [n for n, _, _ in warehouse.store.versions("bronze", "demand")] == [1]
    source.document("demand", "o1", at(4), position("v1", 9, "s1"), updated=at(8))
    take_in(warehouse, source.frame(spark), 1)
    assert rows(warehouse.table("bronze", "demand"), "quantity") == [(-9,)]


def test_objects_and_versions_of_one_batch_count_once(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    source = first_day()
    old = source.frame(spark)
    source.document("demand", "o1", at(4), position("v1", 9, "s1"), position("v1", 9, "s1"), updated=at(8))
    batch = old.unionByName(source.frame(spark)).unionByName(old)
    take_in(warehouse, batch, 0)
    found = warehouse.table("bronze", "demand")
    assert rows(found.filter("doc_id = 'o1'"), "position", "quantity") == [(0, -9), (1, -9)]
    assert found.groupBy("doc_id", "position").count().filter("count > 1").isEmpty()
    assert rows(each_once(batch)) == rows(batch.distinct())


def test_rows_of_a_batch_are_not_shuffled_for_their_versions(spark, tmp_path):
    landed = first_day().frame(spark)
    landed.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.schema(landed.schema).parquet(str(tmp_path / "raw"))
    parse, keys, how, changed = bronze.TABLES["demand"]
    plan = newest(parse(each_once(raw), None), keys, how, changed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_an_older_file_does_not_overwrite(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)

    def agents(*versions):
        body = [(f'{{"id": "{i}", "name": "{n}"' + (f', "updated": "{u}"' if u else "") + "}",) for i, n, u in versions]
        return tag(spark.createDataFrame(body, "raw_json string"), "counterparty")

    take_in(warehouse, agents(("a", "new", at(9)), ("b", "undated", None), ("c", "x", at(1)), ("c", "y", at(1))), 0)
    take_in(warehouse, agents(("a", "old", at(2)), ("b", "dated", at(1)), ("d", "first", None), ("d", "first", None)), 0)
    take_in(warehouse, agents(("b", "undated again", None), ("d", "late", None)), 1)
    found = rows(warehouse.table("bronze", "agents"), "agent_id", "name")
    assert found == [("a", "new"), ("b", "dated"), ("c", "y"), ("d", "first")]


def test_missing_keys_are_kept_once(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    event = '{"doc_id": null, "entity_type": "demand", "event_type": "puttorecyclebin", "name": "%s", "moment": %s}'

    def deletions(*events):
        return tag(spark.createDataFrame([(event % e,) for e in events], "raw_json string"), "audit_deleted")

    take_in(warehouse, deletions(("1", "null"), ("2", '"2024-01-01 00:00:00"')), 0)
    take_in(warehouse, deletions(("3", "null"), ("4", '"2024-01-01 00:00:00"'), ("5", '"2024-01-02 00:00:00"')), 1)
    assert rows(warehouse.table("bronze", "audit_deleted"), "name") == [("1",), ("2",), ("5",)]


def test_a_second_checkpoint_loses_nothing(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path / "w"), AS_OF)
    source, landing = first_day(), str(tmp_path / "in")
    for day, state in enumerate(("one", "one", "two")):
        if day:
            source.document("demand", f"late{day}", at(4), position("v1", 1, "s1"), updated=at(8 + day))
        source.frame(spark).coalesce(1).write.mode("append").json(landing)
        ingest_stream(warehouse, landing, str(tmp_path / state)).awaitTermination()
    found = rows(warehouse.table("bronze", "demand").select("doc_id").distinct())
    assert {("late1",), ("late2",)} <= set(found)
    assert warehouse.table("bronze", "demand").groupBy("doc_id", "position").count().filter("count > 1").isEmpty()


def test_a_first_load_with_a_key_twice_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), AS_OF)
    raw = tag(spark.createDataFrame([('{"id": "a", "name": "x"}',), ('{"id": "a", "name": "y"}',)], "raw_json string"), "uom")
    with pytest.raises(ValueError, match="more than once"):
        warehouse.load_table(raw, "uoms")
