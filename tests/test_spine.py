import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from slotledger import schemas as S
from slotledger.functions import balance_tags
from slotledger.operators import billing, ledger, marts, quality, spine
from slotledger.plans.queries import QUERIES
from slotledger.plans.sample_ledger import SampleLedger
from tests import brute
from tests.ledgers import AS_OF, items_frame, ops_frame, owners, random_ops

FLOWS = ["quantity", "real_in", "move_in", "real_out", "move_out"]
SHOWN = [
    *S.GRAIN, "moment_day", "open_slot_balance", "close_slot_balance", "open_total_balance",
    "close_total_balance", *FLOWS,
]


@pytest.fixture(scope="module")
def case(spark):
    ops = random_ops(range(60))
    daily = spine.daily_movements(ledger.split_movements(ops_frame(spark, ops))).cache()
    return ops, daily, brute.dense(ops, AS_OF)


def numeric(df, grid, columns):
    def key(row):
        return tuple(
            float(row[c]) if isinstance(row[c], (Decimal, int)) else str(row[c]) for c in columns
        )

    got = sorted(key(r) for r in df.select(*columns).collect())
    want = sorted(key(r) for r in grid)
    assert got == want
    return True


def test_dense_grid(case):
    _, daily, grid = case
    assert numeric(spine.daily_balances_dense(daily, AS_OF), grid, SHOWN)


def test_intervals_unfold_to_the_used_days(case):
    _, daily, grid = case
    kept = [row for row in grid if row["is_used"]]
    assert numeric(
        spine.daily_balances(daily, AS_OF), kept, [*SHOWN, "is_used", "items_in_slot"]
    )


def test_flags_on_the_whole_grid(case):
    _, daily, grid = case
    columns = [*S.GRAIN, "moment_day", "close_slot_balance", "real_out", "is_used"]
    flagged = spine.occupancy_days(daily, AS_OF)
    assert numeric(flagged, grid, columns)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate explode(sequence(first_day")]


def test_date_spine_stops_at_the_reporting_day(spark, case):
    _, daily, grid = case
    assert numeric(spine.date_spine(daily, AS_OF), grid, [*S.GRAIN, "moment_day"])
    early = spine.date_spine(daily, dt.date(2020, 1, 1))
    assert early.isEmpty()
    assert spine.daily_balances(daily, dt.date(2020, 1, 1)).isEmpty()


def test_billing_counts_distinct_slots(spark, case):
    ops, daily, grid = case
    intervals = spine.balance_intervals(daily, AS_OF)
    got = billing.slots_used_daily(intervals, items_frame(spark, ops)).collect()
    assert {(r["depositor_id"], r["moment_day"]): r["slots_used_day"] for r in got} == brute.used(
        grid, owners(ops)
    )
    assert {r["depositor_name"] for r in got} == {f"Name {r['depositor_id']}" for r in got}


def test_rollup_without_slots(spark, case):
    ops, daily, grid = case
    intervals = spine.balance_intervals(daily, AS_OF)
    got = marts.balance_daily_no_slots_from_intervals(
        daily, intervals, items_frame(spark, ops), AS_OF
    ).collect()
    seen = {
        (r["item_name"][5:], r["moment_day"]):
            (r["open_total_balance"], r["real_quantity"], r["close_total_balance"])
        for r in got
    }
    assert len(seen) == len(got)
    assert seen == brute.rollup(grid)


def directories(spark, ops):
    slots = spark.createDataFrame(
        [("s0-0", "Slot A", "Zone"), ("s1-0", "Slot B", None)],
        "slot_id STRING, slot_name STRING, zone_name STRING",
    )
    stores = spark.createDataFrame([("st0-0", "Store")], "store_id STRING, name STRING")
    return items_frame(spark, ops), slots, stores


def test_enriched_spine_is_numbered_in_order(spark, case):
    ops, _, grid = case
    split = ledger.split_movements(ops_frame(spark, ops))
    got = spine.daily_spine(split, *directories(spark, ops), AS_OF).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, len(got) + 1))
    keys = [(r["store_id"], r["slot_id"], r["item_id"], r["moment_day"]) for r in got]
    assert keys == sorted(keys)
    assert len(got) == sum(1 for row in grid if row["is_used"])
    for r in got:
        tags = []
        if r["items_in_slot"] > 1:
            tags.append("BALANCE_WARNING: slot has > 1 items")
        expected = r["expected_bin_qty"]
        if r["close_slot_balance"] > 0 and expected is not None and r["close_slot_balance"] != expected:
            tags.append("BALANCE_WARNING: unexpected slot balance")
        assert r["slot_balance_errors"] == " | ".join(tags)
        known = {"s0-0": ("Slot A", "Zone"), "s1-0": ("Slot B", "off_zone")}
        assert (r["slot_name"], r["zone_name"]) == known.get(r["slot_id"], ("off_slot", "off_zone"))


def test_reading_some_days_equals_filtering(spark, case, rows):
    ops, _, _ = case
    split = ledger.split_movements(ops_frame(spark, ops))
    tiles = spine.spine_tiles(split, *directories(spark, ops), AS_OF).cache()
    first, last = dt.date(2024, 2, 10), dt.date(2024, 3, 5)
    some = spine.read_spine(tiles, first, last)
    whole = spine.read_spine(tiles).filter(f"moment_day BETWEEN '{first}' AND '{last}'")
    assert rows(some) == rows(whole)


def test_the_grid_is_never_shuffled(spark, case):
    ops, daily, _ = case
    split = ledger.split_movements(ops_frame(spark, ops))
    tiles = spine.spine_tiles(split, *directories(spark, ops), AS_OF)
    plan = spine.read_spine(tiles)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate explode(sequence(from_day")]
    assert "Exchange" not in above and "Join" not in above and "Sort" not in above
    intervals = spine.balance_intervals(daily, AS_OF)
    for compact in (
        intervals, spine.item_totals(daily, AS_OF), spine.month_tiles(daily, intervals, AS_OF),
        billing.slots_used_daily(intervals, items_frame(spark, ops)),
    ):
        assert "SinglePartition" not in compact._jdf.queryExecution().executedPlan().toString()


def op(number, day, quantity, kind="supply", **more):
    base = {
        "id": number, "doc_id": f"d{number}", "applicable": True, "number": "1",
        "moment": dt.datetime(2024, 3, day), "agent_id": None, "store_id": "st", "item_id": "i1",
        "quantity": Decimal(quantity), "slot_id": "s1", "updated": dt.datetime(2024, 3, day),
        "doc_type": kind, "op_type": "in" if quantity > 0 else "out",
    }
    return {**base, **more}


def days(spark, ops, as_of=dt.date(2024, 3, 10)):
    daily = spine.daily_movements(ledger.split_movements(ops_frame(spark, ops)))
    return spine.daily_balances(daily, as_of)


def test_stock_in_and_moved_on_the_same_day_vanishes_but_counts_in_the_total(spark, rows):
    ops = [op(1, 1, 5), op(2, 1, -5, "move"), op(3, 1, 5, "move", slot_id="s2")]
    got = rows(days(spark, ops, dt.date(2024, 3, 1)), "slot_id", "close_total_balance")
    assert got == [("s2", Decimal(5))]


def test_emptied_by_shipment_and_move_counts_as_used(spark, rows):
    ops = [op(1, 1, 5), op(2, 2, -2, "demand"), op(3, 2, -3, "move")]
    assert rows(days(spark, ops), "moment_day", "is_used") == [
        (dt.date(2024, 3, 1), 1), (dt.date(2024, 3, 2), 1),
    ]


def test_overdraft_is_impossible_stock(spark, rows):
    got = rows(days(spark, [op(1, 9, -1, "demand")]), "moment_day", "close_slot_balance", "is_used")
    assert got == [
        (dt.date(2024, 3, 9), Decimal(-1), 2), (dt.date(2024, 3, 10), Decimal(-1), 2),
    ]


def test_two_items_in_a_slot_and_stock_without_a_slot(spark, rows):
    ops = [
        op(1, 10, 5), op(2, 10, 5, item_id="i2"),
        op(3, 10, 5, slot_id="off_slot"), op(4, 10, 5, slot_id="off_slot", store_id="st2"),
    ]
    assert rows(days(spark, ops), "store_id", "slot_id", "items_in_slot") == [
        ("st", "off_slot", 0), ("st", "s1", 2), ("st", "s1", 2), ("st2", "off_slot", 0),
    ]


def test_anomalies_of_the_last_anomalous_day(spark, rows):
    ops = [op(1, 3, 1), op(2, 4, 1)]  # expected 2: wrong on day 3 only
    items, slots, stores = directories(spark, ops)
    tiles = spine.spine_tiles(
        ledger.split_movements(ops_frame(spark, ops)), items, slots, stores, dt.date(2024, 3, 5)
    )
    for errors in (
        marts.balance_errors(spine.read_spine(tiles)), marts.balance_errors_from_tiles(tiles),
    ):
        assert rows(errors, "moment_day", "close_slot_balance") == [
            (dt.date(2024, 3, 3), Decimal(1))
        ]
    clean = tiles.filter("close_slot_balance = 2")
    assert marts.balance_errors_from_tiles(clean).isEmpty()


def test_last_anomalous_day_of_each_tile(spark, case):
    ops, _, _ = case
    split = ledger.split_movements(ops_frame(spark, ops))
    tiles = spine.spine_tiles(split, *directories(spark, ops), AS_OF).cache()
    key = ["store_id", "slot_id", "item_id", "month"]
    got = tiles.groupBy(*key).agg(F.max(spine.last_anomalous_day()).alias("last")).dropna()
    rows = spine.read_spine(tiles).filter("slot_balance_errors != '' AND close_slot_balance != 0")
    want = rows.groupBy(
        "store_id", "slot_id", "item_id", F.trunc("moment_day", "MM").alias("month")
    ).agg(F.max("moment_day").alias("last"))
    assert got.count() > 50
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_monthly_places_of_two_depositors_with_one_name(spark, rows):
    used = spark.createDataFrame(
        [("a", "N", dt.date(2024, 1, 31), 2), ("a", "N", dt.date(2024, 2, 1), 3),
         ("b", "N", dt.date(2024, 1, 30), 4), ("a", "N", dt.date(2024, 1, 30), 1)],
        "depositor_id STRING, depositor_name STRING, moment_day DATE, slots_used_day BIGINT",
    )
    assert rows(billing.slots_used_monthly(used)) == [
        ("N", "2024-01", 3), ("N", "2024-01", 4), ("N", "2024-02", 3),
    ]


def grid_steps(frame, unfolded):
    """The plan above the step that makes days of stretches."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index(f"Generate explode(sequence({unfolded}")]


def test_dense_grid_is_neither_sorted_nor_shuffled(case):
    _, daily, _ = case
    steps = grid_steps(spine.daily_balances_dense(daily, AS_OF), "from_day")
    assert "Exchange" not in steps and "Sort" not in steps and "Window" not in steps


def test_months_of_a_grain_are_summed_where_its_days_unfold(case):
    _, daily, _ = case
    month = F.trunc("moment_day", "month").alias("month")
    for rows, unfolded in (
        (spine.daily_balances_dense(daily, AS_OF), "from_day"),
        (spine.daily_balances(daily, AS_OF), "from_day"),
        (spine.occupancy_days(daily, AS_OF), "first_day"),
    ):
        assert "Exchange" not in grid_steps(rows.groupBy(*S.GRAIN, month).count(), unfolded)


def test_few_item_totals_spare_the_tiles_a_shuffle(spark, case, monkeypatch):
    _, daily, _ = case
    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)

    def built():
        intervals = spine.balance_intervals(daily, AS_OF)
        return (
            spine.unfold(spine.month_tiles(daily, intervals, AS_OF)).select(*SHOWN),
            spine.daily_balances_dense(daily, AS_OF).select(*SHOWN),
        )

    spark.conf.set(limit, "-1")
    try:
        sent = built()
        for grid in sent:
            steps = grid_steps(grid.groupBy(*S.GRAIN).count(), "from_day")
            assert "Exchange" not in steps
        assert all("SortMergeJoin" not in spark_plan(grid) for grid in sent)
        monkeypatch.setattr(spine, "SENT_TOTALS", 0)
        joined = built()
        assert all("SortMergeJoin" in spark_plan(grid) for grid in joined)
        for one, other in zip(sent, joined):
            assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    finally:
        spark.conf.set(limit, usual)


def test_slot_names_spare_the_tiles_a_shuffle(spark, case, monkeypatch):
    ops, _, _ = case
    split = ledger.split_movements(ops_frame(spark, ops))
    items, slots, stores = directories(spark, ops)
    # Most slots are unknown to the directory; one entry bears the name of goods off the slots.
    listed = slots.unionByName(
        slots.limit(1).withColumns({"slot_id": F.lit(S.OFF_SLOT), "slot_name": F.lit("odd")})
    )
    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)
    shown = [c for c in spine.SPINE_COLUMNS if c != "id"]
    spark.conf.set(limit, "-1")
    try:
        tiles = spine.spine_tiles(split, F.broadcast(items), listed, F.broadcast(stores), AS_OF)
        plan = spark_plan(tiles)
        above = plan[: plan.index("Generate explode(sequence(trunc(first_day")]
        assert "SortMergeJoin" not in above and "Exchange hashpartitioning" not in above
        together = spine.read_spine(tiles).select(*shown)
        monkeypatch.setattr(spine, "_places_fit", lambda rows, hot_rows, keys=spine._PLACE: keys == spine._PLACE)
        apart = spine.read_spine(
            spine.spine_tiles(split, items, listed, stores, AS_OF)
        ).select(*shown)
        assert together.count() > 100
        assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty()
        names = {r[0] for r in together.filter(F.col("slot_id") == S.OFF_SLOT).select("slot_name").distinct().collect()}
        assert names == {S.OFF_SLOT}
    finally:
        spark.conf.set(limit, usual)


def test_parts_grow_with_the_rows(case, monkeypatch):
    _, daily, _ = case
    monkeypatch.setattr(spine, "PART_ROWS", 1)
    assert spine.by_place(daily).rdd.getNumPartitions() == daily.count()


def test_slots_of_many_rows_give_the_same_tiles(case, rows):
    _, daily, _ = case
    intervals = spine.balance_intervals(daily, AS_OF)
    shown = [*S.GRAIN, "month", "from_day", "to_day", "close_slot_balance", "_opens", "_closes"]
    counts = F.transform(F.sequence(F.lit(0), F.lit(30)), lambda d: F.coalesce(F.get("_counts", d), F.lit(0)))
    plain, hot = (
        rows(spine.month_tiles(daily, intervals, AS_OF, hot).select(*shown, counts.alias("counts")))
        for hot in (10**6, 1)
    )
    assert plain == hot and any(any(r[-1]) for r in plain)


def test_days_are_checked_against_one_another_where_they_unfold(case):
    _, daily, _ = case
    intervals = spine.number_intervals(spine.balance_intervals(daily, AS_OF))
    days = spine.unfold(spine.month_tiles(daily, intervals, AS_OF))
    for check in (quality.spine_duplicate_grain, quality.spine_day_continuity):
        assert "Exchange" not in grid_steps(check(days), "from_day")
        assert check(days).isEmpty()


def test_directories_of_the_sample_are_stored_once(spark):
    sample = SampleLedger(spark, "/root/testdata/sf0.001")
    assert sample.items() is sample.items() and sample.slots() is sample.slots()
    for rows in (sample.items(), sample.slots()):
        assert rows.inputFiles() and all("/items-" in f or "/slots-" in f for f in rows.inputFiles())


@pytest.mark.parametrize("name", ["date_spine", "spine_enriched", "mart_balance_daily"])
def test_registered_grids_have_a_row_per_day(spark, name):
    assert "moment_day" in QUERIES[name](spark, "/root/testdata/sf0.001").columns


def test_places_of_daily_rows_are_counted_without_sorting_the_grid(spark, rows):
    first = dt.date(2024, 1, 30)
    held = [(1, "s1", 0, 4, "A"), (1, "s1", 3, 5, "B"), (1, "s2", 1, 2, "B"), (None, "s1", 0, 1, None)]
    grid = [
        (owner, slot, first + dt.timedelta(day), name, 1)
        for owner, slot, begin, end, name in held
        for day in range(begin, end)
    ]
    others = [(1, "s3", first, "A", 2), (1, S.OFF_SLOT, first, "A", 1), (1, None, first, "A", 1)]
    frame = spark.createDataFrame(
        grid * 2 + others,
        "depositor_id BIGINT, slot_id STRING, moment_day DATE, depositor_name STRING, is_used INT",
    )
    used = billing.slots_used_daily_from_spine(frame)
    got = rows(used, "depositor_id", "depositor_name", "moment_day", "slots_used_day")
    places = {}
    for owner, slot, day, name, _ in grid:
        names, slots = places.setdefault((owner, day), (set(), set()))
        names.add(name)
        slots.add(slot)
    want = [(o, max(n, key=str), d, len(p)) for (o, d), (n, p) in places.items()]
    assert got == sorted(want, key=lambda r: [str(v) for v in r])
    # What reads the daily rows hashes them.
    assert re.findall(r"(\w+Aggregate)", spark_plan(used))[-1] == "HashAggregate"


def spark_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rollup_of_daily_rows_hashes_them(spark, rows):
    first = dt.date(2024, 1, 1)
    texts = ["depositor_name", "item_name", "depositor_inn", "article", "product", "lot", "mfg_date"]
    named = [("A", "x", "1", None, None, "l", None), ("B", "x", None, None, None, "k", None)]
    grid = [
        (item, first + dt.timedelta(day), *named[(day + slot) % 2], float(day), float(day + slot), 1.0, -0.5 * slot)
        for item in ("i", "j", None)
        for slot in range(3)
        for day in range(4)
    ]
    kinds = [f"{name} STRING" for name in texts]
    totals = [f"{name} DOUBLE" for name in ("open_total_balance", "close_total_balance", "real_in", "real_out")]
    frame = spark.createDataFrame(grid, ", ".join(["item_id STRING, moment_day DATE", *kinds, *totals]))
    rolled = marts.balance_daily_no_slots(frame)
    # Both names meet on each day, so the larger of each text shows.
    want = [
        ("B", "x", first + dt.timedelta(day), float(day), 1.5, day + 2.0, "1", None, None, "l", None)
        for day in range(4)
    ] * 3
    assert rows(rolled) == sorted(want, key=lambda r: [str(v) for v in r])
    assert re.findall(r"(\w+Aggregate)", spark_plan(rolled))[-1] == "HashAggregate"


def test_counts_and_tags_of_the_grid_cost_little_a_row(spark, case):
    _, daily, grid = case
    intervals = spine.balance_intervals(daily, AS_OF)
    tiles = spine.month_tiles(daily, intervals, AS_OF)
    plan = spark_plan(tiles)
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert window.count("windowspecdefinition(store_id") <= 11
    places = [(items, close, expected) for items in (None, 0, 1, 2) for close in (None, -1, 0, 1, 2) for expected in (None, 1, 2)]
    frame = spark.createDataFrame(places, "items BIGINT, close INT, expected INT")
    columns = [F.col(c) for c in frame.columns]
    shown = frame.select(*columns, balance_tags(*columns).alias("tags"))
    for items, close, expected, tags in shown.collect():
        found = [S.TAG_MIXED_SLOT] * ((items or 0) > 1)
        found += [S.TAG_UNEXPECTED] * ((close or 0) > 0 and expected is not None and close != expected)
        assert tags == S.TAG_SEPARATOR.join(found)
    assert "concat_ws" not in spark_plan(shown)


def test_a_slot_of_many_items_is_counted_on_every_day(spark):
    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
    tiles = spark.range(3000).select(
        F.lit("s").alias("store_id"), F.lit("p").alias("slot_id"), F.lit(1).alias("close_slot_balance"),
        F.lit(first).alias("month"),
        F.date_add(F.lit(first), (F.col("id") % 31).cast("int")).alias("from_day"), F.lit(last).alias("to_day"),
    )
    counts = spine._with_counts(tiles).select("_counts").distinct().collect()
    assert [r[0] for r in counts] == [[sum(1 for i in range(3000) if i % 31 < day) for day in range(1, 32)]]
