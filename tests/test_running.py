from pyspark.sql import functions as F

from slotledger.functions import nulls_last
from slotledger.operators import ledger, running
from slotledger.operators.ids import with_global_ids, with_global_starts
from slotledger.operators.running import heavy_groups, previous_value, running_sums
from slotledger.session import cut
from tests import brute
from tests.ledgers import ops_frame, random_ops

BALANCES = ["open_slot_balance", "close_slot_balance", "open_total_balance", "close_total_balance"]


def test_balances_match_brute_force(spark):
    ops = random_ops(range(40))
    got = ledger.running_balances(ledger.split_movements(ops_frame(spark, ops)))
    assert {r["id"]: tuple(r[c] for c in BALANCES) for r in got.collect()} == brute.balances(ops)


def test_hot_groups_are_split_and_stay_exact(spark):
    ops = random_ops(range(3), size=20)
    hot = [
        {**op, "item_id": "hot", "slot_id": "off_slot", "store_id": None if op["id"] % 2 else "s"}
        for op in random_ops(range(100, 120))
    ]
    for number, op in enumerate(ops + hot, 1):
        op["id"] = number
    frame = ledger.split_movements(ops_frame(spark, ops + hot))
    assert heavy_groups(frame, ["item_id"], 30).count() == 1
    got = ledger.running_balances(frame, hot_rows=30)
    whole = ledger.running_balances(frame)
    assert dict(got.dtypes) == dict(whole.dtypes)
    assert {r["id"]: tuple(r[c] for c in BALANCES) for r in got.collect()} == brute.balances(
        ops + hot
    )


def test_chunks_of_a_hot_group_are_many(spark):
    frame = spark.range(5000).select(
        F.lit("k").alias("k"), "id", (F.col("id") % 7).cast("decimal(18,6)").alias("v")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_sums(frame, ["k"], nulls_last(["id"]), F.col("v"), "o", "c", hot_rows=100)
        seen = {r["id"]: (r["o"], r["c"]) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total = 0
    for number in range(5000):
        before, total = total, total + number % 7
        assert seen[number] == (before, total)


def test_previous_value_of_hot_and_other_groups(spark):
    frame = spark.range(400).select(
        F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"),
        "id",
        F.when(F.col("id") % 11 != 0, F.col("id") * 2).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = previous_value(frame, ["k"], nulls_last(["id"]), "v", "p", hot_rows=50)
        whole = previous_value(frame, ["k"], nulls_last(["id"]), "v", "p")
        assert sorted(map(tuple, split.collect()), key=repr) == sorted(
            map(tuple, whole.collect()), key=repr
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_global_ids_follow_the_order_nulls_last(spark):
    frame = spark.range(1000).select(
        F.when(F.col("id") % 13 != 0, F.col("id") % 50).alias("a"), F.col("id").alias("b")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_global_ids(frame, nulls_last(["a", "b"])).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["id"] for r in got] == list(range(1, 1001))
    keys = [(r["a"] is None, r["a"] or 0, r["b"]) for r in got]
    assert keys == sorted(keys)


def test_global_starts_leave_room_for_each_row(spark):
    frame = spark.range(500).select("id", (F.col("id") % 4 + 1).alias("w"))
    got = with_global_starts(frame, nulls_last(["id"]), F.col("w"), "start").orderBy("id").collect()
    start = 1
    for row in got:
        assert row["start"] == start
        start += row["w"]


def test_no_plan_sends_the_ledger_through_one_task(spark):
    frame = ledger.split_movements(ops_frame(spark, random_ops(range(3))))
    plan = ledger.running_balances(frame)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_items_dealt_or_summed_by_day_as_whole(spark, rows):
    frame = ops_frame(spark, random_ops(range(6)))
    shown = ["id", "open_slot_balance", "close_slot_balance", "open_total_balance", "close_total_balance"]
    dealt = ledger.running_balances(frame)
    split = ledger.split_movements(frame)
    assert rows(dealt, *shown) == rows(ledger.running_balances(split, dealt_rows=0), *shown)
    by_day = ledger.running_balances(frame, by_day=True, dealt_rows=0)
    assert rows(by_day, *shown) == rows(dealt, *shown)
    assert by_day.dtypes == dealt.dtypes


def test_small_items_are_shuffled_once(spark):
    plan = ledger.running_balances(ops_frame(spark, random_ops(range(3))))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_numbering_goes_on_with_the_columns_kept(spark):
    frame = spark.range(50).select((-F.col("id")).alias("a"), F.lit("x").alias("wide"), "id")
    got = with_global_ids(frame, nulls_last(["a", "wide"]), "n", keep=["id"])
    assert got.columns == ["n", "id"]
    assert all(r["n"] == 50 - r["id"] for r in got.collect())


def test_small_chunks_share_a_range_partition(spark, monkeypatch):
    stored = []

    def noted(df, label, **how):
        stored.append((label, cut(df, label, **how)))
        return stored[-1][1]

    monkeypatch.setattr(running, "cut", noted)
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"), "id", (F.col("id") % 7).alias("v")
    )
    order = nulls_last(["id"])
    summed = running_sums(frame, ["k"], order, F.col("v"), "o", "c", hot_rows=100)
    whole = running_sums(frame, ["k"], order, F.col("v"), "o", "c")
    assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, whole.collect()))
    chunks = next(df for label, df in stored if label == "chunks")
    sizes = [r["count"] for r in chunks.groupBy("_chunk").count().collect()]
    assert max(sizes) <= 100 and len(sizes) >= 50
    assert len(chunks.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
