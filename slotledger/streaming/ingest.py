"""Landed envelope files taken into the typed tables as they arrive.

Structured Streaming remembers which files it has seen, so no watermark has to be
asked from the tables. Each micro-batch is stored beside the tables as it is and no
stored row is looked at: what decides, when a table is read, is the change time of each
key, and a row or a document counts if it is newer than the one stored before it. So
files may land in any order, a micro-batch may be repeated after a failure, and several
streams with checkpoints of their own may feed one warehouse.

A missing key is a key like others, and a missing change time is older than any.
Objects that land twice in a batch count once. Of rows with one key and change time
the last by all columns counts; positions of a document all do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger import schemas as S
from slotledger.operators import bronze
from slotledger.operators.bronze import time_literal
from slotledger.operators.joins import same_keys
from slotledger.operators.upsert import EPOCH
from slotledger.plans.contracts import row_rules
from slotledger.plans.pipeline import Warehouse, each_table
from slotledger.session import cut, scratch_scope
from slotledger.sources.tables import Changes


def newest(rows: DataFrame, keys: list[str], how: str, changed: str) -> DataFrame:
    """The rows of each key's newest version in a batch; one row where the table keeps one."""
    time = F.coalesce(F.col(changed), time_literal(EPOCH))
    if how == "merge":
        one = rows.groupBy(*keys).agg(F.max(F.struct(time.alias("_time"), F.struct(*rows.columns).alias("_row"))).alias("_last"))
        return one.select("_last._row.*").select(*rows.columns)
    named = [F.col(k).alias(f"_new_{k}") for k in keys]
    times = rows.groupBy(*named).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    # Mostly few keys have several versions in a batch: stored, they spare the rows a shuffle.
    several = cut(times.filter("_first < _last").drop("_first"), "several-versions")
    same = same_keys(rows, several, [(k, f"_new_{k}") for k in keys])
    return rows.join(several, same & (time < several["_last"]), "left_anti")


def each_once(raw: DataFrame) -> DataFrame:
    """The objects of a stored batch, each once.

    Hashes tell which may be there twice; only those are compared as a whole, so the others
    are not shuffled.
    """
    digest = F.xxhash64("entity", "raw_json").alias("_digest")
    counted = raw.groupBy(digest).agg(F.count("*").alias("_times"))
    repeated = cut(counted.filter("_times > 1").select("_digest"), "repeated")
    if repeated.isEmpty():
        return raw
    marked = raw.select("*", digest)
    alone = marked.join(repeated, "_digest", "left_anti").select(*raw.columns)
    again = marked.join(repeated, "_digest", "left_semi").select(*raw.columns).distinct()
    return cut(alone.unionByName(again), "once", by="entity").select(*raw.columns)


def take_in(warehouse: Warehouse, raw: DataFrame, batch_id: int) -> None:
    """Merge or replace the rows of one micro-batch; safe to repeat."""
    with scratch_scope(warehouse.spark):
        _take_in(warehouse, raw, batch_id)


def _take_in(warehouse: Warehouse, raw: DataFrame, batch_id: int) -> None:
    store = warehouse.store
    raw = each_once(cut(raw, f"stream-{batch_id}", by="entity", gathered=True))

    def load(name: str) -> None:
        parse, keys, how, changed = bronze.TABLES[name]
        rows = newest(parse(raw, None), keys, how, changed)
        if not store.exists("bronze", name):
            store.write(rows, "bronze", name, checks=row_rules(name), changed=changed)
            return
        rows = cut(rows, f"rows-{name}")  # looked at more than once
        if not rows.isEmpty():
            store.merge(rows, "bronze", name, Changes(keys, changed), checks=row_rules(name))

    each_table(load)


def ingest_stream(warehouse: Warehouse, folder: str, checkpoint: str, form: str = "json"):
    """Take in all files that have landed since the last call, then stop.

    Returns the streaming query; wait for it with ``awaitTermination``.
    """
    landed = warehouse.spark.readStream.schema(S.RAW).format(form).load(folder)
    return (
        landed.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda raw, batch_id: take_in(warehouse, raw, batch_id))
        .start()
    )
