"""Small helpers shared by the operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once_per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """A value kept by the Python worker for all its tasks.

    Task functions travel by value, so their modules' globals do not outlive a task.
    """
    store = sys.modules.setdefault("_slotledger_worker", types.ModuleType("_slotledger_worker"))
    values = store.__dict__.setdefault("values", {})
    if key not in values:
        values[key] = make()
    return values[key]


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in small parts, so that few of its texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether a table has at most ``max_rows`` rows; reads no more than it must."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark a table for broadcast if its size allows; else leave the join to a shuffle."""
    return F.broadcast(df) if fits(df, max_rows) else df.hint("merge")


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row as many times as ``copies`` says."""
    return df.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
