"""Joins on keys that may be missing, and left joins many of whose rows nothing can match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 4096  # places over which the rows that cannot match are dealt


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equal keys; a missing one is a key like others."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def left_join_known(
    rows: DataFrame, other: DataFrame, keys: list[str], known: Column, spread_by: list[str]
) -> DataFrame:
    """Left join on ``keys`` of the rows that are ``known``; the others meet nothing.

    In a shuffled join all rows without a slot, or without an agent, would go to one task.
    Here their key is a hash of ``spread_by``, so they go evenly to all; a row without
    one of the keys is not known. A broadcast join stays as it is.
    """
    known = F.coalesce(known, F.lit(False))
    for key in keys:
        known = known & F.col(key).isNotNull()
    place = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD))
    # A struct, not single columns: the optimizer would take a constant out of the key.
    own = F.struct(
        F.when(~known, place).alias("spread"), *[F.when(known, F.col(k)).alias(k) for k in keys]
    )
    listed = other.dropna(subset=keys)
    theirs = F.struct(F.lit(None).cast("bigint").alias("spread"), *[F.col(k) for k in keys])
    return (
        rows.withColumn("_key", own)
        .join(listed.withColumn("_key", theirs).drop(*keys), "_key", "left")
        .drop("_key")
    )
