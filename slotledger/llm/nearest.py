"""Approximate nearest neighbours over several shifted Hilbert curves.

Each curve projects the vectors onto its own few random orthogonal directions, shifts the
grid by a random offset and orders all vectors by their place on a Hilbert curve through
it. The orderings are range-partitioned in Spark, cut into blocks of ``BLOCK`` places at
most, and a query meets the blocks that lie within ``window`` places of its own. Distances
are exact, in double precision; the best of all curves are merged.

The window is measured, not fixed: up to ``SAMPLE`` queries are compared with all points
(one pass, no shuffle of vectors), and the window doubles until their recall on the curves
reaches ``RECALL``. A window over all points is exact, so this ends at every size.

Equal vectors are one point of the index with their smallest ids (as many as a result
can hold), so a vector that fills a third of the table is compared once and ties still go
to the smallest ids. Mean and spread of the projections come from all vectors.

Recall with 16 curves of 8 directions: see the README. Tables of little structure need
windows that grow with them.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take
no part, as query or candidate, nor do vectors of another length than most; repeated rows
count once, rows with the query's id are its own; with fewer than ``k`` candidates all are
returned; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotledger.session import cut

CURVES, DIRECTIONS, BITS, WINDOW, SEED = 16, 8, 7, 2048, 7
BLOCK = 2048  # most places of a block: what one task holds at a time does not grow with the window
RECALL = 0.94  # of the sampled queries; above the required 0.9, as the sample may flatter
SAMPLE = 200  # queries that the window is measured on
_SPREAD = 3.0  # standard deviations from the mean to the edge of the grid


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (one row each, coordinates below 2**bits) on the Hilbert curve.

    Coordinates are reflected and exchanged from the top bit down, then read as a Gray
    code and their bits interleaved.
    """
    x = cells.astype(np.uint64).copy()
    count, one = x.shape[1], np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        high, low = one << np.uint64(bit), (one << np.uint64(bit)) - one
        for i in range(count):
            flip = (x[:, i] & high) != 0
            swap = np.where(flip, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(flip, low, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, count):
        x[:, i] ^= x[:, i - 1]
    parity = np.zeros(len(x), dtype=np.uint64)
    for bit in range(bits - 1, 0, -1):
        high, low = one << np.uint64(bit), (one << np.uint64(bit)) - one
        parity ^= np.where((x[:, -1] & high) != 0, low, np.uint64(0))
    x ^= parity[:, None]
    keys = np.zeros(len(x), dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(count):
            keys = (keys << one) | ((x[:, i] >> np.uint64(bit)) & one)
    return keys


def _matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, size)


def _directions(size: int, curves: int, directions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthogonal directions of every curve, side by side, and the curves' offsets in cells."""
    draw = np.random.default_rng(seed)
    count = min(directions, size)
    turns = [np.linalg.qr(draw.normal(size=(size, size)))[0][:, :count] for _ in range(curves)]
    return np.concatenate(turns, axis=1), draw.uniform(0, 1, size=curves * count)


def _moments(turns: np.ndarray):
    """Sums and sums of squares of all projections: one row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, turns.shape[1]))
        for batch in batches:
            placed = _matrix(batch, "v", len(turns)) @ turns
            sums += (placed.sum(axis=0), (placed**2).sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"]
        )

    return run


def _keys(turns, shifts, low, width, curves: int, bits: int):
    """The key of every vector on every curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = (1 << bits) - 1
        for batch in batches:
            placed = (_matrix(batch, "v", len(turns)) @ turns - low) / width * top + shifts - 0.5
            cells = np.clip(np.rint(placed), 0, top)
            for curve, own in enumerate(np.split(cells, curves, axis=1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), curve, np.int32)),
                        pa.array(hilbert_keys(own, bits).view(np.int64)),
                        *[batch.column(c) for c in ("point", "asked", "v")],
                    ],
                    names=["curve", "key", "point", "asked", "v"],
                )

    return run


def _search(size: int, window: int, best: int):
    """One block: the ``best`` nearest points to each query within the window."""

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        queries = block.column("query").to_numpy()
        points, places = block.column("point").to_numpy(), block.column("place").to_numpy()
        vectors = block.column("v").chunk(0).flatten().to_numpy().reshape(-1, size)
        here = np.flatnonzero(~queries)
        here = here[np.argsort(points[here])]
        out: tuple[list, list, list] = ([], [], [])
        for q in np.flatnonzero(queries):
            near = here[np.abs(places[here] - places[q]) <= window]
            scores = np.sqrt(((vectors[near] - vectors[q]) ** 2).sum(axis=1))
            top = np.argsort(scores, kind="stable")[:best]
            out[0].append(np.full(len(top), points[q]))
            out[1].append(points[near[top]])
            out[2].append(scores[top])
        empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        found = [np.concatenate([e, *x]) for e, x in zip(empty, out)]
        return pa.table(dict(zip(("asked", "point", "score"), map(pa.array, found))))

    return run


def _all_distances(asked: np.ndarray, vectors: np.ndarray, best: int):
    """The ``best`` nearest points to each sampled query among a task's points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, own = batch.column("point"), _matrix(batch, "v", vectors.shape[1])
            # Products choose the nearest, differences give their distance.
            near = (own**2).sum(axis=1) - 2 * vectors @ own.T
            count = min(best, len(own))
            top = np.argpartition(near, count - 1, axis=1)[:, :count] if count else np.zeros((len(asked), 0), int)
            scores = [np.sqrt(((own[t] - v) ** 2).sum(axis=1)) for t, v in zip(top, vectors)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(asked, count)),
                    points.take(pa.array(top.ravel())),
                    pa.array(np.concatenate(scores)),
                ],
                names=["asked", "point", "score"],
            )

    return run


def _best(found: DataFrame, best: int) -> DataFrame:
    """Per ``asked`` point its ``best`` nearest as (score, point)."""
    ordered = F.array_sort(F.collect_set(F.struct("score", "point")))
    return found.groupBy("asked").agg(F.slice(ordered, 1, best).alias("_best"))


def _meet(placed: DataFrame, asking: Column, window: int, size: int, best: int, schema: str) -> DataFrame:
    """The ``best`` nearest points within ``window`` places, of each curve and block."""
    block = min(window, BLOCK)
    reach = -(-window // block)
    held = placed.withColumn("block", F.floor(F.col("place") / block))
    meeting = held.withColumn("query", F.lit(False)).unionByName(
        held.filter(asking).withColumn("query", F.lit(True))
        .withColumn("block", F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)))
    ).select("curve", "block", "query", "point", "place", "v")
    return meeting.groupBy("curve", "block").applyInArrow(_search(size, window, best), schema)


def measured_window(
    points: DataFrame, placed: DataFrame, count: int, size: int, window: int, best: int, schema: str
) -> int:
    """``window``, doubled until the sampled queries' recall reaches ``RECALL``."""
    if count <= window:
        return window
    chosen = placed.filter("asked AND curve = 0").orderBy(F.xxhash64("point"), "point").limit(SAMPLE)
    sample = chosen.select("point", "v").collect()  # SAMPLE vectors at most
    if not sample:
        return window
    asked = np.array([r["point"] for r in sample])
    vectors = np.array([r["v"] for r in sample])
    truth = points.select("point", "v").mapInArrow(_all_distances(asked, vectors, best), schema)
    others = lambda row: [b["score"] for b in row["_best"] if b["point"] != row["asked"]][: best - 1]
    exact = {r["asked"]: others(r) for r in _best(truth, best).collect()}
    listed = F.col("asked") & F.col("point").isin(asked.tolist())
    while window < count:
        found = _best(_meet(placed, listed, window, size, best, schema), best).collect()
        got = {r["asked"]: others(r) for r in found}
        hits = sum(sum(s <= own[-1] * (1 + 1e-9) for s in got.get(q, [])) for q, own in exact.items() if own)
        if hits >= RECALL * sum(map(len, exact.values())):
            break
        window *= 2
    return window


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _ordered(rows: DataFrame, points: int) -> DataFrame:
    """Each row's ``place`` on its curve, from one range sort of all curves."""
    order = ["curve", "key", "point"]
    stored = cut(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()),
        "curves",
    )
    part = F.shiftright("_row", 33)
    sizes = stored.groupBy(part.alias("_part")).count()
    # One row per range partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    # Every curve has each point once, so curve c's places begin at c * points.
    return stored.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        *rows.columns, (F.col("_start") + within - F.col("curve") * points).alias("place")
    )


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    curves: int = CURVES,
    directions: int = DIRECTIONS,
    window: int = WINDOW,
    seed: int = SEED,
) -> DataFrame:
    """The ``k`` nearest found of every row that ``queries`` selects among all others.

    ``window`` is the least; it grows until the recall measured on a sample is enough.
    ``query_id``, ``rank`` (from 1), ``id_col`` and ``score``, the Euclidean distance.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    ).filter(_valid(F.col("v")) & F.col("id").isNotNull())
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = lengths["n"] if lengths else 1
    rows = rows.filter(F.size("v") == size)

    # One point per distinct vector, with its k + 1 smallest ids; the rank limit also
    # holds before the shuffle, so copies of a vector do not meet in one task.
    by_id = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v").withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= k + 1)
    points = cut(
        few.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
        .withColumn("point", F.col("ids")[0]),
        "points",
    )
    asking = cut(
        rows.filter("asked").select(F.col("id").alias("query_id"), "v").distinct()
        .join(points.select("v", "point"), "v").select("query_id", "point"),
        "queries",
    )
    count = points.count()
    turns, shifts = _directions(size, curves, directions, seed)
    moments = (
        points.select("v").mapInArrow(_moments(turns), "sums array<double>")
        .select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    )
    sums = np.zeros(2 * turns.shape[1])
    for row in moments.collect():  # two numbers per direction
        sums[row.i] = row.x
    mean, square = sums.reshape(2, -1) / max(1, count)
    spread = np.maximum(np.sqrt(np.maximum(square - mean**2, 0)), 1e-12) * _SPREAD

    asked = asking.select("point").distinct().withColumn("asked", F.lit(True))
    indexed = points.join(asked, "point", "left").select(
        "point", F.coalesce("asked", F.lit(False)).alias("asked"), "v"
    )
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"curve int, key bigint, point {id_type}, asked boolean, v array<double>"
    keyed = indexed.mapInArrow(
        _keys(turns, shifts, mean - spread, 2 * spread, curves, BITS), schema
    )
    placed = _ordered(keyed, count)
    found = f"asked {id_type}, point {id_type}, score double"
    window = measured_window(points, placed, count, size, window, k + 1, found)
    met = _meet(placed, F.col("asked"), window, size, k + 1, found)
    # Per query at most k + 1 rows of each curve and block in reach.
    nearest_points = _best(met, k + 1)
    named = (
        nearest_points.select("asked", F.explode("_best").alias("_b"))
        .select("asked", F.col("_b.score").alias("score"), F.col("_b.point").alias("point"))
        .join(points.select("point", "ids"), "point")
        .select("asked", "score", F.explode("ids").alias("id"))
    )
    listed = named.groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("_all"))
    own = F.filter("_all", lambda x: x["id"] != F.col("query_id"))
    return (
        asking.join(listed, asking["point"] == listed["asked"])
        .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("_at", "_found"))
        .select(
            "query_id",
            (F.col("_at") + 1).cast("int").alias("rank"),
            F.col("_found.id").alias(id_col),
            F.col("_found.score").alias("score"),
        )
    )
