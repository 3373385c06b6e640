"""Benchmark decontamination by winnowing.

A window is ``window`` neighbouring words of a benchmark item; an item of fewer
words is one window. Of every window the smallest hash of its ``gram``-word runs
is kept as fingerprint, on both sides alike, so each shared window has at least
one fingerprint in common. Steps:

1. fingerprints of the texts (one pass) meet the benchmark's in a Spark join;
2. places that met are extended: all windows over such a place are hashed
   (128 bits) and joined to the benchmark's windows;
3. words inside matching windows are counted per text.

Fingerprints of a text travel with a 64-bit digest of it, not with an id: copies
of a text, repeated rows and null ids need no special care, copies meet the
benchmark once, and two texts that share a digest merely check each other's places.

Edge cases: null or wordless texts have no words and no hits; repeated rows give
repeated result rows; items with a null id make hits but count as no item; empty
tables give empty (documents) or clean (benchmark) results; columns named like
those used inside are kept out by selecting ``id``, ``text`` first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.support import bounded, repeat_rows, text_or_empty
from slotledger.llm.words import ALNUM, Words, rolling, whole_runs, words_of
from slotledger.session import cut

WINDOW, GRAM = 13, 5
BROADCAST_ROWS = 1_000_000  # of benchmark fingerprints or windows, some 30 bytes each
_LANES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_PLACE_BITS = 32


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


def winnow(hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """Places and hashes of the grams that are smallest in some whole window."""
    grams = rolling(hashes, gram, _LANES[0] + 2 * window)
    width = window - gram + 1
    inside = whole_runs(bounds, window)
    if not inside.any():
        return np.zeros(0, np.int64), grams[:0]
    least = np.where(inside, _sliding(grams, width, np.minimum), np.uint64(0))
    pad = np.zeros(width - 1, dtype=np.uint64)
    chosen = _sliding(np.concatenate([pad, least, pad]), width, np.maximum) == grams
    places = np.flatnonzero(chosen)
    return places, grams[places]


def _lanes(words: Words, begin: int, end: int, size: int) -> list[np.ndarray]:
    """Both lanes of all windows of ``size`` among the words from ``begin`` to ``end``."""
    own = (words.hashes[begin:end], words.second[begin:end])
    return [rolling(x, size, base + 2 * size).view(np.int64) for x, base in zip(own, _LANES)]


def _fingerprints(sizes: list[int], gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("_digest").to_numpy()
            for words in words_of(batch.column("_text"), ALNUM):
                for size in sizes:
                    places, prints = winnow(words.hashes, words.bounds, size, min(gram, size))
                    row = np.searchsorted(words.bounds, places, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(digests[words.first + row]),
                            pa.array(prints.view(np.int64)),
                            pa.array((size << _PLACE_BITS) + places - words.bounds[row]),
                        ],
                        names=["_digest", "_print", "_at"],
                    )

    return run


def _item_windows(window: int, gram: int):
    """Windows and fingerprints of benchmark items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ids = batch.column("_item").to_pylist()
            for words in words_of(batch.column("_text"), ALNUM):
                for i in range(words.count):
                    begin, end = words.bounds[i : i + 2]
                    own = words.hashes[begin:end]
                    size = min(window, len(own))
                    if not size:
                        continue
                    _, prints = winnow(own, np.array([0, len(own)]), size, min(gram, size))
                    first, second = _lanes(words, begin, end, size)
                    out.append(
                        (ids[words.first + i], size, first.tolist(), second.tolist(),
                         np.unique(prints).view(np.int64).tolist())
                    )
            kinds = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(column), type=kind)
                    for column, kind in zip(
                        list(zip(*out)) or [()] * 5,
                        [pa.string(), pa.int32(), kinds, kinds, kinds],
                    )
                ],
                names=["_item", "_size", "_first", "_second", "_prints"],
            )

    return run


def _extend(gram: int):
    """One row per text with its word count, and one per window over a place that met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = batch.column("_places")
            for words in words_of(batch.column("_text"), ALNUM):
                rows, starts, sizes, lanes = [], [], [], ([], [])
                for i in range(words.count):
                    places = met[words.first + i].as_py()
                    if not places:
                        continue
                    begin, end = words.bounds[i : i + 2]
                    own = words.hashes[begin:end]
                    at = np.array(places, dtype=np.int64)
                    for size in np.unique(at >> _PLACE_BITS).tolist():
                        here = at[at >> _PLACE_BITS == size] & ((1 << _PLACE_BITS) - 1)
                        back = np.arange(size - min(gram, size) + 1)
                        all_starts = np.unique((here[:, None] - back[None, :]).ravel())
                        all_starts = all_starts[(all_starts >= 0) & (all_starts <= len(own) - size)]
                        for lane, values in zip(lanes, _lanes(words, begin, end, size)):
                            lane.append(values[all_starts])
                        starts.append(all_starts)
                        sizes.append(np.full(len(all_starts), size))
                        rows.append(np.full(len(all_starts), i))
                some = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
                        for x in (rows, starts, sizes, *lanes)]
                own_rows = np.concatenate([np.arange(words.count), some[0]]) + words.first
                counts = np.diff(words.bounds)
                gap = pa.nulls(words.count, pa.int64())
                columns = [batch.column(c).take(pa.array(own_rows)) for c in ("_id", "_digest")]
                columns.append(pa.concat_arrays([pa.array(counts), pa.nulls(len(some[0]), pa.int64())]))
                columns += [pa.concat_arrays([gap, pa.array(x)]) for x in some[1:]]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["_id", "_digest", "_words", "_start", "_size", "_first", "_second"]
                )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_words``, ``n_hit`` and the sorted ``items``.

    ``n_hit`` counts words inside any occurrence of a benchmark window, ``items``
    names the items (as strings) that have a window in the text.
    """
    items = cut(
        benchmark.select(
            F.col(item_col).cast("string").alias("_item"), text_or_empty(text_col).alias("_text")
        ).mapInArrow(
            _item_windows(window, gram),
            "_item string, _size int, _first array<bigint>, _second array<bigint>, _prints array<bigint>",
        ),
        "benchmark-windows",
    )
    # At most ``window`` sizes, whatever the benchmark.
    sizes = sorted(r[0] for r in items.select("_size").distinct().collect())
    prints = items.select("_size", F.explode("_prints").alias("_print")).distinct()
    windows = items.select(
        "_item", "_size", F.explode(F.arrays_zip("_first", "_second")).alias("_w")
    ).select("_item", F.col("_size").cast("bigint").alias("_size"), "_w._first", "_w._second")

    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).select(
        "_id", "_text", F.xxhash64("_text").alias("_digest")
    )
    met = (
        texts.select("_text", "_digest")
        .mapInArrow(_fingerprints(sizes, gram), "_digest bigint, _print bigint, _at bigint")
        .withColumn("_size", F.shiftright("_at", _PLACE_BITS).cast("int"))
        .join(bounded(prints, BROADCAST_ROWS), ["_size", "_print"])
        .groupBy("_digest")
        .agg(F.collect_set("_at").alias("_places"))
    )
    met = cut(met, "met-places")
    known = windows.select("_size", "_first", "_second").distinct().withColumn("_known", F.lit(True))
    keys = ["_size", "_first", "_second"]
    found = cut(
        texts.join(met, "_digest", "left")
        .select("_id", "_text", "_digest", "_places")
        .mapInArrow(
            _extend(gram),
            f"_id {id_type}, _digest bigint, _words bigint, _start bigint, _size bigint, "
            "_first bigint, _second bigint",
        )
        .join(bounded(known, BROADCAST_ROWS), keys, "left")
        .filter("_known OR _words IS NOT NULL")
        .drop("_known"),
        "found-windows",
    )
    same = ["_id", "_digest"]
    # A start is followed by at most one start of each size, so this is linear in a text's words.
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.when(F.col("_start").isNotNull(), F.struct("_start", (F.col("_start") + F.col("_size")).alias("_end"))))),
        F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).cast("bigint").alias("upto")),
        lambda acc, w: F.struct(
            (acc["hit"] + F.greatest(w["_end"] - F.greatest(w["_start"], acc["upto"]), F.lit(0))).alias("hit"),
            F.greatest(acc["upto"], w["_end"]).alias("upto"),
        ),
        lambda acc: acc["hit"],
    )
    counts = found.groupBy(*same).agg(
        F.max("_words").alias("n_words"), F.count("_words").alias("_copies"), covered.alias("n_hit")
    )
    texts_items = (
        found.filter("_start IS NOT NULL").select(*same, *keys).distinct()
        .join(bounded(windows, BROADCAST_ROWS), keys)
        .groupBy(*same)
        .agg(F.array_sort(F.collect_set("_item")).alias("items"))
    )
    on = counts["_id"].eqNullSafe(texts_items["_id"]) & (counts["_digest"] == texts_items["_digest"])
    joined = counts.join(texts_items, on, "left").select(
        counts["_id"].alias(id_col),
        "n_words",
        "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        "_copies",
    )
    return repeat_rows(joined, "_copies")


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least one word in twenty lies in a benchmark window."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
