"""Removal of repeated passages, prefiltered by a count-min sketch.

A window is ``window`` neighbouring words. A word goes when it lies in a window
whose word sequence also starts anywhere else in the table.

The texts are dealt once into blocks of bounded size, in a bucketed table, so the
three passes below read a block where it lies and shuffle no text:

1. every block sketches its windows: per row of the sketch the cells it fills
   (delta-coded, about a byte each) and a bit for each filled twice. The sketches
   are merged segment by segment, counters stopping at 2, and each block gets one
   bit per cell back: counted twice or more over the whole table;
2. windows whose cells are repeated in every row are the candidates: a superset of
   all repeated windows, since counters only overestimate. Each block hands out the
   128-bit keys of its candidates once; they are counted exactly, key range by key
   range, and come back as one bit per key;
3. each block drops the covered words.

A block is a bucket of that table. For more than 100,000 of them, about 400 GB of text,
raise ``BLOCK_BYTES``, or Spark's own limit ``spark.sql.sources.bucketing.maxBuckets``.

The sketch grows with the input (``CELLS`` cells a window and row) and is spread
over its segments, so the share of unique windows that pass stays near 1-2 % at any
size. A text that is copied into a third of all rows is met once per block.

Edge cases: a null or wordless text keeps nothing, n_words 0; texts shorter than a
window are never touched; repeated rows (same id) count as separate places; NUL is
a letter; a text longer than a block is a block of its own; windows that repeat go
alike in all places, no first one stays; other columns are kept, those named like the
results replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.support import text_or_empty
from slotledger.llm.words import SPACED, mix, rolling, text_buffer, whole_runs, words_of
from slotledger.session import cut, scratch_path

WINDOW = 35
BLOCK_BYTES = 4 << 20  # of text, on average
CELLS = 8  # cells of the sketch per window and row
ROWS = 2  # independent rows of the sketch
SEGMENT_BITS = 24  # a segment of the sketch has 2**24 cells
_WORD_BYTES = 6  # about, to size the sketch; any value gives the same result
_LANES = (0x8CB92BA72F3D8DD7, 0xE7037ED1A0B428DB)


def _pack(cells: np.ndarray) -> bytes:
    """Sorted distinct cells, as differences with their bytes by significance."""
    steps = np.diff(cells, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _bits(flags: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(flags).tobytes(), 1)


def _unbits(packed: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=count).astype(bool)


def _slices(texts: pa.ChunkedArray, window: int) -> Iterator[tuple]:
    """Chunk, words and the places where whole windows start, slice by slice."""
    for chunk in texts.chunks:
        for words in words_of(chunk, SPACED):
            yield chunk, words, whole_runs(words.bounds, window)


def _windows(texts: pa.ChunkedArray, window: int, lanes: int) -> list[np.ndarray]:
    """The first ``lanes`` lanes of all windows of a block, in order."""
    found: list[list] = [[np.zeros(0, np.uint64)] for _ in range(lanes)]
    for _, words, inside in _slices(texts, window):
        for lane, hashes, base in zip(found, (words.hashes, words.second), _LANES):
            lane.append(rolling(hashes, window, base)[inside])
    return [np.concatenate(lane) for lane in found]


def _cells(first: np.ndarray, row: int, segments: int) -> np.ndarray:
    return mix(first + np.uint64(row * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(
        segments << SEGMENT_BITS
    )


def _by_segment(cells: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Segments of sorted cells, each with the places of its cells."""
    segment = (cells >> np.uint64(SEGMENT_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.diff(segment, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(cells)]):
        yield int(segment[start]), slice(int(start), int(end))


_SKETCH = "block int, row int, segment int, cells binary, twice binary"


def _sketch(window: int, rows: int, segments: int):
    def run(block: pa.Table) -> pa.Table:
        out = []
        number = block.column("block")[0].as_py()
        (first,) = _windows(block.column("text"), window, 1)
        for row in range(rows):
            cells, counts = np.unique(_cells(first, row, segments), return_counts=True)
            low = (cells & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
            for segment, part in _by_segment(cells):
                out.append((number, row, segment, _pack(low[part]), _bits(counts[part] > 1)))
        return _table(out, _SKETCH)

    return run


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table({n: pa.array(c, type=kinds[k]) for (n, k), c in zip(fields, columns)})


_REPEATED = "block int, row int, segment int, again binary"


def _merge_sketches(pieces: pa.Table) -> pa.Table:
    """One segment: its counters over all blocks, then a bit per cell of each block."""
    counters = np.zeros(1 << SEGMENT_BITS, dtype=np.uint8)
    cells = [_unpack(x.as_py()) for x in pieces.column("cells")]
    for own, twice in zip(cells, pieces.column("twice")):
        seen = counters[own] + 1 + _unbits(twice.as_py(), len(own))
        counters[own] = np.minimum(seen, 2)
    again = [_bits(counters[own] > 1) for own in cells]
    return pa.table(
        {
            **{c: pieces.column(c) for c in ("block", "row", "segment")},
            "again": pa.array(again, type=pa.binary()),
        }
    )


def _candidates(first: np.ndarray, again: pa.Table, rows: int, segments: int) -> np.ndarray:
    """True for windows whose cells are repeated in every row of the sketch."""
    bits = {
        (r, s): b
        for r, s, b in zip(*(again.column(c).to_pylist() for c in ("row", "segment", "again")))
    }
    passed = np.ones(len(first), dtype=bool)
    for row in range(rows):
        cells, where = np.unique(_cells(first, row, segments), return_inverse=True)
        repeated = np.zeros(len(cells), dtype=bool)
        for segment, part in _by_segment(cells):
            repeated[part] = _unbits(bits[row, segment], part.stop - part.start)
        passed &= repeated[where]
    return passed


def _distinct_keys(first, second, chosen):
    """Sorted distinct 128-bit keys of the chosen windows, counts, and each one's place."""
    picked = np.flatnonzero(chosen)
    order = np.lexsort((second[picked], first[picked]))
    a, b = first[picked][order], second[picked][order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    starts = np.flatnonzero(new)
    places = np.empty(len(order), dtype=np.int64)
    places[order] = np.cumsum(new) - 1
    return a[starts], b[starts], np.diff(starts, append=len(order)), picked, places


_KEYS = "block int, segment int, first binary, second binary, twice binary"
_CONFIRMED = "block int, segment int, again binary"


def _ranges(first: np.ndarray, segments: int) -> Iterator[tuple[int, slice]]:
    """Sorted keys cut into equal ranges of the first lane."""
    width = -(-(1 << 64) // segments)
    bounds = np.searchsorted(first, np.array([i * width for i in range(segments)], dtype=np.uint64))
    for i, (start, end) in enumerate(zip(bounds, [*bounds[1:], len(first)])):
        if end > start:
            yield i, slice(int(start), int(end))


def _emit_keys(window: int, rows: int, segments: int):
    def run(block: pa.Table, again: pa.Table) -> pa.Table:
        out = []
        if block.num_rows:
            number = block.column("block")[0].as_py()
            first, second = _windows(block.column("text"), window, 2)
            chosen = _candidates(first, again, rows, segments)
            a, b, counts, _, _ = _distinct_keys(first, second, chosen)
            for segment, part in _ranges(a, segments):
                out.append((number, segment, a[part].tobytes(), b[part].tobytes(), _bits(counts[part] > 1)))
        return _table(out, _KEYS)

    return run


def _count_keys(pieces: pa.Table) -> pa.Table:
    """Exact counts of one key range over all blocks, and a bit per key of each block."""

    def lane(name):
        return [np.frombuffer(x.as_py(), np.uint64) for x in pieces.column(name)]

    firsts, seconds = lane("first"), lane("second")
    sizes = [len(x) for x in firsts]
    first, second = np.concatenate(firsts), np.concatenate(seconds)
    counts = np.concatenate(
        [1 + _unbits(x.as_py(), n) for x, n in zip(pieces.column("twice"), sizes)]
    ).astype(np.int64)
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    totals = np.bincount(group, weights=counts[order])
    again = np.empty(len(order), dtype=bool)
    again[order] = totals[group] > 1
    parts = np.split(again, np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "block": pieces.column("block"),
            "segment": pieces.column("segment"),
            "again": pa.array([_bits(p) for p in parts], type=pa.binary()),
        }
    )


def _covered(words, inside: np.ndarray, repeated: np.ndarray, window: int) -> np.ndarray:
    """True for words inside a repeated window."""
    mark = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    starts = np.flatnonzero(inside)[repeated]
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + window, -1)
    return np.cumsum(mark[:-1]) > 0


def _keep(window: int, rows: int, segments: int, columns: list[str], respace: bool):
    def run(block: pa.Table, again: pa.Table) -> pa.Table:
        sketch = again.filter(pc.greater_equal(again.column("row"), 0))
        exact = again.filter(pc.less(again.column("row"), 0))
        first, second = _windows(block.column("text"), window, 2)
        repeated = np.zeros(len(first), dtype=bool)
        chosen = _candidates(first, sketch, rows, segments) if block.num_rows else repeated
        a, _, _, picked, places = _distinct_keys(first, second, chosen)
        bits = dict(zip(exact.column("segment").to_pylist(), exact.column("again").to_pylist()))
        confirmed = np.zeros(len(a), dtype=bool)
        for segment, part in _ranges(a, segments):
            confirmed[part] = _unbits(bits[segment], part.stop - part.start)
        repeated[picked] = confirmed[places]

        del first, second
        counts, removed, kept, at = [], [], [], 0
        for chunk, words, inside in _slices(block.column("text"), window):
            data, offsets = text_buffer(chunk)
            here = int(inside.sum())
            gone = _covered(words, inside, repeated[at : at + here], window)
            at += here
            for i in range(words.count):
                begin, end = int(words.bounds[i]), int(words.bounds[i + 1])
                own = np.flatnonzero(~gone[begin:end]) + begin
                counts.append(end - begin)
                removed.append(end - begin - len(own))
                if not respace and not removed[-1]:
                    row = words.first + i
                    kept.append(data[offsets[row] : offsets[row + 1]].tobytes())
                    continue
                kept.append(
                    b" ".join(
                        data[s:e].tobytes()
                        for s, e in zip(words.starts[own].tolist(), words.ends[own].tolist())
                    )
                )
        return pa.table(
            {
                **{c: block.column(c) for c in columns},
                "n_words": pa.array(counts, type=pa.int64()),
                "n_removed": pa.array(removed, type=pa.int64()),
                "kept": pa.array(kept, type=pa.binary()).cast(pa.string()),
            }
        )

    return run


def _blocks(docs: DataFrame, text_col: str, blocks: int) -> DataFrame:
    """The rows in a bucketed table, a bucket for each block."""
    spark = docs.sparkSession
    name = f"substring_blocks_{uuid.uuid4().hex}"
    (
        docs.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int"))
        .withColumn("text", text_or_empty(text_col))
        .repartition(blocks, "block")
        .write.bucketBy(blocks, "block")
        .sortBy("block")
        .option("path", scratch_path(spark, "substring-blocks"))
        .saveAsTable(name)
    )
    rows = spark.table(name)  # knows its files and buckets from here on
    spark.sql(f"DROP TABLE {name}")  # the name only: the files lie outside the warehouse
    return rows


def without_repeats(
    docs: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    rows: int = ROWS,
    respace: bool = True,
) -> DataFrame:
    """The rows of ``docs`` without ``text_col``, plus ``n_words``, ``n_removed`` and ``kept``.

    ``kept`` is the words that stay, joined by one space; without ``respace`` a text that
    loses nothing stays as it is. Columns of the same names are replaced.
    """
    others = [c for c in docs.columns if c not in (text_col, "n_words", "n_removed", "kept")]
    inner = {c: f"c{i}" for i, c in enumerate(others)}  # the caller's names may clash with ours
    plain = docs.select(F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    segments = max(1, -(-(size // _WORD_BYTES * CELLS) >> SEGMENT_BITS))
    table = _blocks(plain, "text", int(blocks))
    texts = table.select("block", "text")

    sketches = texts.groupBy("block").applyInArrow(_sketch(window, rows, segments), _SKETCH)
    again = cut(
        sketches.groupBy("row", "segment").applyInArrow(_merge_sketches, _REPEATED), "sketch"
    )
    keys = (
        texts.groupBy("block")
        .cogroup(again.groupBy("block"))
        .applyInArrow(_emit_keys(window, rows, segments), _KEYS)
    )
    confirmed = keys.groupBy("segment").applyInArrow(_count_keys, _CONFIRMED)
    marks = again.unionByName(confirmed.withColumn("row", F.lit(-1)))
    fields = ", ".join(f"{n} {plain.schema[n].dataType.simpleString()}" for n in inner.values())
    result = (
        table.groupBy("block")
        .cogroup(marks.groupBy("block"))
        .applyInArrow(
            _keep(window, rows, segments, list(inner.values()), respace),
            f"{fields}, n_words bigint, n_removed bigint, kept string",
        )
    )
    return result.select(
        *[F.col(n).alias(c) for c, n in inner.items()], "n_words", "n_removed", "kept"
    )
