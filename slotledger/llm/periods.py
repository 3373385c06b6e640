"""Periodic runs of words.

A run is a stretch of words with a smallest period that fits at least twice into it and
that no neighbouring word extends. By the runs theorem every run holds a Lyndon word, in
the order of the words or its reverse, that is the longest one starting where it starts
and as long as the period. So:

1. suffix trees of the words and of their reversal are built (``suffix_tree.py``);
2. the tree's leaves, toured in either order, rank the suffixes; the next lower suffix of
   each place ends the longest Lyndon word there: two candidate roots for a place;
3. each candidate is extended to the right by the common extension of its two ends in the
   first tree, and to the left in the second. What reaches two periods is a run.

Words far from any repetition get no tree. A run of ``length`` words with period q repeats
each run of ``ceil(min_length / 2)`` words in its first ``length - q`` words at distance q,
and at least ``q - ceil(min_length / 2) + 1`` of them start next to each other. Stretches of
words that start repeated grams and are long enough for their distances are found by
hashes; a run lies wholly within reach of one such stretch. Equal hashes of different grams
only add words to the trees, so no run is lost.

Every text is one row of one task, without a shuffle; tasks that are lost are repeated
alike. Memory is some 500 bytes for each word within reach of a repetition of one text.

Edge cases: a null or wordless text has no runs and keeps nothing; long texts are read
whole; of equal rows each gives its own result; empty tables give empty results; columns
other than id and text are not read, so their names cannot clash. Runs that cover the
same words with different periods are all returned, ordered by start, then period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from slotledger.llm.suffix_tree import Extension, SuffixTree, ranks
from slotledger.llm.support import slices, text_or_empty
from slotledger.llm.words import SPACED, rolling, words_of

MIN_LENGTH = 12
_BASE = 0xA0761D6478BD642F


def _lyndon(rank: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word from each place on: up to the next lower suffix."""
    size = len(rank)
    lower = [size] * size
    for i in range(size - 2, -1, -1):
        j, own = i + 1, rank[i]
        while j < size and rank[j] > own:
            j = lower[j]
        lower[i] = j
    return np.array(lower) - np.arange(size)


def runs_of(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Start, length and period of all runs of positive ``symbols``, by start, then period."""
    size = len(symbols)
    if size < 2:
        return np.zeros((0, 3), dtype=np.int64)
    tree = SuffixTree(symbols.tolist())
    suffixes, parted = tree.tour()
    ascending, descending = ranks(suffixes), ranks(tree.tour(descending=True)[0])
    forward = Extension(suffixes, parted)
    backward = Extension(*SuffixTree(symbols[::-1].tolist()).tour())
    # The end counts as a place of its own in the tree, but is no word.
    period = np.concatenate([_lyndon(r[:-1].tolist()) for r in (ascending, descending)])
    start = np.tile(np.arange(size), 2)
    right = start + period + forward(start, start + period)
    left = start - backward(size - start, size - start - period)
    found = np.stack([left, period, right - left], axis=1)
    found = np.unique(found[right - left >= np.maximum(min_length, 2 * period)], axis=0)
    return found[:, [0, 2, 1]]


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of true values begin, and their lengths."""
    steps = np.diff(mask.astype(np.int8), prepend=0, append=0)
    begin = np.flatnonzero(steps == 1)
    return begin, np.flatnonzero(steps == -1) - begin


def repetitive(hashes: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Disjoint stretches of words, in order, that hold every run wholly."""
    gram = -(-min_length // 2)
    grams = rolling(hashes, gram, _BASE)
    order = np.argsort(grams, kind="stable")
    again = np.flatnonzero(grams[order][1:] == grams[order][:-1])
    if not len(again):
        return []
    distance = np.zeros(len(grams), dtype=np.int64)  # to the next place of the gram
    distance[order[again]] = order[again + 1] - order[again]
    near = distance > 0
    for _ in range(2):
        begin, count = _stretches(near)
        near[near] = distance[near] <= np.repeat(count + gram - 1, count)
    begin, count = _stretches(near)
    out: list[tuple[int, int]] = []
    for first, last in zip(begin.tolist(), (begin + 2 * (count + gram - 1)).tolist()):
        last = min(last, len(hashes))
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return [(a, b) for a, b in out if b - a >= min_length]


def runs_of_words(words: list[bytes], parts: list[tuple[int, int]], min_length: int) -> np.ndarray:
    """The runs in some stretches of a text's words, as places in the text."""
    numbers: dict[bytes, int] = {}
    symbols, places = [], []
    for first, last in parts:
        symbols += [numbers.setdefault(w, len(numbers) + 1) for w in words[first:last]]
        symbols.append(0)  # a wall, made different from all others below
        places.append(np.arange(first, last + 1))
    whole, place = np.array(symbols), np.concatenate(places)
    walls = whole == 0
    whole[walls] = len(numbers) + 1 + np.arange(walls.sum())
    found = runs_of(whole, min_length)
    return np.column_stack([place[found[:, 0]], found[:, 1:]])


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(mark, runs[:, 0] + runs[:, 2], 1)
    np.add.at(mark, runs[:, 0] + runs[:, 1], -1)
    covered = np.cumsum(mark[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~covered).tolist()]


def _judge(min_length: int, kind: pa.DataType):
    run_kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column("_text")
            counts, runs, kept = [], [], []
            for found in words_of(texts, SPACED):
                for i in range(found.count):
                    hashes = found.hashes[found.bounds[i] : found.bounds[i + 1]]
                    words = texts[found.first + i].as_py().encode().split()
                    own = np.zeros((0, 3), dtype=np.int64)
                    if parts := repetitive(hashes, min_length):
                        own = runs_of_words(words, parts, min_length)
                    counts.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in own.tolist()])
                    kept.append(b" ".join(without_repeats(words, own) if len(own) else words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").cast(kind),
                    pa.array(counts, type=pa.int64()),
                    pa.array(runs, type=run_kind),
                    pa.array(kept, type=pa.string()),
                ],
                names=["_id", "n_words", "runs", "kept"],
            )

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_words``, ``runs`` and the words ``kept``.

    ``runs`` are structs of start, length and period, of at least ``min_length`` words;
    ``kept`` is the text without what runs repeat, its words joined by one space.
    """
    kind = docs.schema[id_col].dataType
    plain = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    found = plain.mapInArrow(
        _judge(min_length, to_arrow_type(kind)),
        f"_id {kind.simpleString()}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, kept string",
    )
    return found.withColumnRenamed("_id", id_col)


def _repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        texts = []
        for text, seed in zip(batch.column("_text"), batch.column("_seed").to_pylist()):
            words = text.as_py().encode().split()
            if words:
                first = seed % len(words)
                period = 1 + (len(words) - first) // (3 + seed % 8)
                words[first:] = [words[first + i % period] for i in range(len(words) - first)]
            texts.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(texts, type=pa.string())], names=["_id", "_text"]
        )


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 10) -> DataFrame:
    """``id_col`` and ``text_col``; one text in ``every``, by the CRC of its id, repeats from some word on.

    Rows without an id stay as they are.
    """
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    chosen = F.coalesce(crc % every == 0, F.lit(False))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("_id"),
        text_or_empty(text_col).alias("_text"),
        F.floor(crc / every).alias("_seed"),
        chosen.alias("_chosen"),
    )
    planted = rows.filter("_chosen").select("_id", "_text", "_seed").mapInArrow(_repeat, f"_id {kind}, _text string")
    both = rows.filter("NOT _chosen").select("_id", "_text").unionByName(planted)
    return both.select(F.col("_id").alias(id_col), F.col("_text").alias(text_col))
