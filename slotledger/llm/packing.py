"""Packing of examples into sequences of bounded tokens, segments and loss-bearing tokens.

Vector bin packing by the dot-product heuristic: the open sequence takes the example
whose demand, as shares of the limits, has the largest dot product with what is left of
them. When none fits, the best one is cut to fill the sequence and its tail waits on.
What cannot be filled closes at a power of two, a length that needs no padding, and the
tokens beyond return to the pool; so only lengths ``max_tokens`` or a power of two occur
and nothing is padded at all.

Every partition packs its own rows with a pool of bounded size: no shuffle, no state
beyond a task, and a lost task is repeated alike. At most about log2(max_tokens) short
sequences remain per partition.

Edge cases: a null or empty text has its end token only; long texts span sequences;
repeated rows are packed each; an example without ids gives no piece; extra columns are
not read; of examples that score the same the one that has waited longest is taken; empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from slotledger.llm.support import slices, text_or_empty
from slotledger.llm.tokens import SLICE_TEXTS, encode_texts, forget_words

MAX_TOKENS, MAX_SEGMENTS = 4096, 256
POOL = 256  # examples the heuristic chooses from
_SEQUENCE_BITS = 32  # a sequence's number within its partition
_FLUSH = 1 << 22  # bytes of ids per output batch
_PIECE = ["_id", "ids", "start", "length", "doc_tokens", "loss_tokens", "sequence_id", "offset"]


class _Example:
    """What is left of an example: ids from ``start`` on, and running sums of its loss tokens."""

    __slots__ = ("key", "ids", "loss", "start", "total")

    def __init__(self, key, ids: np.ndarray, loss: np.ndarray):
        self.key, self.ids, self.start, self.total = key, ids, 0, len(ids)
        self.loss = loss  # loss[i]: loss-bearing tokens before ids[i]; one entry more than ids

    def demand(self) -> tuple[int, int, int]:
        return len(self.ids), 1, int(self.loss[-1] - self.loss[0])

    def longest(self, tokens: int, loss: int) -> int:
        """How many of the next ids keep within both limits."""
        allowed = np.searchsorted(self.loss, self.loss[0] + loss, side="right") - 1
        return int(min(tokens, len(self.ids), allowed))

    def take(self, length: int) -> tuple:
        """Cut off the next ids: key, ids, start, length, ids of the example, loss tokens."""
        loss = int(self.loss[length] - self.loss[0])
        piece = (self.key, self.ids[:length].tobytes(), self.start, length, self.total, loss)
        self.start += length
        self.ids, self.loss = self.ids[length:], self.loss[length:]
        return piece


class Packer:
    """Fills sequences from a pool; finished pieces gather in ``pieces``."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, first_sequence: int):
        self.limits = np.array([max_tokens, max_segments, max_loss], dtype=np.float64)
        self.max_tokens, self.max_loss = max_tokens, max_loss
        self.pool: list[_Example] = []
        self.demands = np.zeros((POOL, 3))  # of the pool's examples, row by row
        self.pieces: list[tuple] = []  # as taken, then sequence and offset
        self.sequence = first_sequence

    def add(self, example: _Example) -> None:
        while example.longest(self.max_tokens, self.max_loss) == self.max_tokens:
            self._close([(example, self.max_tokens)])
        if len(example.ids):
            if example.start:  # do not hold on to all of a long text
                example.ids, example.loss = example.ids.copy(), example.loss.copy()
            self.demands[len(self.pool)] = example.demand()
            self.pool.append(example)
        if len(self.pool) >= POOL:
            while len(self.pool) > POOL // 2:
                self._fill()

    def finish(self) -> None:
        while self.pool:
            self._fill()

    def _close(self, chosen: list[tuple[_Example, int]]) -> None:
        offset = 0
        for example, length in chosen:
            self.pieces.append((*example.take(length), self.sequence, offset))
            offset += length
        self.sequence += 1

    def _fill(self) -> None:
        """Close one sequence from the pool."""
        left = self.limits.copy()
        demands = self.demands[: len(self.pool)]
        shares = demands / self.limits
        waiting = np.ones(len(self.pool), dtype=bool)
        chosen: list[tuple[int, int]] = []  # place in the pool, ids taken
        used = 0
        while left[0] >= 1 and left[1] >= 1 and waiting.any():
            scores = shares @ (left / self.limits)
            fitting = waiting & (demands <= left).all(axis=1)
            at = int(np.argmax(np.where(fitting if fitting.any() else waiting, scores, -1.0)))
            example = self.pool[at]
            length = example.longest(int(left[0]), int(left[2]))
            waiting[at] = False
            if not length:  # its next token bears loss, and that is used up
                continue
            left -= (length, 1, example.loss[length] - example.loss[0])
            chosen.append((at, length))
            used += length
        if used < self.max_tokens:
            keep = 1 << (used.bit_length() - 1)
            while used > keep:
                at, length = chosen.pop()
                cut = min(length, used - keep)
                used -= cut
                if length > cut:
                    chosen.append((at, length - cut))
        self._close([(self.pool[at], length) for at, length in chosen])
        kept = np.ones(len(self.pool), dtype=bool)
        for at, _ in chosen:
            self.demands[at] = self.pool[at].demand()
            kept[at] = len(self.pool[at].ids) > 0
        places = np.flatnonzero(kept)
        self.demands[: len(places)] = self.demands[places]
        self.pool = [self.pool[at] for at in places.tolist()]


def _lay(
    examples: Iterator[_Example], kind: pa.DataType, max_tokens: int, max_segments: int, max_loss: int
) -> Iterator[pa.RecordBatch]:
    """Pieces of one partition's examples."""
    first = TaskContext.get().partitionId() << _SEQUENCE_BITS
    packer = Packer(max_tokens, max_segments, max_loss, first)

    def flush() -> pa.RecordBatch:
        rows, packer.pieces = packer.pieces, []
        keys, ids, *longs = zip(*rows) if rows else [()] * len(_PIECE)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, type=kind),
                pa.array(ids, type=pa.binary()),
                *[pa.array(x, type=pa.int64()) for x in longs],
            ],
            names=_PIECE,
        )

    waiting = 0
    for example in examples:
        waiting += 4 * len(example.ids)
        packer.add(example)
        if waiting > _FLUSH:
            yield flush()
            waiting = 0
    packer.finish()
    yield flush()


def _run(examples, plain: DataFrame, id_col: str, limits: tuple[int, int, int]) -> DataFrame:
    kind = plain.schema["_id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _lay(examples(batches), arrow, *limits)

    longs = ", ".join(f"{name} bigint" for name in _PIECE[2:])
    laid = plain.mapInArrow(run, f"_id {kind.simpleString()}, ids binary, {longs}")
    return laid.withColumnRenamed("_id", id_col)


def _given(batches: Iterator[pa.RecordBatch]) -> Iterator[_Example]:
    for batch in batches:
        for key, packed, marks in zip(*(batch.column(c) for c in ("_id", "_ids", "_loss"))):
            ids = np.frombuffer(packed.as_py() or b"", dtype="<u4")
            loss = np.zeros(len(ids) + 1, dtype=np.int64)
            np.cumsum(np.frombuffer(marks.as_py() or b"", dtype=np.uint8), out=loss[1:])
            yield _Example(key.as_py(), ids, loss)


def pack(
    examples: DataFrame,
    id_col: str,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_TOKENS,
) -> DataFrame:
    """Pieces of ``examples`` laid into sequences.

    ``examples`` has ``id_col``, ``ids`` (little-endian unsigned 32-bit ids as binary) and
    ``loss`` (binary, one byte per id, 1 where it bears loss). Per piece: ``id_col``,
    ``ids``, ``start`` and ``length`` in its example of ``doc_tokens`` ids, ``loss_tokens``,
    ``sequence_id`` and ``offset``.
    """
    plain = examples.select(
        F.col(id_col).alias("_id"), F.col("ids").alias("_ids"), F.col("loss").alias("_loss")
    )
    return _run(_given, plain, id_col, (max_tokens, max_segments, max_loss))


def _tokenized(path: str, end_id: int, drops_spaces: bool, keep_words: bool = True):
    """Whole texts as examples; all ids but the closing one bear loss."""

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[_Example]:
        for batch in (part for whole in batches for part in slices(whole, SLICE_TEXTS)):
            keys = iter(batch.column("_id").to_pylist())
            for ids, bounds in encode_texts(batch.column("_text"), path, drops_spaces):
                for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = np.empty(end - begin + 1, dtype="<u4")
                    own[:-1], own[-1] = ids[begin:end], end_id
                    loss = np.arange(len(own) + 1)
                    loss[-1] -= 1
                    yield _Example(next(keys), own, loss)
        if not keep_words:
            forget_words(path)

    return examples


def pack_texts(
    docs: DataFrame,
    id_col: str,
    path: str,
    end_id: int,
    text_col: str = "text",
    drops_spaces: bool = True,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_TOKENS,
    keep_words: bool = True,
) -> DataFrame:
    """Tokenize whole texts with the tokenizer at ``path``, close each with ``end_id`` and pack.

    Without ``keep_words`` a worker gives back the memory of the words it knows after each
    task, for jobs that go on with other work; the next task encodes them again.
    """
    plain = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    examples = _tokenized(path, end_id, drops_spaces, keep_words)
    return _run(examples, plain, id_col, (max_tokens, max_segments, max_loss))
