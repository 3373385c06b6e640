"""Token counts of whole texts without their ids.

A tokenizer cuts a text into pre-tokens and each of these into pieces, whatever stands
around it. So:

1. all texts are cut into pre-tokens, which are counted; counts combine per task;
2. the pieces of each distinct pre-token are counted once, in the whole cluster;
3. the frequencies of pre-tokens per text are joined to these counts and summed.

In step 3 the ``HEAD`` most frequent pre-tokens, a table of bounded size that covers most
of any text, are looked up where the text is read; only the rare rest is shuffled, and
it holds no hot key by its making.

Special tokens inside texts are found first and count as one, as the library does.

Edge cases: null texts are empty; an empty text has no token; repeated rows are counted
each; long texts go through whole, only their distinct rare pre-tokens are kept; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.support import slices, text_or_empty
from slotledger.llm.tokens import load
from slotledger.session import cut

HEAD = 1 << 17  # pre-tokens in the broadcast table, some 5 MB
_DISTINCT = 400_000  # pre-tokens a task gathers before it hands their counts on


def _splitter(pattern: str, specials: list[str]) -> Callable[[str], list[str]]:
    """Pre-tokens of a text, special tokens among them."""
    import regex

    find = regex.compile(pattern).findall
    if not specials:
        return find
    marks = regex.compile("(" + "|".join(regex.escape(s) for s in specials) + ")")

    def split(text: str) -> list[str]:
        if not any(s in text for s in specials):
            return find(text)
        out: list[str] = []
        for i, part in enumerate(marks.split(text)):
            out += [part] if i % 2 else find(part)
        return out

    return split


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters for themselves, the others from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in own}, 0x100
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


def _special_tokens(path: str) -> list[str]:
    return [t.content for t in load(path).get_added_tokens_decoder().values()]


def _vocabulary(pattern: str, path: str):
    """Pre-tokens and how often they occur in the task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(pattern, _special_tokens(path))
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["pre", "n"],
            )
            counts.clear()
            return found

        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    counts.update(split(text))
                if len(counts) > _DISTINCT:
                    yield flush()
        yield flush()

    return run


def _count_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letters = load(path).model, _byte_letters()
        specials = set(_special_tokens(path))
        for batch in batches:
            pieces = [
                1 if p in specials else len(model.tokenize("".join([letters[b] for b in p.encode()])))
                for p in batch.column("pre").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pre"), batch.column("n"), pa.array(pieces, pa.int64())],
                names=["pre", "n", "pieces"],
            )

    return run


class _Known(dict):
    def __missing__(self, key):
        return 0


def _frequencies(pattern: str, path: str, head):
    """Per text its bytes, the tokens of frequent pre-tokens, and the rare pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(pattern, _special_tokens(path))
        known = _Known(head.value)
        pieces = known.__getitem__
        for batch in (part for whole in batches for part in slices(whole)):
            sizes, tokens, rare, times = [], [], [], []
            for text in batch.column("_text").to_pylist():
                own = split(text)
                sizes.append(len(text.encode()))
                tokens.append(sum(map(pieces, own)))
                rest = Counter([p for p in own if p not in known])
                rare.append(list(rest.keys()))
                times.append(list(rest.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(rare, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                names=["_id", "n_bytes", "_tokens", "_rare", "_times"],
            )

    return run


def _frequent(pieces: DataFrame, head: int) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens, ``head`` at most.

    Counts are taken in steps of an eighth of a power of two, a few hundred at any size;
    the table holds all pre-tokens from the lowest step on that it has room for.
    """
    step = F.floor(8 * F.log2(F.col("n"))).cast("int")
    steps = pieces.groupBy(step.alias("step")).count().collect()
    room, lowest = head, None
    for row in sorted(steps, reverse=True):
        room -= row["count"]
        if room < 0:
            break
        lowest = row["step"]
    if lowest is None:
        return {}
    return {r.pre: r.pieces for r in pieces.filter(step >= lowest).select("pre", "pieces").collect()}


def token_counts(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` per row.

    ``path`` is a byte-level BPE tokenizer's file, ``pattern`` the expression by which it
    cuts texts into pre-tokens.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    vocabulary = (
        texts.select("_text").mapInArrow(_vocabulary(pattern, path), "pre string, n bigint")
        .groupBy("pre").agg(F.sum("n").alias("n"))
    )
    pieces = cut(
        vocabulary.mapInArrow(_count_pieces(path), "pre string, n bigint, pieces bigint"), "pieces"
    )
    table = spark.sparkContext.broadcast(_frequent(pieces, head))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = cut(
        texts.mapInArrow(
            _frequencies(pattern, path, table),
            f"_id {kind}, n_bytes bigint, _tokens bigint, _rare array<string>, _times array<bigint>",
        ).withColumn("_row", F.monotonically_increasing_id()),
        "frequencies",
    )
    rare = rows.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("_r")).select(
        "_row", F.col("_r._rare").alias("pre"), F.col("_r._times").alias("_times")
    )
    summed = (
        rare.join(pieces.select("pre", "pieces"), "pre")
        .groupBy("_row").agg(F.sum(F.col("_times") * F.col("pieces")).alias("_more"))
    )
    return rows.select("_row", "_id", "n_bytes", "_tokens").join(summed, "_row", "left").select(
        F.col("_id").alias(id_col),
        "n_bytes",
        (F.col("_tokens") + F.coalesce("_more", F.lit(0))).alias("n_tokens"),
    )
