"""Grouping of spelling variants: words one inserted, deleted or replaced letter apart.

Of two such words, cut off the shorter one's first half and the same number of letters of
the longer one, or as many at their ends: one of both is equal. So words are dealt into
groups by their first half and by their last half, for the lengths m and m + 1 at a time,
and groups that are too large again by halves of what is left, until what is left is a
single letter. A pair is looked for in one group only: where the first halves agree, else
where the last do. So no pair is met twice, and none has to be stored to be counted.

A group is the sorted list of what is left of its words. Rows of the edit matrix are
computed for each word against the list, three cells around the diagonal each, letter by
letter: neighbours that share a prefix share its rows, and a range of the list is skipped
as soon as its shared prefix is more than one edit away. All words and all groups of a
batch advance together by one letter, as whole columns.

Words are counted before the shuffle; the groups have at most ``GROUP`` words, or as many
as two letters can tell apart, so no task gets a large one. A word has a bounded number of
neighbours, given the alphabet. Forms are followed to the root by doubling steps.

Edge cases: null and empty texts have no words; long texts are read whole; repeated rows
count as often as they occur; of forms equally frequent the first in code-point order is
taken; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.support import bounded
from slotledger.session import cut

LETTERS = "A-Za-zÀ-ÿ"
GROUP = 1000  # words; larger groups are divided
BATCH = 20_000  # rows compared at a time, or one group
_HOT = 100_000  # names of large groups up to this number are broadcast
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 1) -> DataFrame:
    """``id`` and ``run`` for each run of at least ``min_length`` letters, A-Z in lower case."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run")).withColumn(
        "run", F.translate("run", _UPPER, _LOWER)
    )


def with_lost_letters(runs: DataFrame, every: int) -> DataFrame:
    """``word``: of one run in ``every``, by a CRC of id and run, one letter is left out."""
    crc = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    place = (F.col("_crc") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", 1, place), F.substring("run", place + 2, F.length("run")))
    return runs.withColumn("_crc", crc).select(
        F.when(F.col("_crc") % every == 0, less).otherwise(F.col("run")).alias("word")
    )


def vocabulary(words: DataFrame, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """Distinct words and how often they occur, as ``word`` and ``n``."""
    long = words.filter(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


_GROUP = ["m", "sides", "key"]


def _divided(rows: DataFrame) -> DataFrame:
    """Each row in two smaller groups: by the first half of what is left, and by the last."""
    half = F.floor(F.col("left") / 2).cast("int")
    rest = F.length("rest") - half

    def side(name: str, shared: Column, kept: Column) -> Column:
        sides = F.concat("sides", F.lit(name)).alias("sides")
        return F.struct(sides, F.concat("key", shared).alias("key"), kept.alias("rest"))

    both = F.array(
        side("P", F.substring("rest", F.lit(1), half), F.substring("rest", half + 1, rest)),
        side("S", F.substring("rest", rest + 1, half), F.substring("rest", F.lit(1), rest)),
    )
    return rows.withColumn("_side", F.explode(both)).select(
        "m", (F.col("left") - half).alias("left"), "_side.sides", "_side.key", "_side.rest", "word", "n"
    )


def _members(words: DataFrame, group: int) -> DataFrame:
    """The words in all their groups; none has more than ``group`` words that can be divided."""
    lengths = F.array(F.length("word"), F.length("word") - 1)
    rows = words.select("word", "n", F.explode(lengths).alias("m")).filter("m > 0").select(
        "m", F.col("m").alias("left"), F.lit("").alias("sides"), F.lit("").alias("key"),
        F.col("word").alias("rest"), "word", "n",
    )
    # A single letter cannot be divided, but then the longer words have two letters only.
    done, rows = rows.filter("left < 2"), _divided(rows.filter("left >= 2"))
    while True:
        hot = rows.filter("left >= 2").groupBy(*_GROUP).agg(F.count("*").alias("_rows"))
        hot = cut(hot.filter(F.col("_rows") > group).drop("_rows"), "large-groups")
        if hot.isEmpty():
            return done.unionByName(rows)
        hot = bounded(hot, _HOT)
        done = done.unionByName(rows.join(hot, _GROUP, "left_anti").select(*rows.columns))
        rows = cut(_divided(rows.join(hot, _GROUP, "left_semi").select(*rows.columns)), "divided")


def _common_prefixes(flat: np.ndarray, first: np.ndarray, length: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Letters each row shares with the row before; -1 where a group begins."""
    out = np.where(new, -1, 0)
    rows = np.flatnonzero(~new)
    while len(rows):
        at = out[rows]
        more = (at < length[rows]) & (at < length[rows - 1])
        rows, at = rows[more], at[more]
        rows = rows[flat[first[rows] + at] == flat[first[rows - 1] + at]]
        out[rows] += 1
    return out


def near_rows(flat: np.ndarray, first: np.ndarray, length: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that are one edit apart, both ways round.

    Row i has the letters ``flat[first[i] : first[i] + length[i]]``; rows of a group stand
    together, sorted and distinct, and ``new`` marks the first of each.
    """
    size = len(first)
    shared = _common_prefixes(flat, first, length, new)
    flat = np.append(flat, np.uint32(0))

    def letter(rows: np.ndarray, at: int) -> np.ndarray:
        """0 beyond the end, which no word has."""
        return np.where(at < length[rows], flat[np.minimum(first[rows] + at, len(flat) - 1)], 0)

    begins = np.flatnonzero(new)
    sizes = np.diff(begins, append=size)
    word = np.arange(size)
    low, high = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
    some = np.repeat(sizes, sizes) > 1
    word, low, high = word[some], low[some], high[some]
    # Edits to the shared prefix from one letter less, as many letters, one letter more.
    less, same, more = (np.full(len(word), v, dtype=np.int8) for v in (2, 0, 1))
    left, right, depth = [], [], 0
    while len(word):
        # The word that ends here is the first of its range.
        ends = length[low] == depth
        gap = length[word] - depth
        edits = np.select([gap == 0, gap == 1, gap == -1], [same, more, less], 2)
        hit = ends & (edits == 1)
        left.append(word[hit])
        right.append(low[hit])
        # Ranges that share one letter more.
        starts = np.flatnonzero((shared <= depth) & (length > depth))
        stops = np.append(np.flatnonzero(shared <= depth), size)
        stops = stops[np.searchsorted(stops, starts, side="right")]
        a, b = np.searchsorted(starts, low), np.searchsorted(starts, high)
        count = b - a
        pick = np.repeat(a - (np.cumsum(count) - count), count) + np.arange(count.sum())
        word, less, same, more = (np.repeat(x, count) for x in (word, less, same, more))
        low, high = starts[pick], stops[pick]
        own = flat[first[low] + depth]
        before, here, after = (letter(word, depth + k) for k in (-1, 0, 1))
        if depth == 0:
            before = np.zeros_like(here)
        new_less = np.minimum(less + (before != own), same + 1)
        new_same = np.minimum(np.minimum(same + (here != own), more + 1), new_less + 1)
        more = np.minimum(more + (after != own), new_same + 1)
        same, less = new_same, new_less
        alive = np.flatnonzero(np.minimum(np.minimum(less, same), more) <= 1)
        word, low, high, less, same, more = (x[alive] for x in (word, low, high, less, same, more))
        depth += 1
    return np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])


def _in_its_group(u: str, v: str, m: int, sides: str) -> bool:
    """Whether this is the one group in which the pair is looked for."""
    if len(u) == len(v) == m + 1:  # met for the next length
        return False
    left = m
    for side in sides:
        half = left // 2
        if (u[:half] == v[:half]) != (side == "P"):
            return False
        u, v = (u[half:], v[half:]) if side == "P" else (u[: len(u) - half], v[: len(v) - half])
        left -= half
    return True


_NEAR = "word string, n_near bigint, form_n bigint, form string"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each row among its group: their number, and the most frequent."""

    def judged(rows: pa.Table) -> pa.RecordBatch:
        rest = rows.column("rest").combine_chunks().cast(pa.large_string())
        letters = "".join(rest.to_pylist())
        flat = np.frombuffer(letters.encode("utf-32-le"), dtype="<u4")
        length = np.array([len(x) for x in rest.to_pylist()], dtype=np.int64)
        new = rows.column("new").to_numpy()
        left, right = near_rows(flat, np.cumsum(length) - length, length, new)
        words, n = rows.column("word").to_pylist(), rows.column("n").to_pylist()
        m, sides = rows.column("m").to_pylist(), rows.column("sides").to_pylist()
        found: dict[int, tuple[int, int, str]] = {}
        for i, j in zip(left.tolist(), right.tolist()):
            if _in_its_group(words[i], words[j], m[i], sides[i]):
                count, most, form = found.get(i, (0, 0, ""))
                if n[j] > most or (n[j] == most and words[j] < form):
                    most, form = n[j], words[j]
                found[i] = (count + 1, most, form)
        columns = list(zip(*found.values())) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in found], type=pa.string()),
                *[pa.array(c, type=t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
            ],
            names=["word", "n_near", "form_n", "form"],
        )

    waiting: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in _GROUP)))
        new = np.array([a != b for a, b in zip(names, [last, *names])], dtype=bool)
        last = names[-1] if names else last
        batch = pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("m", "sides", "rest", "word", "n")], pa.array(new)],
            names=["m", "sides", "rest", "word", "n", "new"],
        )
        begin = 0
        for at in np.flatnonzero(new).tolist():  # a group is never cut
            if rows + at - begin >= BATCH:
                waiting.append(batch.slice(begin, at - begin))
                yield judged(pa.Table.from_batches(waiting))
                waiting, rows, begin = [], 0, at
        waiting.append(batch.slice(begin))
        rows += batch.num_rows - begin
    if rows:
        yield judged(pa.Table.from_batches(waiting))


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """Where ``form`` leads from each word after at most ``steps`` steps."""
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1, steps)))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = cut(
            roots.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots"
        )
    return roots


def spelling_variants(words: DataFrame, ratio: int = 10, group: int = GROUP) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of each word.

    ``words`` has distinct ``word`` and ``n``. Near words differ by one letter; the form of
    a word is the most frequent of them if it occurs ``ratio`` (more than 1) times as often
    or more, and the root is where forms lead.
    """
    words = cut(words.select("word", F.col("n").cast("bigint").alias("n")), "vocabulary")
    rows = _members(words, group).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "rest")
    near = rows.select(*_GROUP, "rest", "word", "n").mapInArrow(_compare, _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    often = -F.col("best.less") >= ratio * F.col("n")
    judged = cut(
        words.join(near, "word", "left").select(
            "word",
            F.when(often, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "near-words",
    )
    # Each step multiplies the count, so the largest bounds the steps.
    most, least = words.agg(F.max("n"), F.min("n")).first()
    steps = math.floor(math.log(max(1, (most or 1) / max(1, least or 1)), ratio)) + 1
    roots = _roots(judged.filter("form IS NOT NULL"), steps)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
