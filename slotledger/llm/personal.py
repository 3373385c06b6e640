"""Personal data: patterns of characters, and identifiers known by the words before them.

Strict patterns find e-mail addresses, IP addresses, card and phone numbers; these are the
seeds. Looser patterns propose mentions of the same kinds that the strict ones miss: other
separators, no country code, a failed check digit, IPv6. Whether a proposal is taken is
learnt by bootstrapping:

1. the last word and the last two words before a mention are its lexical patterns;
   patterns and the distinct identifiers met after them form a graph for each kind;
2. a pattern's confidence is the share of its occurrences in all texts that are followed by
   a known identifier, each counted with its score; it needs ``MIN_KNOWN`` of them and a
   confidence of ``CONFIDENT``;
3. an identifier's score is one for a seed, else that at least one of its confident patterns
   is right, taken as independent. New scores change confidences: steps 2 and 3 are repeated
   until no score changes, ``ROUNDS`` times at most.

An identifier once known is found wherever it stands. Words like "the" come before seeds
too, but mostly before other words, so they never become confident; without seeds nothing
is added. Proposals that touch a strict span are left out.

The graph holds distinct (pattern, identifier) pairs only, counted before the shuffle; texts
are read twice, once for mentions and once to count the words and word pairs that are
patterns. Nothing of either size meets in one place.

Edge cases: a null or empty text has no spans; long texts are read whole, every expression
takes linear time; repeated rows are judged each and count each; an identifier with equal
scores in two kinds is taken as the first kind; empty tables give empty results; columns
other than id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.support import bounded, slices, text_or_empty
from slotledger.llm.words import ALNUM, mix, words_of
from slotledger.session import cut

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
MIN_KNOWN, CONFIDENT, ROUNDS = 3, 0.5, 10
PATTERNS = 1_000_000  # patterns up to this number are broadcast to where words are counted

# Fixed patterns of the strict kinds; none of them retries after a failed check.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser ones: what may stand around an "@", a number with separators, colons as in IPv6.
_ASIDE = r"\s@<>()\[\]{}\"',;:|="
_BEFORE, _AFTER = re.compile(rf"[^{_ASIDE}]{{1,64}}\Z"), re.compile(rf"@[^{_ASIDE}]{{1,255}}")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[ ().\-/]{0,2}[0-9])++(?![0-9A-Za-z])")
_COLONS = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{0,4}:){2,7}+[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:.])")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # after A-Z are lower-cased
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        if found := _DOMAIN.match(text, at):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = found.end()
                yield start, done
        at = text.find("@", at + 1)


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of what the strict patterns find, by kind, then start."""
    out = [(EMAIL, *span) for span in _emails(text)]
    for found in _DOTTED.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found[0].split(".")):
            out.append((IP, *found.span()))
    for found in _CARD.finditer(text):
        digits = _digits(found[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((CARD, *found.span()))
    for found in _PHONE.finditer(text):
        if 8 <= len(_digits(found[0])) <= 15:
            out.append((PHONE, *found.span()))
    return out


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Kind, start and end of possible mentions."""
    at = text.find("@")
    while at >= 0:
        before, after = _BEFORE.search(text[max(0, at - 64) : at]), _AFTER.match(text, at)
        if before and after:
            yield EMAIL, at - len(before[0]), after.end()
        at = text.find("@", at + 1)
    for found in _COLONS.finditer(text):
        if sum(c != ":" for c in found[0]) > 2:
            yield IP, *found.span()
    for found in _NUMBER.finditer(text):
        digits = len(_digits(found[0]))
        if 12 <= digits <= 19:
            yield CARD, *found.span()
        if 7 <= digits <= 15:
            yield PHONE, *found.span()


def identifier(kind: int, text: str) -> str:
    """One form for all spellings of an identifier."""
    return text.translate(_FOLD) if kind in (EMAIL, IP) else _digits(text)


def words_before(text: str, start: int) -> list[str]:
    """The patterns of a mention: the last word before it and the last two."""
    reach = 64
    while True:
        first = max(0, start - reach)
        words = [m.span() for m in _WORD.finditer(text[first:start].translate(_FOLD))]
        # A word that begins where the look back does may be longer.
        whole = [w for w in words if w[0] > 0 or first == 0]
        if len(whole) >= 2 or first == 0:
            break
        reach *= 4
    own = [text[first + a : first + b].translate(_FOLD) for a, b in whole[-2:]]
    return [" ".join(own[-n:]) for n in (1, 2) if len(own) >= n]


def mentions_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple]]:
    """Strict spans, and all mentions: kind, start, end, strict, identifier, patterns."""
    strict = strict_spans(text)
    covered = sorted((start, end) for _, start, end in strict)
    starts = [start for start, _ in covered]
    reach = np.maximum.accumulate([end for _, end in covered]) if covered else []
    found = [(*span, True) for span in strict]
    for kind, start, end in loose_spans(text):
        at = int(np.searchsorted(starts, end))  # strict spans that begin before the end
        if not at or reach[at - 1] <= start:
            found.append((kind, start, end, False))
    return strict, [
        (k, a, b, known, identifier(k, text[a:b]), words_before(text, a)) for k, a, b, known in found
    ]


_SPANS = "array<struct<kind:int,start:int,end:int>>"
_MENTIONS = "array<struct<kind:int,start:int,end:int,strict:boolean,identifier:string,patterns:array<string>>>"
_ANY = re.compile("[0-9@:]")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    more = [("strict", pa.bool_()), ("identifier", pa.string()), ("patterns", pa.list_(pa.string()))]
    for batch in (part for whole in batches for part in slices(whole)):
        strict, mentions = [], []
        for text in batch.column("_text").to_pylist():
            spans, found = mentions_of(text) if _ANY.search(text) else ([], [])
            strict.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
            mentions.append([dict(zip([n for n, _ in span + more], m)) for m in found])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                pa.array(strict, type=pa.list_(pa.struct(span))),
                pa.array(mentions, type=pa.list_(pa.struct(span + more))),
            ],
            names=["_id", "_strict", "_mentions"],
        )


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first ^ (second * np.uint64(0xD6E8FEB86659FD93)))


def _number_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A number for each pattern, the same that ``_count_words`` gives its occurrences."""
    for batch in batches:
        numbers = np.zeros(batch.num_rows, dtype=np.uint64)
        for found in words_of(batch.column("pattern"), ALNUM):
            for i in range(found.count):
                own = found.hashes[found.bounds[i] : found.bounds[i + 1]]
                numbers[found.first + i] = own[0] if len(own) == 1 else _pair(own[:1], own[1:])[0]
        yield pa.RecordBatch.from_arrays(
            [batch.column("pattern"), pa.array(numbers.view(np.int64))], names=["pattern", "_number"]
        )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word and each pair of neighbours occurs in a slice of texts."""
    for batch in batches:
        for found in words_of(batch.column("_text"), ALNUM):
            inside = np.ones(len(found.hashes), dtype=bool)
            ends = found.bounds[1:][found.bounds[1:] > found.bounds[:-1]] - 1
            inside[ends] = False  # a text's last word has no neighbour
            at = np.flatnonzero(inside)
            pairs = _pair(found.hashes[at], found.hashes[at + 1])
            for numbers in (found.hashes, pairs):
                distinct, times = np.unique(numbers, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct.view(np.int64)), pa.array(times.astype(np.int64))],
                    names=["_number", "_times"],
                )


def _occurrences(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """``pattern`` and how often its words stand in the texts, as ``total``."""
    numbered = patterns.mapInArrow(_number_patterns, "pattern string, _number bigint")
    wanted = bounded(numbered.select("_number").distinct(), PATTERNS)
    counted = (
        texts.select("_text").mapInArrow(_count_words, "_number bigint, _times bigint")
        .join(wanted, "_number").groupBy("_number").agg(F.sum("_times").alias("total"))
    )
    return cut(numbered.join(counted, "_number").select("pattern", "total"), "pattern-totals")


def _share(hits: Column | str) -> Column:
    """Of a pattern's occurrences; ``hits`` in millionths."""
    return F.least(F.round(F.col(hits).cast("double") / 1e6 / F.col("total"), 6), F.lit(1.0))


def confident_patterns(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """``kind``, ``pattern`` and ``confidence`` of the patterns that can be relied on.

    ``edges`` has ``kind``, ``pattern``, ``identifier``, ``times`` and the pattern's ``total``;
    ``scores`` has ``kind``, ``identifier`` and ``score``.
    """
    # Whole numbers add up alike in any order.
    hits = F.sum(F.round(F.col("times") * F.col("score") * 1e6).cast("decimal(38,0)"))
    known = edges.join(scores, ["kind", "identifier"]).groupBy("kind", "pattern", "total")
    return (
        known.agg(hits.alias("hits"), F.count("*").alias("known")).filter(F.col("known") >= MIN_KNOWN)
        .select("kind", "pattern", _share("hits").alias("confidence"))
        .filter(F.col("confidence") >= CONFIDENT)
    )


def scored(edges: DataFrame, seeds: DataFrame, patterns: DataFrame) -> DataFrame:
    """``kind``, ``identifier`` and ``score`` of seeds and of what confident patterns precede."""
    doubt = F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-3)))
    met = edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "identifier").agg(
        F.sum(F.round(doubt * 1e6).cast("bigint")).alias("_doubt")
    )
    found = met.select("kind", "identifier", F.round(1 - F.exp(F.col("_doubt") / 1e6), 6).alias("score"))
    both = seeds.withColumn("score", F.lit(1.0)).unionByName(found)
    return both.groupBy("kind", "identifier").agg(F.max("score").alias("score"))


def bootstrap(mentions: DataFrame, texts: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Known identifiers with their scores, and the confident patterns.

    ``mentions`` has ``kind``, ``strict``, ``identifier`` and ``patterns``; ``texts`` has ``_text``.
    """
    seeds = mentions.filter("strict").select("kind", "identifier").distinct()
    edges = cut(
        mentions.select("kind", "identifier", F.explode("patterns").alias("pattern"))
        .groupBy("kind", "pattern", "identifier").agg(F.count("*").alias("times")),
        "pattern-graph",
    )
    # A pattern with fewer identifiers than it needs to know can never be relied on.
    often = edges.groupBy("kind", "pattern").agg(F.count("*").alias("_met")).filter(F.col("_met") >= MIN_KNOWN)
    totals = _occurrences(often.select("pattern").distinct(), texts)
    # Only patterns that would be relied on if all they precede were known can ever be.
    met = edges.groupBy("kind", "pattern").agg(
        (1e6 * F.sum("times")).alias("_hits"), F.count("*").alias("_met")
    )
    able = (F.col("_met") >= MIN_KNOWN) & (_share("_hits") >= CONFIDENT)
    met = met.join(totals, "pattern").filter(able).select("kind", "pattern", "total")
    edges = cut(edges.join(met, ["kind", "pattern"]), "able-patterns")
    scores, before = seeds.withColumn("score", F.lit(1.0)), None
    for _ in range(rounds):
        scores = cut(scored(edges, seeds, confident_patterns(edges, scores)), "scores")
        now = scores.agg(F.count("*"), F.sum(F.round(F.col("score") * 1e6).cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return scores.filter(F.col("score") >= CONFIDENT), confident_patterns(edges, scores)


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, the ``strict`` spans and all ``spans``.

    Spans are structs of kind (a place in ``KINDS``), start and end in code points, end
    exclusive, by kind, then start.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    found = texts.mapInArrow(_find, f"_id {id_type}, _strict {_SPANS}, _mentions {_MENTIONS}")
    rows = cut(found.withColumn("_row", F.monotonically_increasing_id()), "mentions")
    mentions = rows.select("_row", F.explode("_mentions").alias("_m")).select("_row", "_m.*")
    known, _ = bootstrap(mentions, texts, rounds)
    # A number may be proposed as a card and as a phone: the likelier kind is taken.
    loose = mentions.filter("NOT strict").join(known, ["kind", "identifier"])
    best = F.min(F.struct((-F.col("score")).alias("less"), "kind")).alias("_best")
    taken = loose.groupBy("_row", "start", "end").agg(best)
    span = F.struct(F.col("_best.kind").alias("kind"), "start", "end")
    added = taken.groupBy("_row").agg(F.collect_list(span).alias("_added"))
    every = F.array_sort(F.concat("_strict", F.coalesce("_added", F.array().cast(_SPANS))))
    return rows.select("_row", "_id", "_strict").join(added, "_row", "left").select(
        F.col("_id").alias(id_col), F.col("_strict").alias("strict"), every.alias("spans")
    )


def span_list(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
