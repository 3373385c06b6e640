"""Personal data: strict spans against the plain expressions, bootstrapping against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slotledger.llm import personal, queries
from tests.llm.conftest import TEXTS, ordered, prose, words

# Fixed patterns of the contract.
PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = [
                lambda: True,
                lambda: all(int(p) <= 255 for p in m[0].split(".")),
                lambda: 16 <= len(digits) <= 19 and luhn(digits),
                lambda: 8 <= len(digits) <= 15,
            ][kind]()
            if ok:
                out.append((kind, *m.span()))
    return out


PIECES = ["@", ".", "+", "-", " ", "1", "25", "256", "a", "B%", "(", ")", "é", "\n", "+4 ", "4242424242424242", "x@y.z", "1.2.3.4", "::"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_strict_spans_follow_the_expressions(text):
    assert personal.strict_spans(text) == plain_spans(text)
    strict = personal.strict_spans(text)
    for kind, start, end, known, _, before in personal.mentions_of(text)[1]:
        assert known == ((kind, start, end) in strict)
        assert known or not any(a < end and b > start for _, a, b in strict)
        own = words(text[:start])
        assert before == [" ".join(own[-n:]) for n in (1, 2) if len(own) >= n]


@pytest.mark.parametrize("text", ["A" * 300_000, "1" * 300_000, "1 " * 150_000, "a@" * 100_000, ":" * 200_000, "+1" * 100_000, "1." * 100_000 + "@"])
def test_long_texts_take_linear_time(text):
    personal.mentions_of(text)


def people(seed):
    """Numbers after "phone", some in forms the strict patterns miss, among words that tell nothing."""
    draw = random.Random(seed)
    rows = []
    for i in range(120):
        number = f"{draw.randrange(200, 999)} {draw.randrange(100, 999)}-{draw.randrange(1000, 9999)}"
        host = f"10.{i}.7.{i}"
        lines = [
            f"phone: +1 {number}" if i % 3 else f"phone: {number}",
            f"reach me, {number}" if i % 6 == 0 else "reach me soon",
            f"server {host}" if i % 2 else f"server fe80::{i:x}:1",
            f"the year {draw.randrange(1000000, 9999999)} and the {draw.randrange(1000, 9999)}",
            f"mail to user{i}@corp" if i % 4 == 0 else f"mail to user{i}@corp.example.org",
            "the phone rang" if i % 4 == 0 else "all is quiet",
        ]
        draw.shuffle(lines)
        rows.append((i, f"{prose(seed + i, 15, 60)} " + "; ".join(lines)))
    return rows


def plain_bootstrap(texts):
    """Identifiers taken in, by kind, and the confident patterns."""
    edges, seeds, total = Counter(), set(), Counter()
    for text in texts:
        own = words(text)
        total.update(own)
        total.update(" ".join(p) for p in zip(own, own[1:]))
        for kind, _, _, strict, name, before in personal.mentions_of(text or "")[1]:
            if strict:
                seeds.add((kind, name))
            for pattern in before:
                edges[kind, pattern, name] += 1
    scores = dict.fromkeys(seeds, 1.0)
    confident = {}
    for _ in range(20):
        hits, known = defaultdict(float), Counter()
        for (kind, pattern, name), times in edges.items():
            if (kind, name) in scores:
                hits[kind, pattern] += times * scores[kind, name]
                known[kind, pattern] += 1
        share = {p: min(1, hits[p] / total[p[1]]) for p in hits if known[p] >= personal.MIN_KNOWN}
        confident = {p: c for p, c in share.items() if c >= personal.CONFIDENT}
        doubt = defaultdict(lambda: 1.0)
        for kind, pattern, name in edges:
            if (kind, pattern) in confident:
                doubt[kind, name] *= max(1 - confident[kind, pattern], 1e-3)
        scores = {x: 1.0 if x in seeds else 1 - doubt[x] for x in seeds | doubt.keys()}
    return {x: s for x, s in scores.items() if s >= personal.CONFIDENT}, confident


def plain_all_spans(texts):
    known, _ = plain_bootstrap(texts)
    out = []
    for text in texts:
        spans, best = set(plain_spans(text)), {}
        for kind, start, end, strict, name, _ in personal.mentions_of(text or "")[1]:
            if not strict and (kind, name) in known:
                best[start, end] = min(best.get((start, end), (0, 9)), (-known[kind, name], kind))
        out.append(sorted(spans | {(kind, *span) for span, (_, kind) in best.items()}))
    return out


def written(spans):
    return ",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in spans)


def test_personal_data(spark, docs, nothing, tmp_path):
    rows = [*people(11), *people(11)[:5], *TEXTS, (900, None), (901, "reach me at 4111 1111 1111 1111, +1 (743) 555-3824 or 1.2.3.4")]
    made = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    made.withColumn("kind", F.lit("x")).withColumn("_row", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    every = plain_all_spans([t for _, t in rows])
    expected = []
    for (doc, text), spans in zip(rows, every):
        strict = plain_spans(text)
        counts = [sum(k == kind for k, _, _ in strict) for kind in range(4)]
        expected.append((doc, *counts, hashlib.sha256(written(strict).encode()).hexdigest(), written(spans)))
    found = queries.op13_personal_data(spark, str(tmp_path)).collect()
    assert ordered(tuple(r) for r in found) == ordered(expected)
    assert personal.personal_data(nothing).count() == 0


def test_identifiers_the_strict_patterns_miss_are_found(spark):
    """All planted forms are found, and nothing else."""
    rows = people(23)
    made = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in personal.personal_data(made).collect():
        text = dict(rows)[r.doc_id]
        found = {text[s.start : s.end] for s in r.spans}
        wanted = {m for m in re.findall(r"phone: (\+?[0-9 -]+[0-9])|server (\S+[0-9])|mail to ([^;\s]+)|reach me, ([0-9 -]+[0-9])", text) for m in m if m}
        assert found == wanted


def test_words_that_tell_nothing_add_nothing(spark):
    """Seeds among common words: proposals beside the same words stay out."""
    rows = [(i, f"the {4242424242424242 + 0 * i} the {i + 1_000_000} the end of the day") for i in range(30)]
    rows += [(100 + i, f"the +1 743 555 {1000 + i} the {prose(i, 30)}") for i in range(30)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert personal.personal_data(made).filter("size(strict) <> size(spans)").count() == 0
