"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slotledger.llm import queries, spelling
from tests.llm.conftest import TEXTS, ordered


def near(u, v):
    """One letter inserted, deleted or replaced."""
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.text(alphabet="abÿ", max_size=6), min_size=1, max_size=25), min_size=1, max_size=4))
def test_rows_one_edit_apart(groups):
    groups = [sorted(g) for g in groups]
    rows = [w for g in groups for w in g]
    length = np.array([len(w) for w in rows])
    flat = np.frombuffer("".join(rows).encode("utf-32-le"), "<u4")
    new = np.array([i == 0 for g in groups for i in range(len(g))])
    found = zip(*(x.tolist() for x in spelling.near_rows(flat, np.cumsum(length) - length, length, new)))
    number = np.repeat(np.arange(len(groups)), [len(g) for g in groups]).tolist()
    expected = [
        (i, j) for i, u in enumerate(rows) for j, v in enumerate(rows) if number[i] == number[j] and near(u, v)
    ]
    assert sorted(found) == expected


def plain_variants(counts, ratio=10):
    out, forms = [], {}
    for word in counts:
        others = [v for v in counts if v != word and near(word, v)]
        form = min(others, key=lambda v: (-counts[v], v), default=None)
        if form is not None and counts[form] >= ratio * counts[word]:
            forms[word] = form
        out.append([word, forms.get(word), None, counts[word], len(others), counts.get(forms.get(word))])
    for row in out:
        row[2] = row[0]
        while row[2] in forms:
            row[2] = forms[row[2]]
    return ordered(map(tuple, out))


def some_words(seed, count, letters="abcé", longest=11):
    draw = random.Random(seed)
    words = set()
    while len(words) < count:
        word = "".join(draw.choice(letters) for _ in range(draw.randrange(1, longest)))
        words.add(word)
        if len(word) > 1 and draw.random() < 0.5:
            i = draw.randrange(len(word))
            words.add(word[:i] + draw.choice(["", "z", "zz", word[i] + "q"]) + word[i + 1 :])
    words.discard("")
    return {w: draw.choice([2, 3, 25, 40, 300, 2_500, 30_000]) for w in sorted(words)}


@pytest.mark.parametrize(("group", "batch"), [(1000, 20_000), (6, 1), (1, 50)])
def test_variants_of_all_words(spark, group, batch, monkeypatch):
    """Groups of any size find the same pairs, each once."""
    monkeypatch.setattr(spelling, "BATCH", batch)
    counts = {**some_words(5, 500), **{"prefixes" + a + b: 2 + ord(a) for a in "abcdefgh" for b in "abcdefgh"}}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(4)
    found = spelling.spelling_variants(words, group=group).collect()
    assert ordered(tuple(r) for r in found) == plain_variants(counts)
    assert any(r.root != r.word and r.root != r.form for r in found)


def test_registered_query(spark, nothing, tmp_path):
    draw = random.Random(3)
    stock = ["Straßenbahn", "éclairage", "letters", "ordinary", "ORDINARY", "ordinari", "Ünïcode", "naïveté", "spelling"]
    rows = [(i, " ".join(draw.choices(stock, [9, 9, 9, 60, 9, 1, 9, 9, 60], k=60)) + "!,x9y") for i in range(200)]
    rows += [*TEXTS, (500, "ab" * 3000), (500, "ab" * 3000)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS word", "1 AS n")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if crc % 31 == 0:
                run = run[: crc % len(run)] + run[crc % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    found = queries.op11_spelling_variants(spark, str(tmp_path)).collect()
    assert ordered(tuple(r) for r in found) == plain_variants(counts)
    assert sum(r.form is not None for r in found) > 5
    assert spelling.spelling_variants(spelling.vocabulary(spelling.with_lost_letters(spelling.letter_runs(nothing), 31))).count() == 0
