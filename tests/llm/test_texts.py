"""Operators over texts against plain Python, nulls, repeats, long and empty texts among them."""

import zlib
from collections import Counter, defaultdict
from struct import pack as packed

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slotledger.llm import licenses, queries, simhash, substrings, words as kernels
from slotledger.llm.components import roots
from slotledger.llm.decontaminate import contamination, winnow
from slotledger.llm.packing import Packer, _Example, pack_texts
from slotledger.llm.token_counts import token_counts
from slotledger.llm.tokens import encode_texts
from tests.llm.conftest import SHARED, TEXTS, ordered, prose, spaced, words

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(WORD_BPE)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB zé\x00日.\n\t9", max_size=40) | st.none(), max_size=8), st.integers(4, 30))
def test_word_hashes_follow_words(texts, slice_bytes):
    before, kernels.SLICE_BYTES = kernels.SLICE_BYTES, slice_bytes
    try:
        for table, plain in ((kernels.ALNUM, words), (kernels.SPACED, spaced)):
            found = [
                w.hashes[w.bounds[i] : w.bounds[i + 1]].tolist()
                for w in kernels.words_of(pa.array(texts, pa.string()), table)
                for i in range(w.count)
            ]
            expected = [plain(t) for t in texts]
            assert [len(x) for x in found] == [len(x) for x in expected]
            names = {}
            for hashes, own in zip(found, expected):
                for h, w in zip(hashes, own):
                    assert names.setdefault(w, h) == h
            assert len(set(names.values())) == len(names)
    finally:
        kernels.SLICE_BYTES = before


def thue_morse(size):
    """Two words that collide under every polynomial hash modulo 2**64."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(size))
    return word, word.translate(str.maketrans("ab", "ba"))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="ab9é", min_size=1, max_size=24), max_size=40))
def test_word_hashes_differ_in_each_lane(own):
    for found in kernels.words_of(pa.array([" ".join([*own, *thue_morse(4096)])]), kernels.SPACED):
        assert len(set(found.hashes.tolist())) == len(set(found.second.tolist())) == len(own) + 2


def test_words_that_fool_polynomials_are_told_apart(spark):
    first, second = thue_morse(2048)
    lead = prose(41, 34)
    docs = spark.createDataFrame([(1, f"{lead} {first}"), (2, f"{lead} {second}")], "doc_id bigint, text string")
    assert [r.n_removed for r in substrings.without_repeats(docs).collect()] == [0, 0]
    items = spark.createDataFrame([(1, f"{prose(42, 12)} {first}")], "item_id bigint, text string")
    texts = [(1, f"{prose(42, 12)} {second} x"), (2, f"{prose(42, 12)} {first} x")]
    found = contamination(spark.createDataFrame(texts, "doc_id bigint, text string"), items).collect()
    assert {r.doc_id: r.n_hit for r in found} == {1: 0, 2: 13}


def test_whole_runs_stay_inside_texts():
    bounds = np.array([0, 0, 3, 3, 8, 8])
    assert kernels.whole_runs(bounds, 3).tolist() == [True, False, False, True, True, True]


def test_winnowing_keeps_one_gram_of_every_window():
    hashes = np.random.default_rng(0).integers(0, 50, 400).astype(np.uint64)
    places, _ = winnow(hashes, np.array([0, 150, 400]), 13, 5)
    for start in [*range(138), *range(150, 388)]:
        assert any(start <= p <= start + 8 for p in places)


ITEMS = [
    (1, SHARED),
    (2, " ".join(SHARED.split()[20:40])),
    (3, "One two THREE"),
    (4, None),
    (5, "la la la"),
    (None, prose(6, 20)),
    (7, "..."),
]


def test_contamination(spark, docs, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    windows = defaultdict(set)
    for item, text in ITEMS:
        own = words(text)
        size = min(13, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows[tuple(own[i : i + size])] |= {str(item)} if item else set()
    sizes = {len(w) for w in windows}
    expected = []
    for doc, text in TEXTS:
        own, hit, met = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    met |= windows[tuple(own[i : i + size])]
        expected.append((doc, len(own), len(hit), sorted(met)))
    found = contamination(docs, items).collect()
    assert ordered(tuple(r) for r in found) == ordered(expected)
    assert any(n for _, _, n, _ in expected)
    assert contamination(nothing, items).count() == 0
    clean = contamination(docs, items.limit(0)).collect()
    assert len(clean) == len(TEXTS) and not any(r.n_hit for r in clean)


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_repeated_passages(docs, nothing, block_bytes, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(substrings, "SEGMENT_BITS", 12)
    counts = Counter()
    for _, text in TEXTS:
        own = spaced(text)
        counts.update(tuple(own[i : i + 35]) for i in range(len(own) - 34))
    expected = []
    for doc, text in TEXTS:
        own, gone = spaced(text), set()
        for i in range(len(own) - 34):
            if counts[tuple(own[i : i + 35])] > 1:
                gone |= set(range(i, i + 35))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        expected.append((doc, len(own), len(gone), kept))
    found = substrings.without_repeats(docs)
    assert found.filter("block <> 'x2' OR label <> 'x9'").count() == 0
    assert ordered(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept").collect()) == ordered(expected)
    untouched = substrings.without_repeats(docs, respace=False).filter("n_removed = 0 AND doc_id = 15")
    assert untouched.first().kept == dict(TEXTS)[15]
    assert substrings.without_repeats(nothing).count() == 0
    assert not [t for t in docs.sparkSession.catalog.listTables() if t.name.startswith("substring")]


def plain_fingerprint(text):
    own = spaced(text)
    shingles = [" ".join(own[i : i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    ones = [0] * 64
    for s in shingles:
        for b in range(64):
            ones[b] += xxhash.xxh64_intdigest(s.encode(), seed=42) >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


@pytest.mark.parametrize("group", [4, simhash.GROUP])
def test_near_duplicates(spark, docs, nothing, group):
    prints = [plain_fingerprint(t) for _, t in TEXTS]
    component = list(range(len(TEXTS)))
    for _ in TEXTS:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    component[j] = component[i] = min(component[i], component[j])
    least = {
        c: min((TEXTS[i][0] for i, d in enumerate(component) if d == c and TEXTS[i][0] is not None), default=None)
        for c in component
    }
    expected = [(doc, f"{p:016x}", least[c]) for (doc, _), p, c in zip(TEXTS, prints, component)]
    found = simhash.near_duplicates(docs, group=group).drop("component").collect()
    assert ordered(tuple(r) for r in found) == ordered(expected)
    assert simhash.near_duplicates(nothing).count() == 0


def test_near_duplicates_ignore_case(spark, tmp_path):
    """As registered: A-Z count as a-z, other letters as they are."""
    texts = [(1, prose(8, 60)), (2, prose(8, 60).upper()), (3, "Größe Ä One"), (4, "grÖße ä one"), (5, "größe Ä oNE")]
    made = spark.createDataFrame(texts, "doc_id bigint, text string")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op8_simhash(spark, str(tmp_path)).collect()}
    folded = {i: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for i, t in texts}
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{plain_fingerprint(t):016x}" for i, t in folded.items()}
    assert [found[i].component_id for i in range(1, 6)] == [1, 1, 3, 4, 3]
    kept = corpus_pipeline.simhash_dedup(spark, made, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4]


@pytest.mark.parametrize("group", [8, simhash.GROUP])
def test_links_of_a_dense_cluster_and_a_chain(spark, group):
    """Near copies around one fingerprint, and a chain in steps of four bits."""
    draw = np.random.default_rng(3)
    base = int(draw.integers(1 << 62))
    values = {base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    chain = int(draw.integers(1 << 62))
    for step in range(12):
        values.add(chain)
        chain ^= 0xF << (4 * step)
    values = np.array(sorted(values), dtype=np.uint64)
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "_print bigint")
    stars = {r.node: r.root for r in roots(simhash.near_links(prints, group=group)).collect()}
    assert len(values) - len(stars) == 2
    assert all((int(v) in stars) != (int(v) in stars.values()) for v in values.view(np.int64))


def test_probe_plan_covers_every_distance():
    both = np.full((64, 64), 2.5e5)
    np.fill_diagonal(both, 5e5)
    for count in (10, 10**6, 10**9, 10**11):
        plan = simhash.plan_probes(count, both * count / 1e6, 4)
        assert sum(radius + 1 for _, radius in plan) == 5
        bits = [b for group, _ in plan for b in group]
        assert len(set(bits)) == len(bits)


def test_packing(docs, nothing):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = pack_texts(docs, "doc_id", WORD_BPE, end_id=2, max_tokens=64).collect()
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = 0
        for r in own:
            assert r.offset == total and r.length == len(r.ids) // 4
            total += r.length
        assert total <= 64 and total & (total - 1) == 0
    expected = defaultdict(list)
    for doc, text in TEXTS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected[doc, len(ids)].append(packed(f"<{len(ids)}I", *ids))
    assert expected.keys() == pieces.keys()
    for key, whole in expected.items():  # repeated rows: all their ids, each once
        assert len(b"".join(x for _, x in pieces[key])) == sum(map(len, whole))
        if len(whole) == 1:
            assert b"".join(x for _, x in sorted(pieces[key])) == whole[0]
    assert pack_texts(nothing, "doc_id", WORD_BPE, end_id=2).count() == 0


@settings(max_examples=50, deadline=None)
@given(
    st.lists(st.lists(st.booleans(), max_size=90), max_size=40),
    st.integers(1, 6),
    st.integers(3, 16),
)
def test_packer_keeps_all_limits(examples, segments, loss):
    packer = Packer(16, segments, loss, 0)
    for key, marks in enumerate(examples):
        sums = np.concatenate([[0], np.cumsum(np.array(marks, dtype=np.int64))]).astype(np.int64)
        packer.add(_Example(key, np.arange(len(marks), dtype="<u4"), sums))
    packer.finish()
    sequences, got = defaultdict(list), defaultdict(list)
    for key, ids, start, length, total, lost, sequence, offset in packer.pieces:
        assert sum(examples[key][start : start + length]) == lost and total == len(examples[key])
        sequences[sequence].append((offset, length, lost))
        got[key] += np.frombuffer(ids, "<u4").tolist()
    assert all(sorted(got[k]) == list(range(len(m))) for k, m in enumerate(examples))
    for own in sequences.values():
        total = sum(n for _, n, _ in own)
        assert len(own) <= segments and sum(x for *_, x in own) <= loss
        assert total <= 16 and total & (total - 1) == 0


ODD = [
    "", "   ", "a\tb  c \n\n d", "x<|endoftext|>  y", "naïve'll 's'S 12½ ²③ 77", "\x1c!\x1c é  z   q\x85r",
    "日本語 テキスト 🎉🎉 ​", "<|endoftext|>", "İstanbul Σας ΣΑΣ", "it's 'tis,, we'll. 7 a7b", "... . , ,. x,y",
    "Ünder, straße. ẞ ǅ J̌", "ͅ ͺx ᲀ", "Kİ. ALİ, wordक़, İ. क़. ŉ, ſ. ß, ﬁ.",
]


def test_words_encoded_alone_give_the_same_ids():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = [*ODD, *(t or "" for _, t in TEXTS)]
    for by_word in (True, False):
        found = [
            ids[a:b].tolist()
            for ids, ends in encode_texts(pa.array(texts), WORD_BPE, drops_spaces=by_word)
            for a, b in zip(ends[:-1], ends[1:])
        ]
        for text, ids in zip(texts, found, strict=True):
            assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=6).map(str.strip), max_size=6), st.sampled_from([".", ",", "", "..", "7"]))
def test_words_with_tails_give_the_same_ids(own, tail):
    text = " ".join(w + tail for w in own)
    ids = TOKENIZER.encode(text, add_special_tokens=False).ids
    found, bounds = next(encode_texts(pa.array([text]), WORD_BPE, drops_spaces=True))
    assert found.tolist() == ids and bounds.tolist() == [0, len(ids)], repr(text)


@pytest.mark.parametrize("head", [0, 5, 1 << 17])
def test_token_counts(spark, nothing, head):
    rows = [*TEXTS, *((100 + i, t) for i, t in enumerate(ODD))]
    made = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    expected = [
        (doc, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids))
        for doc, t in rows
    ]
    found = token_counts(made, BYTE_BPE, public_tokenizers.PATTERN, head=head)
    assert ordered(tuple(r) for r in found.collect()) == ordered(expected)
    assert token_counts(nothing, BYTE_BPE, public_tokenizers.PATTERN).count() == 0


NOTICES = [
    (1, "CC-BY-NC, cc by nc. Under the MIT License"),
    (1, "CC-BY-NC, cc by nc. Under the MIT License"),
    (2, "under the mit"),
    (3, "Licensed under the very Apache License, Version 2.0"),
    (4, "code under the mit license under the mit license " * 50),
    (5, "Redistribution and use in source and in binary forms, with or without modification, are permitted"),
    (6, "GNU General Public License, version 3"),
    (7, None),
    (8, "ßunder the mit license"),
]


def test_license_scan(spark, docs, nothing):
    rows = spark.createDataFrame(NOTICES, "doc_id bigint, text string")
    found = licenses.license_scan(rows.unionByName(docs.select("doc_id", "text"))).collect()
    expected = []
    for doc, text in [*NOTICES, *TEXTS]:
        own, places, labels = words(text), [], set()
        for name, phrase in licenses.BASE:
            size = len(phrase.split())
            at = [i for i in range(len(own) - size + 1) if own[i : i + size] == phrase.split()]
            places += at
            labels |= {name} if at else set()
        expected.append(
            (doc, len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        )
    base = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert ordered(tuple(r[c] for c in base) for r in found) == ordered(expected)
    labels = {r.doc_id: r.labels for r in found if r.n_words and r.doc_id in (2, 3, 5, 6)}
    assert labels[3] == "apache-2" and "bsd" in [r.labels for r in found if r.doc_id == 5]
    assert "gpl-3" in [r.labels for r in found if r.doc_id == 6]
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in found)
    assert licenses.license_scan(nothing).count() == 0


LIKE_NOTICES = [
    ("GNU Affero General Public License version 3", "agpl-3", 1.0),
    ("GNU Lesser General Public License version 3", "lgpl", 1.0),
    ("the GNU General Public License version 2 or 3", "gpl-2", 1.0),
    ("GNU General Public lesser License version 3", "", 0.0),
    ("version 3 of the public license, GNU General Public License", "", 0.0),
    ("Creative Commons Attribution NonCommercial ShareAlike", "cc-by-nc", 1.0),
    ("Licensed under a Creative Commons Attribution NoDerivs 4.0 International License", "", 0.0),
    ("is licensed under Creative Commons Attribution 4.0 International License", "cc-by", 0.9),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.0", "", 0.0),
    ("This source form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2", 16 / 17),
    ("and use in source and binary forms, with or without modification, are permitted", "bsd", 13 / 14),
    ("redistribution and use, in source and binary forms, without or with modification, are permitted", "", 0.0),
    ("This is free and really unencumbered software released into the public domain. " * 3, "unlicense", 10 / 11),
]


def test_columns_that_clash_are_left_alone(docs):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    found = licenses.license_scan(docs.withColumn("labels", F.lit(1)).withColumn("spans", F.lit(2)))
    assert found.columns == names and found.count() == len(TEXTS)
    counted = token_counts(docs.withColumn("n_tokens", F.lit(1)), BYTE_BPE, public_tokenizers.PATTERN)
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens"] and counted.count() == len(TEXTS)


def test_license_templates_are_verified_in_order(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(LIKE_NOTICES)], "doc_id bigint, text string")
    found = {r.doc_id: (r.labels, round(r.score, 9)) for r in licenses.license_scan(rows).collect()}
    assert found == {i: (labels, round(score, 9)) for i, (_, labels, score) in enumerate(LIKE_NOTICES)}


def test_license_scan_stays_in_the_engine(spark):
    texts = spark.range(3).selectExpr("id AS doc_id", "'under the mit license' AS text")
    plan = licenses.license_scan(texts)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_crc_of_ids_is_the_usual_one(docs):
    rows = pack_texts(docs, "doc_id", WORD_BPE, end_id=2).withColumn("crc", F.crc32("ids")).collect()
    assert all(r.crc == zlib.crc32(bytes(r.ids)) for r in rows)
