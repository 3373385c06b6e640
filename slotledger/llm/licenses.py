"""License scan by diagonal voting, in built-in column expressions only.

All runs of ``GRAM`` words of every text are hashed and joined to the places of the
same runs in the license templates (a fixed list in this module, hence the broadcast).
A match votes for the diagonal ``place in text - place in template``: a full copy puts
all its votes on one. Votes are a bit set per (text, template, diagonal), so copies of a
row cannot vote twice. Every diagonal with a vote is verified in order: the template's
words against the text's from the diagonal on, by edit distance over words, so a word
missing, changed or put in counts one each. Words that name the license must stand in a
row. Verified diagonals near each other are merged into a span.

A base phrase is a template that counts only where all its words stand in a row, on one
diagonal; every such place counts.

Edge cases: null and wordless texts have no words, labels '' and score 0; repeated rows
give repeated result rows; long texts go through whole; a text under a few ids is scanned
for each; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotledger.llm.support import repeat_rows, text_or_empty

GRAM = 3
SLACK = 3  # diagonals up to this far apart belong to one span
MISSING = 10  # one of so many words of a template may be missing, changed or put in

# Base phrases and their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# Opening words of common licenses and usual notices.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software"),
    ("mit", "licensed under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-2", "gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

# Of templates long enough to differ in a word: the words that name the license.
NAMES = {
    "mpl-2": "mozilla public license v 2 0",
    "cc-by": "creative commons attribution 4 0 international license",
}

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(folded, _SEPARATORS), "")


def _gram_hash(own: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(own, at + i) for i in range(GRAM)])


def _places(own: Column) -> Column:
    """Where runs of ``GRAM`` words start."""
    return F.when(
        F.size(own) >= GRAM, F.sequence(F.lit(0), F.size(own) - GRAM)
    ).otherwise(F.array().cast("array<int>"))


def _coded(own: Column, phrase: Column) -> Column:
    """Words as characters: the place of each in ``phrase``, one character for all others."""
    return F.array_join(F.transform(own, lambda w: F.char(F.array_position(phrase, w) + 48)), "")


def _errors(around: Column, phrase: Column, allowed: Column) -> Column:
    """Least edit distance over words between ``phrase`` and a run of words ``around`` it.

    Runs start and end up to ``allowed`` words off the diagonal, so any alignment with no
    more errors than that is among them.
    """
    text, own, size = _coded(around, phrase), _coded(phrase, phrase), F.size(phrase)
    runs = F.transform(
        F.sequence(F.lit(0), 2 * allowed),
        lambda start: F.array_min(
            F.transform(
                F.sequence(-allowed, allowed),
                lambda more: F.levenshtein(F.substring(text, start + 1, size + more), own),
            )
        ),
    )
    return F.array_min(runs)


def _templates(docs: DataFrame) -> DataFrame:
    """One row per run of words of every template, and a last one that each text meets once."""
    listed = [(label, phrase, True) for label, phrase in BASE]
    listed += [(label, phrase, False) for label, phrase in TEMPLATES]
    assert all(GRAM <= len(p.split()) < 64 + GRAM for _, p, _ in listed), "votes are held in 64 bits"
    rows = [
        F.struct(*[F.lit(x).alias(n) for n, x in zip(("template", "label", "phrase", "is_base"), (i, *row))])
        for i, row in enumerate(listed)
    ]
    one = docs.sparkSession.range(1)
    runs = (
        one.select(F.inline(F.array(*rows)))
        .withColumn("phrase", F.split("phrase", " "))
        .select("*", F.explode(_places(F.col("phrase"))).alias("at"))
        .withColumn("gram", F.slice("phrase", F.col("at") + 1, GRAM))
        .withColumn("hash", _gram_hash(F.col("phrase"), F.col("at")))
    )
    whole = one.select(F.lit(-1).alias("template"), F.lit(0).cast("bigint").alias("hash"))
    return runs.unionByName(whole, allowMissingColumns=True)


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``id_col``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` and ``spans`` (label, start, share)."""
    texts = (
        docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
        .select("_id", F.xxhash64("_text").alias("_digest"), words(F.col("_text")).alias("_words"))
        .withColumn("n_words", F.size("_words").cast("bigint"))
    )
    hashes = F.transform(_places(F.col("_words")), lambda at: _gram_hash(F.col("_words"), at))
    # "outer", since for a plain explode the optimizer adds a filter that would split the
    # text anew for every word; the array is never empty.
    grams = texts.withColumn("_hashes", F.concat(hashes, F.array(F.lit(0).cast("bigint")))).select(
        "_id", "_digest", "_words", "n_words", F.posexplode_outer("_hashes").alias("place", "hash")
    )
    end = F.col("place") == F.greatest(F.col("n_words") - GRAM + 1, F.lit(0))
    same = F.slice("_words", F.col("place") + 1, GRAM) == F.col("gram")
    met = grams.join(F.broadcast(_templates(docs)), "hash").filter(
        F.when(F.col("template") < 0, end).otherwise(same)
    )
    text_keys = ["_id", "_digest", "n_words"]
    diagonal = F.col("place") - F.col("at")
    allowed = F.floor(F.size("phrase") / MISSING).cast("int")
    start = F.greatest(diagonal - allowed, F.lit(0))
    around = F.slice("_words", start + 1, F.size("phrase") + 2 * allowed)
    votes = met.groupBy(*text_keys, "template", diagonal.alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, at)")).alias("votes"),
        F.count("*").alias("copies"),
        *[F.first(c).alias(c) for c in ("label", "is_base", "phrase")],
        F.max(around).alias("around"),
    )
    whole = F.bit_count("votes") == F.size("phrase") - GRAM + 1
    errors = F.when(whole, 0).when(~F.col("is_base"), _errors(F.col("around"), F.col("phrase"), allowed))
    named = F.lit(True)
    for label, name in NAMES.items():
        name = F.split(F.lit(name), " ")
        inside = F.size(F.array_except(name, "phrase")) == 0
        holds = F.contains(_coded(F.col("around"), F.col("phrase")), _coded(name, F.col("phrase")))
        named &= ~((F.col("label") == label) & inside) | holds
    # Only the last row of a text, base phrases that are whole and verified diagonals go on.
    kept = (F.col("template") < 0) | whole | ((F.col("errors") <= allowed) & named)
    ordered = Window.partitionBy(*text_keys, "template").orderBy("diagonal")
    spans = votes.withColumn("errors", errors).filter(kept).withColumn(
        "_new",
        F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > SLACK, F.lit(True)).cast("int"),
    ).withColumn("span", F.sum("_new").over(ordered))
    merged = spans.groupBy(*text_keys, "template", "span").agg(
        F.sum(F.when(F.col("template") < 0, F.col("copies"))).alias("copies"),
        *[F.first(c).alias(c) for c in ("label", "is_base", "phrase")],
        F.max(whole.cast("int")).alias("whole"),
        F.sum(F.when(whole & F.col("is_base"), 1).otherwise(0)).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
        F.greatest(F.min("diagonal"), F.lit(0)).alias("start"),
        F.min("errors").alias("errors"),
    )
    counted = F.col("is_base") & (F.col("whole") == 1)
    verified = ~F.col("is_base")
    found = merged.withColumn("share", 1 - F.col("errors") / F.size("phrase"))

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    base = F.col("is_base")
    result = found.groupBy(*text_keys).agg(
        F.max("copies").alias("copies"),
        F.coalesce(F.sum("n_base"), F.lit(0)).cast("bigint").alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("last_word"))).cast("bigint").alias("last_word"),
        joined(counted).alias("base_labels"),
        joined(counted | verified).alias("labels"),
        F.coalesce(F.max(F.when(counted | verified, F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(
            F.collect_set(F.when(counted | verified, F.struct("label", "start", "share")))
        ).alias("spans"),
    )
    listed = result.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        "base_labels", "labels", "score", "spans", "copies",
    )
    return repeat_rows(listed, "copies")
