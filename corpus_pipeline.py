"""From raw documents to packed training sequences, stage by stage.

Every stage reads all rows its predecessor kept, from Parquet. A stage that drops rows
finds their keys and joins them away; a row's key is its id and a digest of its text, so
null and repeated ids are told apart by their texts.

Edge cases: documents without letters go at language identification; of documents without
words one stays; rows alike in id and text stay once; a document whose passages all repeat
stays with an empty text; empty tables give empty results; columns beyond those of
documents are carried on up to packing.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from slotledger.llm.decontaminate import contamination, is_contaminated  # noqa: E402
from slotledger.llm.language import fit, identify  # noqa: E402
from slotledger.llm.packing import pack_texts  # noqa: E402
from slotledger.llm.simhash import near_duplicates  # noqa: E402
from slotledger.llm.substrings import without_repeats  # noqa: E402
from slotledger.llm.support import bounded, table  # noqa: E402
from slotledger.session import cut, scratch_path  # noqa: E402

_KEY, _KEYS = "_pipeline_key", 1_000_000  # keys up to this number are broadcast


def _key(id_: str = "doc_id", digest: Column | None = None) -> Column:
    digest = F.xxhash64("text") if digest is None else digest
    return F.concat_ws(":", F.coalesce(F.col(id_).cast("string"), F.lit("")), digest.cast("string"))


def _split(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` without, and with, one of ``keys``."""
    listed = bounded(cut(keys.select(_KEY).distinct(), "keys"), _KEYS)
    keyed = docs.withColumn(_KEY, _key())
    return tuple(
        keyed.join(listed, _KEY, how).select(*docs.columns) for how in ("left_anti", "left_semi")
    )


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages, by their text and their source."""
    languages, model = fit(docs, "doc_id", "text", "lang")
    rows = docs.select(
        _key().alias("id"), "text", F.lit(None).cast("string").alias("declared"), F.col("source").alias("host")
    )
    judged = identify(rows, languages, model)
    # A text under one id from two sources goes only if it is rejected under both.
    rejected = judged.groupBy(F.col("id").alias(_KEY)).agg(F.max("accepted").alias("any")).filter("NOT any")
    return _split(docs, rejected)[0]


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies."""
    identity = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest")
    )
    found = near_duplicates(docs.select(identity.alias("identity"), "text"), id_col="identity", fold=True)
    key = _key("identity.id", F.col("identity.digest")).alias(_KEY)
    found = cut(
        found.select(key, (F.col("identity") == F.col("component_id")).alias("first")), "near-copies"
    )
    kept, _ = _split(docs, found.filter("NOT first"))
    repeated = found.filter("first").groupBy(_KEY).count().filter("count > 1")
    single, copies = _split(kept, repeated)
    once = copies.withColumn(_KEY, _key()).dropDuplicates([_KEY]).select(*docs.columns)
    return single.unionByName(once)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat anywhere; others stay as they are."""
    row = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    cleaned = without_repeats(docs.select(row, "text"), respace=False)
    changed = F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("kept"), "n_chars": changed}
    return cleaned.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    rows = docs.select(_key().alias(_KEY), "text")
    found = contamination(rows, table(spark, sf_dir, "benchmark"), id_col=_KEY)
    return _split(docs, found.filter(is_contaminated()))[0]


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 4096."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_texts(docs, "doc_id", path, end_id=2, keep_words=False).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The text model and the 64-bit hashes of the first two stages are not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
