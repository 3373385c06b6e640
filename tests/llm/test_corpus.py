"""The pipeline stage by stage, and the registered queries."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from slotledger.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import prose

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, sf):
    """The documents, with planted cases and an extra column."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    passage = prose(11, 55, 5000)
    english = documents.filter("lang = 'en' AND n_chars BETWEEN 1000 AND 2000").orderBy("doc_id").limit(6).collect()
    planted = [
        (9001, None, "en", "s", None),
        (9002, "", "en", None, 0),
        (9003, "12 34 !!", None, "s", 8),
        (9004, english[0].text + " The and of the", "en", "s", 1),  # near copy
        (9005, english[1].text, "en", "s", 1),  # exact copy
        (9006, f"{english[2].text[:300]} {passage} {english[3].text[:300]}", "en", "s", 1),
        (9007, f"{english[4].text[:300]} {passage} {english[5].text[:300]}", "en", "s", 1),
        (9008, f"{item} The and of that", "en", "s", 1),
        (None, "The and of that in the other then", "en", "s", 1),
    ]
    rows = spark.createDataFrame(planted, COLUMNS)
    return documents.unionByName(rows).withColumn("n_removed", F.lit("extra")), passage, english


def test_stages(spark, sf, corpus):
    docs, passage, english = corpus
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.cut(stage(spark, docs, sf), name)
        if name != "packing":
            assert docs.columns == before.columns
            assert docs.filter("n_removed <> 'extra'").count() == 0
            kept[name] = {r.doc_id: r for r in docs.collect()}
    first, second, third, fourth = kept.values()
    assert not {9001, 9002, 9003} & first.keys() and {9004, 9005, 9006, 9007, 9008, None} <= first.keys()
    assert not {9004, 9005} & second.keys() and {english[0].doc_id, english[1].doc_id} <= second.keys()
    assert second.keys() == third.keys()
    for doc in (9006, 9007):
        assert passage not in third[doc].text and passage in " ".join(second[doc].text.split())
        assert third[doc].n_chars == len(third[doc].text)
    assert 9008 not in fourth and 9006 in fourth
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in fourth.values())
    assert docs.agg(F.sum("length")).first()[0] == tokens


def test_repeated_rows_stay_once(spark, sf):
    rows = [(1, "la la li lo", "en", "s", 1)] * 3 + [(None, "other words here", "en", "s", 1)] * 2
    docs = spark.createDataFrame(rows, COLUMNS)
    found = corpus_pipeline.simhash_dedup(spark, docs, sf)
    assert sorted(found.collect(), key=repr) == sorted({tuple(r) for r in rows}, key=repr)


def test_empty_documents(spark, sf, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_names():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLES) <= set(QUERIES)
