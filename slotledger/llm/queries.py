"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from slotledger.llm import sql
from slotledger.llm.decontaminate import contamination, is_contaminated
from slotledger.llm.html_text import extract_text
from slotledger.llm.language import declared_language, fit, identify
from slotledger.llm.licenses import license_scan
from slotledger.llm.nearest import nearest
from slotledger.llm.packing import pack_texts
from slotledger.llm.periods import periodic_runs, with_planted_periods
from slotledger.llm.personal import KINDS, count_of, personal_data, span_list
from slotledger.llm.simhash import near_duplicates
from slotledger.llm.spelling import letter_runs, spelling_variants, vocabulary, with_lost_letters
from slotledger.llm.substrings import without_repeats
from slotledger.llm.support import table
from slotledger.llm.token_counts import token_counts
from slotledger.llm.url_rules import judge_urls, with_host_and_path

# The rules of the query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents laid into sequences of 4096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = pack_texts(table(spark, sf_dir, "documents"), "doc_id", path, end_id=2)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document and of every page.

    Pages bring main text, markup language and address; documents bring text and, as
    host, their source: their ``lang`` column is the label the text model is fitted on.
    """
    documents = table(spark, sf_dir, "documents")
    languages, model = fit(documents, "doc_id", "text", "lang")
    pages = table(spark, sf_dir, "pages")
    page_rows = with_host_and_path(extract_text(pages, declared=declared_language("html")), "url")
    rows = documents.select(
        F.struct(F.col("doc_id"), F.lit(None).cast("bigint").alias("page_id")).alias("id"),
        "text", F.lit(None).cast("string").alias("declared"), F.col("source").alias("host"),
    ).unionByName(
        page_rows.select(
            F.struct(F.lit(None).cast("bigint").alias("doc_id"), "page_id").alias("id"),
            "text", "declared", F.nullif("host", F.lit("")).alias("host"),
        )
    )
    return identify(rows, languages, model).select(
        "id.doc_id", "id.page_id", "lang", "score", "text_lang", "accepted"
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed 512."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    counts = token_counts(table(spark, sf_dir, "documents"), path, pattern)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in 4 bits at most."""
    found = near_duplicates(table(spark, sf_dir, "documents"), fold=True)
    return found.select("doc_id", "fingerprint", "component_id")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every vector whose id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated windows of 35 words taken out of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of the words of all documents, some with a letter lost."""
    runs = letter_runs(table(spark, sf_dir, "documents"), min_length=7)
    return spelling_variants(vocabulary(with_lost_letters(runs, every=31)))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, one in ten with a planted period."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (
        periodic_runs(with_planted_periods(docs))
        .withColumn("longest", longest)
        .select(
            "doc_id",
            F.size("runs").cast("bigint").alias("n_runs"),
            (-F.col("longest.start")).alias("start"),
            F.col("longest.length").alias("length"),
            (-F.col("longest.period")).alias("period"),
            F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
            F.sha2("kept", 256).alias("collapsed_sha256"),
        )
    )


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: strict patterns, and what their contexts reveal."""
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[count_of("strict", kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)],
        F.sha2(span_list("strict"), 256).alias("base_sha256"),
        span_list("spans").alias("spans"),
    )


QUERIES = {
    "op1_packing": op1_packing,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_html_text": op4_html_text,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_url_rules": op7_url_rules,
    "op8_simhash": op8_simhash,
    "op9_nearest": op9_nearest,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_personal_data": op13_personal_data,
}

ORACLES = {
    "op5_decontamination": sql.DECONTAMINATION,
    "op7_url_rules": sql.URL_RULES,
    "op10_substring_dedup": sql.SUBSTRINGS,
}
