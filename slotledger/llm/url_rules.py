"""URL rules by a sort-merge range join.

A rule (host, path) fits a URL if the URL's host is the rule's or lies below it and the
URL's path starts with the rule's. With the host's labels reversed, rule and URL become
keys ``com.example.www<sep>/path``; a URL probes once for each host it lies below, a few
keys. A rule covers the interval of keys it is a prefix of, and two such intervals are
nested or apart.

Rules and probes are range-partitioned and sorted together, with the page's id as last
sort key, so that one URL that fills a third of the table is still cut into parts. Each
task sweeps its part with a stack of the open rules. Rules that opened in an earlier
part are those that are prefixes of the part's first key: a join of one row per part
and prefix with the rules. They settle probes that no rule of their own part covers.

The longest fitting rule (host and path together, then host) wins. Rules that are given
twice count once, 'block' before 'allow'.

Edge cases: a null URL or one without ``://`` has empty host and path and fits no rule;
repeated rows give repeated result rows; an id with several URLs is judged for each; very
long URLs are keys like others; empty tables give empty results or the default verdict;
extra columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.support import bounded, repeat_rows
from slotledger.session import cut

_SEPARATOR = "\x01"  # below all characters of hosts and paths; every match is verified
_RULES = 100_000  # broadcast bound of rules, and of rules that reach into later parts


def with_host_and_path(df: DataFrame, url: str) -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return df.withColumns(
        {
            "host": F.coalesce(
                F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")
            ),
            "path": F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    )


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in key order, rules before probes; gives each probe its innermost open rule."""
    stack: list[tuple[str, int]] = []
    for batch in batches:
        found = []
        for key, rule in zip(batch.column("key").to_pylist(), batch.column("rule").to_pylist()):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule))
            found.append(stack[-1][1] if stack else None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "found"]
        )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Per row of ``pages``: ``id_col``, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``; ``rule`` is host and path of the
    winner, null where none fits.
    """
    listed = cut(
        rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select(
            F.monotonically_increasing_id().alias("rule"), "host", "path", "verdict",
            F.concat(F.array_join(_labels(F.col("host")), "."), F.lit(_SEPARATOR), "path").alias("key"),
        ),
        "url-rules",
    )
    urls = with_host_and_path(
        pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url"
    ).select("_id", "host", "path")
    depth = F.size(F.split("host", r"\.", -1))
    probes = urls.select("*", F.explode(F.sequence(F.lit(1), depth)).alias("_labels")).select(
        F.concat(
            F.array_join(F.slice(_labels(F.col("host")), 1, F.col("_labels")), "."),
            F.lit(_SEPARATOR), "path",
        ).alias("key"),
        F.lit(None).cast("bigint").alias("rule"),
        "_id", "host", "path",
        (F.col("_labels") == depth).cast("int").alias("whole"),
    )
    rows = listed.select("key", "rule").unionByName(probes, allowMissingColumns=True)
    kind = pages.schema[id_col].dataType.simpleString()
    swept = (
        rows.repartitionByRange("key", "_id", "host", "path")
        .sortWithinPartitions("key", F.col("rule").asc_nulls_last(), "_id")
        .withColumn("part", F.spark_partition_id())
    )
    schema = f"key string, rule bigint, _id {kind}, host string, path string, whole int, part int, found bigint"
    met = cut(swept.mapInArrow(_sweep, schema), "swept-urls")

    first = met.groupBy("part").agg(F.min("key").alias("first"))
    longest = listed.agg(F.max(F.length("key"))).first()[0] or 1
    lengths = F.sequence(F.lit(1), F.least(F.length("first"), F.lit(longest)))
    prefixes = first.select(
        "part", F.explode(F.transform(lengths, lambda n: F.left("first", n))).alias("key")
    )
    carried = prefixes.join(listed.select("key", "rule"), "key").select(
        "part", F.col("key").alias("_prefix"), F.col("rule").alias("_carried")
    )
    probes = met.filter("rule IS NULL")
    settled = probes.filter("found IS NOT NULL")
    open_ = probes.filter("found IS NULL").drop("found")
    later = open_.join(bounded(carried, _RULES), "part").filter(
        F.startswith("key", "_prefix")
    ).select("_id", "host", "path", F.col("_carried").alias("found"))
    candidates = settled.select("_id", "host", "path", "found").unionByName(later)
    copies = probes.groupBy("_id", "host", "path").agg(F.sum("whole").alias("copies"))
    named = listed.select(
        F.col("rule").alias("found"), F.col("host").alias("_host"), F.col("path").alias("_path"), "verdict"
    )
    fits = candidates.join(bounded(named, _RULES), "found").filter(
        ((F.col("host") == F.col("_host")) | F.endswith("host", F.concat(F.lit("."), "_host")))
        & F.startswith("path", "_path")
    )
    winner = F.max(
        F.struct(
            (F.length("_host") + F.length("_path")).alias("length"),
            F.length("_host").alias("host_length"),
            F.concat("_host", "_path").alias("rule"),
            "verdict",
        )
    )
    best = fits.groupBy("_id", "host", "path").agg(winner.alias("best"))
    same = (
        copies["_id"].eqNullSafe(best["_id"])
        & (copies["host"] == best["host"]) & (copies["path"] == best["path"])
    )
    result = copies.join(best, same, "left").select(
        copies["_id"].alias(id_col), copies["host"], copies["path"],
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        "copies",
    )
    return repeat_rows(result, "copies")
