"""Language identification by Bayesian evidence fusion.

Per row the log posterior of each language is the sum of

* the text: likelihood of its byte trigrams under each language's model, fitted on a
  bounded sample of each label's rows (``LABEL_ROWS``) and tempered, since neighbouring
  trigrams are not independent; every label with a letter in its sample is a language;
* the declared markup language: its likelihood given the language, from counts over all
  rows;
* the address: a prior for its host, smoothed towards its domain, that towards its
  suffix, that towards all rows. The counts behind it are sums of the text's posteriors
  over all rows, grouped by host, and a row's own share is taken out of its host's.

A further class ``und``, all trigrams alike, stands for text in none of the languages.
Hosts and declared languages are grouped before they are joined back, whatever their
share of the rows.

Edge cases: a null or letterless text has no text evidence, and is not accepted; missing
declared language or address: that evidence is left out; repeated rows are judged each;
long texts go through whole, piece by piece; extra columns are not read; without any
label everything is ``und``; of languages that score the same the first by name is taken;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.support import bounded
from slotledger.llm.words import SLICE_BYTES, text_buffer
from slotledger.session import cut

LABEL_ROWS = 5_000  # expected size of each label's training sample; all rows of a rarer one
TEMPER = 0.25  # weight of a trigram's log likelihood
PULL = 20.0  # rows' worth of a parent's say in a host's, domain's or suffix's prior
ACCEPT = 0.5  # posterior of all languages together from which a row is accepted
_UNKNOWN = "und"
_UNKNOWN_PRIOR = 0.02
_BUCKETS = 1 << 14
_HOSTS = 1_000_000  # broadcast bound of the tables of hosts and declared languages


def _letters() -> np.ndarray:
    """Bytes of letters in lower case, 0x20 for all else."""
    table = np.full(256, 0x20, dtype=np.int32)
    for first, last in ((ord("a"), ord("z")), (0x80, 0xFF)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


_LETTERS = _letters()


def _trigrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of a column of texts: the rows they touch, where each row's trigrams begin
    and end in the piece, and the trigrams' buckets (0 where the middle is no letter)."""
    data, offsets = text_buffer(texts)
    for at in range(int(offsets[0]), int(offsets[-1]), SLICE_BYTES):
        end = min(at + SLICE_BYTES, int(offsets[-1]))
        letters = _LETTERS[data[at : min(end + 2, int(offsets[-1]))]]
        codes = (letters[:-2] * 0x9E5 + letters[1:-1] * 0x2C1B + letters[2:] * 0x1F123D) % (_BUCKETS - 1) + 1
        codes[letters[1:-1] == 0x20] = 0
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        last = int(np.searchsorted(offsets, end, side="left"))
        begins = np.clip(offsets[first:last] - at, 0, len(codes))
        ends = np.clip(offsets[first + 1 : last + 1] - 2 - at, 0, len(codes))
        yield np.arange(first, last), begins, np.maximum(begins, ends), codes


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of each label in a task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = batch.column("label").to_pylist()
        for rows, begins, ends, codes in _trigrams(batch.column("text")):
            for row, a, b in zip(rows, begins, ends):
                own = counts.setdefault(labels[row], np.zeros(_BUCKETS, np.int64))
                own += np.bincount(codes[a:b], minlength=_BUCKETS)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(counts), pa.string()),
            pa.array([c.tolist() for c in counts.values()], pa.list_(pa.int64())),
        ],
        names=["label", "counts"],
    )


def _padded(text: str) -> Column:
    """A text's first and last letters stand beside a space, like those of its words."""
    return F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))


def fit(
    labelled: DataFrame, id_col: str, text_col: str, label_col: str, label_rows: int = LABEL_ROWS
) -> tuple[list[str], np.ndarray]:
    """Languages, ``und`` last, and the log likelihood of each trigram in each.

    Rows are drawn by a hash of their id and text, about ``label_rows`` of each label and
    at least the one with the least hash.
    """
    rows = (
        labelled.filter(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
        .select(
            F.xxhash64(id_col, text_col).alias("hash"),
            _padded(text_col).alias("text"),
            F.col(label_col).alias("label"),
        )
    )
    totals = rows.groupBy("label").agg(F.count("*").alias("rows"), F.min("hash").alias("least"))
    # 64-bit hashes up to the label's own share of their range
    share = F.lit(float(label_rows)) / F.col("rows")
    scaled = (share * 2.0**64 - 2.0**63).cast("bigint")
    limits = totals.select(
        "label",
        F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise(F.greatest(scaled, "least")).alias("limit"),
    )
    drawn = rows.join(F.broadcast(cut(limits, "label-limits")), "label").filter("hash <= limit")
    summed = (
        drawn.select("text", "label").mapInArrow(_count_trigrams, "label string, counts array<bigint>")
        .select("label", F.posexplode("counts").alias("i", "n")).filter("n > 0 AND i > 0")
        .groupBy("label", "i").agg(F.sum("n").alias("n"))
    )
    found = summed.toArrow()  # labels * buckets at most
    codes = found["label"].combine_chunks().dictionary_encode()
    names = sorted(codes.dictionary.to_pylist())
    counts = np.zeros((len(names) + 1, _BUCKETS))
    place = {name: i for i, name in enumerate(names)}
    own = np.array([place[x] for x in codes.dictionary.to_pylist()], dtype=np.int64)
    counts[own[codes.indices.to_numpy()], found["i"].to_numpy()] = found["n"].to_numpy()
    counts[:, 0] = 0
    smoothed = counts + 0.5
    table = np.log(smoothed / smoothed.sum(axis=1, keepdims=True))
    table[:, 0] = 0.0  # no evidence
    return [*names, _UNKNOWN], table


def _likelihoods(table: np.ndarray, temper: float):
    """Per row the tempered log likelihoods, and the posterior under even priors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, len(table)))
            grams = np.zeros(batch.num_rows, dtype=np.int64)
            for rows, begins, ends, codes in _trigrams(batch.column("text")):
                sums = np.zeros(len(codes) + 1)
                for i, own in enumerate([*table, (np.arange(_BUCKETS) > 0).astype(float)]):
                    np.cumsum(own[codes], out=sums[1:])
                    if i < len(table):
                        found[rows, i] += sums[ends] - sums[begins]
                    else:
                        grams[rows] += np.rint(sums[ends] - sums[begins]).astype(np.int64)
            found *= temper
            soft = np.exp(found - found.max(axis=1, keepdims=True))
            soft /= soft.sum(axis=1, keepdims=True)
            names = ["id", "declared", "host"]
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(grams),
                    pa.array(found.tolist(), kind),
                    pa.array(soft.tolist(), kind),
                ],
                names=[*names, "grams", "likelihood", "soft"],
            )

    return run


def _sums(df: DataFrame, by: list[str], column: str, count: int) -> DataFrame:
    """Element-wise sums of an array column; they combine before the shuffle."""
    parts = [F.sum(F.col(column)[i]).alias(f"_s{i}") for i in range(count)]
    summed = df.groupBy(*by).agg(*parts) if by else df.agg(*parts)
    return summed.select(*by, F.array(*[F.coalesce(f"_s{i}", F.lit(0.0)) for i in range(count)]).alias(column))


def _pulled(own: Column, parent: Column, pull: float) -> Column:
    """Shares of ``own`` counts, smoothed towards the ``parent`` shares."""
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(own, parent, lambda n, p: (n + pull * p) / (total + pull))


def host_priors(scored: DataFrame, count: int, pull: float) -> DataFrame:
    """Per ``host``: its counts and its parent's prior. Parents: domain, suffix, all rows."""
    labels = F.split("host", r"\.", -1)
    hosts = _sums(scored.filter("host IS NOT NULL"), ["host"], "soft", count).withColumns(
        {
            "domain": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."),
            "suffix": F.element_at(labels, -1),
        }
    )
    hosts = cut(hosts, "hosts")
    everywhere = _sums(scored, [], "soft", count).select(
        _pulled(F.col("soft"), F.array_repeat(F.lit(1.0 / count), count), pull).alias("overall")
    )
    suffixes = _sums(hosts, ["suffix"], "soft", count).join(F.broadcast(everywhere)).select(
        "suffix", _pulled(F.col("soft"), F.col("overall"), pull).alias("suffix_prior")
    )
    domains = _sums(hosts, ["domain", "suffix"], "soft", count).join(suffixes, "suffix").select(
        "domain", _pulled(F.col("soft"), F.col("suffix_prior"), pull).alias("parent")
    )
    return hosts.join(domains, "domain").select("host", F.col("soft").alias("host_soft"), "parent")


def identify(
    rows: DataFrame,
    languages: list[str],
    table: np.ndarray,
    temper: float = TEMPER,
    pull: float = PULL,
    accept: float = ACCEPT,
) -> DataFrame:
    """Per row of ``rows`` (``id``, ``text``, ``declared``, ``host``): ``id``, ``lang``,
    ``score`` (its posterior), ``text_lang`` (by the text alone) and ``accepted`` (there are
    letters, and some language is likelier than none)."""
    count = len(languages)
    kind = rows.schema["id"].dataType.simpleString()
    scored = cut(
        rows.select("id", "declared", "host", _padded("text").alias("text")).mapInArrow(
            _likelihoods(table, temper),
            f"id {kind}, declared string, host string, grams bigint, likelihood array<double>, soft array<double>",
        ),
        "likelihoods",
    )
    hosts = cut(host_priors(scored, count, pull), "host-priors")
    said = _sums(scored.filter("declared IS NOT NULL"), ["declared"], "soft", count)
    said = cut(said, "declared")
    kinds = said.count()
    per_language = _sums(said, [], "soft", count).select(F.col("soft").alias("said"))
    declared = said.join(F.broadcast(per_language)).select(
        "declared",
        F.zip_with("soft", "said", lambda n, all_: F.log((n + 0.5) / (all_ + 0.5 * max(1, kinds)))).alias("evidence"),
    )
    plain = [np.log((1 - _UNKNOWN_PRIOR) / max(1, count - 1))] * (count - 1) + [np.log(_UNKNOWN_PRIOR)]
    even = F.array(*[F.lit(float(x)) for x in plain])
    others = F.zip_with("host_soft", "soft", lambda n, own: F.greatest(n - own, F.lit(0.0)))
    prior = F.when(
        F.col("host_soft").isNotNull(), F.transform(_pulled(others, F.col("parent"), pull), lambda p: F.log(p))
    ).otherwise(even)
    none = F.array_repeat(F.lit(0.0), count)
    joined = (
        scored.join(bounded(hosts, _HOSTS), "host", "left")
        .join(bounded(declared, _HOSTS), "declared", "left")
    )
    fused = F.zip_with(
        F.zip_with("likelihood", prior, lambda a, b: a + b),
        F.coalesce("evidence", none),
        lambda a, b: a + b,
    )
    known = F.array(*[F.lit(x) for x in languages])
    best = joined.withColumn("_logs", fused).withColumn("_top", F.array_max("_logs"))
    total = F.aggregate("_logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top")))
    unknown = F.exp(F.element_at("_logs", -1) - F.col("_top")) / total
    lang = F.element_at(known, F.array_position("_logs", F.col("_top")).cast("int"))
    by_text = F.element_at(known, F.array_position("likelihood", F.array_max("likelihood")).cast("int"))
    return best.select(
        "id",
        lang.alias("lang"),
        (1 / total).alias("score"),
        F.when(F.col("grams") > 0, by_text).alias("text_lang"),
        ((F.col("grams") > 0) & (1 - unknown >= accept)).alias("accepted"),
    )


def declared_language(html: str) -> Column:
    """The primary tag of the markup's ``lang`` attribute."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""", 1))
    return F.when(found != "", found)
