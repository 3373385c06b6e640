"""SimHash near-duplicates, probed by the generalised pigeonhole principle.

Fingerprints whose distance is at most ``distance`` must agree, in at least one part
of their bits, up to that part's own threshold, if the thresholds plus one sum to
``distance`` + 1. Bits are grouped into parts by how they correlate over all distinct
fingerprints; for every number of parts, dynamic programming allots the thresholds that
make the fewest estimated probes and candidates; the cheapest plan wins. Then:

* each distinct fingerprint is indexed once per part and probes all values within the
  part's threshold;
* rows meet per value; fingerprints of a value are compared on all 64 bits and only a
  spanning forest of their links leaves the task: as many rows as fingerprints, not
  pairs, yet no link between components is lost;
* values with more than ``GROUP`` rows are cut into blocks, and every pair of blocks is
  compared in its own task;
* components come from the forests (``components.roots``).

Edge cases: null and wordless texts have fingerprint 0 and are linked like any other;
fewer words than a shingle make one shingle; copies and repeated rows share a
fingerprint and so a component; ``component_id`` ignores null ids (null where there is no
other); long texts are read whole, slice by slice; a bit set in exactly half of the hashes
counts as 0; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.components import roots
from slotledger.llm.support import bounded, slices, text_or_empty
from slotledger.session import cut

SHINGLE, DISTANCE, SEED = 4, 4, 42
BITS = 64
GROUP = 8192  # most rows of a value that one task compares
COMPONENTS = 1_000_000  # broadcast bound of components of more than one fingerprint
_SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
_SLICE = 1 << 16  # hashes whose bits are counted at once
# What a probe costs to shuffle and sort, in comparisons of two fingerprints.
_PROBE_COST = 200.0


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of the bits of the shingles' hashes."""
    words = _SPACED.findall(text)
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at : at + _SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, fold: bool = False
) -> DataFrame:
    """``_id`` and the ``_print`` (64 bits as a signed long) of each row; with ``fold``,
    A-Z count as a-z."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t for part in slices(batch) for t in part.column("_text").cast(pa.binary()).to_pylist())
            # bytes.lower() changes A-Z only
            prints = np.array([fingerprint(t.lower() if fold else t, shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(prints.view(np.int64))], names=["_id", "_print"]
            )

    plain = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    return plain.mapInArrow(run, f"_id {kind}, _print bigint")


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each two bits are both set: one row per task."""
    both = np.zeros((BITS, BITS), dtype=np.int64)
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(prints, axis=1, bitorder="little").astype(np.float64)
        both += (bits.T @ bits).astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array([both.ravel().tolist()], type=pa.list_(pa.int64()))], names=["both"]
    )


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 table of bits set together."""
    rows = (
        prints.mapInArrow(_bit_counts, "both array<bigint>")
        .select(F.posexplode("both").alias("k", "n"))
        .groupBy("k").agg(F.sum("n").alias("n")).collect()
    )
    both = np.zeros(BITS * BITS)
    for row in rows:
        both[row.k] = row.n
    return prints.count(), both.reshape(BITS, BITS)


def group_bits(count: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of equal size: the bit with the strongest ties left, then those tied to the part."""
    share = np.diag(both) / max(1, count)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    ties = np.abs(both / max(1, count) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(ties, 0)
    left, groups = list(range(BITS)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        group = [left[int(np.argmax(ties[np.ix_(left, left)].sum(axis=1)))]]
        left.remove(group[0])
        while len(group) < size:
            best = left[int(np.argmax(ties[np.ix_(left, group)].sum(axis=1)))]
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def _cost(count: int, both: np.ndarray, group: list[int], units: int) -> float:
    """Estimated comparisons' worth of a part with threshold ``units`` - 1 (0: not used)."""
    if not units:
        return 0.0
    share = np.diag(both)[group] / max(1, count)
    within = np.array([1.0])
    for p in 2 * share * (1 - share):  # chance that two fingerprints differ in this bit
        within = np.append(within * (1 - p), 0) + np.insert(within * p, 0, 0)
    candidates = count * count / 2 * within[:units].sum()
    probes = count * sum(comb(len(group), r) for r in range(units))
    return candidates + _PROBE_COST * probes


def plan_probes(count: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """The parts to probe, each with its threshold."""
    best: tuple[float, list] = (float("inf"), [])
    for parts in range(1, distance + 2):
        groups = group_bits(count, both, parts)
        # state: units allotted so far -> least cost and the allotment
        state = {0: (0.0, [])}
        for group in groups:
            reached: dict[int, tuple[float, list]] = {}
            for used, (cost, units) in state.items():
                for u in range(min(distance + 1 - used, 3) + 1):  # radius 2 at most per part
                    option = (cost + _cost(count, both, group, u), [*units, u])
                    if used + u not in reached or option < reached[used + u]:
                        reached[used + u] = option
            state = reached
        if distance + 1 in state and state[distance + 1][0] < best[0]:
            cost, units = state[distance + 1]
            best = (cost, [(g, u - 1) for g, u in zip(groups, units) if u])
    return best[1]


def _probe_rows(plan: list[tuple[list[int], int]]):
    """Index and probe rows of every fingerprint: part, value, fingerprint, probing."""
    masks = [sum(1 << b for b in group) for group, _ in plan]
    flips = [
        [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(group, r)]
        for group, radius in plan
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for part, (mask, others) in enumerate(zip(masks, flips)):
                for flip in [0, *others]:
                    values = (prints ^ np.uint64(flip)) & np.uint64(mask)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(prints), part, np.int32)),
                            pa.array(values.view(np.int64)),
                            pa.array(prints.view(np.int64)),
                            pa.array(np.full(len(prints), flip != 0)),
                        ],
                        names=["part", "value", "print", "probing"],
                    )

    return run


def _forest(prints: np.ndarray, probing: np.ndarray, distance: int) -> tuple[list, list]:
    """Links that span the components of one group.

    Each fingerprint reached is compared with those not reached yet; probes are not
    compared with each other, since the index holds both of them elsewhere.
    """
    index, probes = prints[~probing], prints[probing]
    u, v = [], []
    while len(index):
        queue = [(index[0], True)]
        index = index[1:]
        while queue and (len(index) or len(probes)):
            node, indexed = queue.pop()
            near = np.bitwise_count(index ^ node) <= distance
            reached = [(x, True) for x in index[near]]
            index = index[~near]
            if indexed and len(probes):
                near = np.bitwise_count(probes ^ node) <= distance
                reached += [(x, False) for x in probes[near]]
                probes = probes[~near]
            for x, _ in reached:
                u.append(node)
                v.append(x)
            queue += reached
    return u, v


def _links(distance: int):
    """Forests of all groups; rows come sorted by group, a group may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def solve(table: pa.Table) -> pa.RecordBatch:
            keys = [table.column(c).to_numpy() for c in ("part", "value", "low", "high")]
            prints = table.column("print").to_numpy().view(np.uint64)
            probing = table.column("probing").to_numpy()
            new = np.zeros(table.num_rows, dtype=bool)
            new[:1] = True
            for key in keys:
                new[1:] |= key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            u, v = [], []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                if b - a > 1:
                    more = _forest(prints[a:b], probing[a:b], distance)
                    u += more[0]
                    v += more[1]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (u, v)], names=["u", "v"]
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            last = np.ones(table.num_rows, dtype=bool)
            for c in ("part", "value", "low", "high"):
                key = table.column(c).to_numpy()
                last &= key == key[-1]
            whole = int(np.argmax(last))  # the last group may go on in the next batch
            rest = table.slice(whole)
            if whole:
                yield solve(table.slice(0, whole))
        if rest is not None:
            yield solve(rest.combine_chunks())

    return run


def _meet(rows: DataFrame, group: int) -> DataFrame:
    """Give each row the block pairs (``low``, ``high``) it is compared in."""
    keys = ["part", "value"]
    large = (
        rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > group)
        .select(*keys, F.ceil(F.col("_n") / (group // 2)).cast("int").alias("_blocks"))
    )
    split = rows.join(large, keys, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("print"), F.col("_blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    return (
        split.withColumn("_own", own)
        .withColumn("_other", F.explode(others))
        .select(
            *keys, "print", "probing",
            F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"),
        )
    )


def near_links(prints: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Pairs ``u, v`` of distinct fingerprints that span every component of near ones.

    ``prints`` has distinct ``_print`` values.
    """
    count, both = bit_statistics(prints.select("_print"))
    plan = plan_probes(count, both, distance)
    rows = prints.select("_print").mapInArrow(
        _probe_rows(plan), "part int, value bigint, print bigint, probing boolean"
    )
    keys = ["part", "value", "low", "high"]
    spread = _meet(rows, group).repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(_links(distance), "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    group: int = GROUP,
    fold: bool = False,
) -> DataFrame:
    """Per row: ``id_col``, ``fingerprint`` (hex), ``component_id`` and ``component``.

    ``component_id`` is the smallest id reachable over links of at most ``distance``
    bits, the row's own included; ``component`` the least fingerprint, as a signed long.
    """
    own = cut(fingerprints(docs, id_col, text_col, shingle, fold), "fingerprints")
    nodes = cut(own.groupBy("_print").agg(F.min("_id").alias("_least")), "distinct-fingerprints")
    stars = roots(near_links(nodes, distance, group))
    found = nodes.join(stars, nodes["_print"] == stars["node"], "left").select(
        "_print", "_least", F.coalesce("root", "_print").alias("component")
    )
    # Only fingerprints with a link share a component with another one.
    linked = found.join(stars.select(F.col("root").alias("component")).distinct(), "component", "left_semi")
    ids = cut(linked.groupBy("component").agg(F.min("_least").alias("_reached")), "component-ids")
    named = cut(
        found.join(bounded(ids, COMPONENTS), "component", "left").select(
            "_print", "component", F.when(F.col("_reached").isNotNull(), F.col("_reached")).otherwise(F.col("_least")).alias("component_id")
        ),
        "components",
    )
    return own.join(named, "_print").select(
        F.col("_id").alias(id_col),
        F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"),
        "component_id",
        "component",
    )
