"""Words of UTF-8 texts as 128-bit hashes, computed on whole Arrow buffers.

Both word classes of this package are defined on bytes: every byte of a
non-ASCII character belongs to a word. So texts never become Python strings;
bytes are classed by a table of 256 entries, and a word is hashed from its own
bytes into two 64-bit lanes. A word of up to 16 bytes is two numbers, and the
lanes are a bijection of them, so such words never share both; longer ones take
the two halves of XXH3-128. Work is done in slices of bounded size; a text longer
than a slice is cut at separators, so that only a single huge word can exceed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20
_SHORT = 16  # bytes of a word that two numbers hold
_ROUNDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _table(separators: list[tuple[int, int]], fold: bool) -> np.ndarray:
    """Byte -> byte to hash; 0 for separators."""
    table = np.arange(256, dtype=np.uint8)
    if fold:
        table[ord("A") : ord("Z") + 1] += 32
    keep = np.ones(256, dtype=bool)
    for first, last in separators:
        keep[first : last + 1] = False
    return np.where(keep[table], table, 0).astype(np.uint8)


# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased.
ALNUM = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)], fold=True)
# Words [^\x20\x09-\x0D]+, unchanged. NUL is a letter here: it is hashed as byte 0x20.
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)], fold=False)
SPACED[0] = 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each value over all 64 bits; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) mod 2**64."""
    out = np.full(count, base & ((1 << 64) - 1), dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _number(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first eight bytes from each start, at most ``lengths`` of them, as one number."""
    every = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
    unused = (8 - np.minimum(lengths, 8)).astype(np.uint64) * np.uint64(8)
    return every[starts] & (np.uint64((1 << 64) - 1) >> unused)


def _hash_words(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two lanes for each word; no word holds the byte 0, so its length needs no place."""
    padded = np.concatenate([folded, np.zeros(_SHORT, np.uint8)])
    lengths = ends - starts
    first = _number(padded, starts, lengths)
    second = np.zeros_like(first)
    longer = np.flatnonzero(lengths > 8)
    second[longer] = _number(padded, starts[longer] + 8, lengths[longer] - 8)
    # Rounds that can be undone one by one: different numbers stay different.
    a, b, c, d = _ROUNDS
    first += mix(second + a)
    second = mix(second ^ mix(first + b))
    first = mix(first + mix(second ^ c)) ^ d
    packed = folded.data
    for i in np.flatnonzero(lengths > _SHORT).tolist():
        whole = xxhash.xxh3_128_intdigest(packed[starts[i] : ends[i]])
        first[i], second[i] = whole >> 64, whole & ((1 << 64) - 1)
    return first, second


def _hash_piece(
    data: np.ndarray, breaks: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and both hashes of the words of ``data``; no word crosses ``breaks``."""
    folded = table[data]
    inside = folded != 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[breaks] = True
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, *_hash_words(folded, starts, ends)


def _cuts(data: np.ndarray, table: np.ndarray) -> list[int]:
    """Places to cut one long text at: right after a separator, about a slice apart."""
    cuts, at = [0], 0
    while len(data) - at > SLICE_BYTES:
        end = at + SLICE_BYTES
        while True:
            gaps = np.flatnonzero(table[data[at:end]] == 0)
            if len(gaps) or end >= len(data):
                break
            end = min(len(data), end + SLICE_BYTES)
        if not len(gaps):
            break
        at += int(gaps[-1]) + 1
        cuts.append(at)
    return [*cuts, len(data)]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = texts.cast(pa.large_string())
    if wide.null_count:
        wide = wide.fill_null("")
    buffers = wide.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets


class Words:
    """Words of ``count`` texts from row ``first`` on; ``bounds[i]:bounds[i+1]`` are text i's.

    ``hashes`` and ``second`` are the lanes of their hashes.
    """

    def __init__(self, first, bounds, starts, ends, hashes, second):
        self.first, self.bounds = first, bounds
        self.starts, self.ends, self.hashes, self.second = starts, ends, hashes, second
        self.count = len(bounds) - 1


def words_of(texts: pa.Array, table: np.ndarray) -> Iterator[Words]:
    """Words of all texts, slice by slice in row order.

    ``starts`` and ``ends`` are byte places in the buffer of ``text_buffer``.
    """
    data, offsets = text_buffer(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, row + 1), rows)
        begin, end = int(offsets[row]), int(offsets[last])
        if end - begin <= SLICE_BYTES:
            pieces = [(begin, offsets[row : last + 1] - begin, end)]
        else:
            cuts = _cuts(data[begin:end], table)
            pieces = [(begin + a, np.zeros(1, np.int64), begin + b) for a, b in zip(cuts, cuts[1:])]
        parts = []
        for a, breaks, b in pieces:
            starts, ends, *lanes = _hash_piece(data[a:b], breaks, table)
            parts.append((starts + a, ends + a, *lanes))
        starts, ends, *lanes = (np.concatenate(x) for x in zip(*parts))
        bounds = np.searchsorted(starts, offsets[row : last + 1])
        yield Words(row, bounds, starts, ends, *lanes)
        row = last


def rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring word hashes; runs cross texts too."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    base |= 1
    up = powers(base, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:], dtype=np.uint64)
    count = len(hashes) - size + 1
    down = powers(pow(base, -1, 1 << 64), count)
    return mix((sums[size:] - sums[:count]) * down)


def whole_runs(bounds: np.ndarray, size: int) -> np.ndarray:
    """True where a run of ``size`` words starting at this word stays inside its text."""
    count = int(bounds[-1])
    inside = np.ones(max(0, count - size + 1), dtype=bool)
    ends = bounds[1:-1]
    # A run is cut by a text's end when it starts less than ``size`` words before it.
    mark = np.zeros(count + 2, dtype=np.int64)
    np.add.at(mark, np.maximum(ends - size + 1, 0), 1)
    np.add.at(mark, ends, -1)
    crossed = np.cumsum(mark)[: len(inside)] > 0
    return inside & ~crossed
