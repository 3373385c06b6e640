"""Public tokenizers in Python workers: loaded once, each distinct word encoded once."""

from __future__ import annotations

import array
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa

from slotledger.llm.support import once_per_worker
from slotledger.llm.words import text_buffer

CACHE_WORDS = 600_000  # about 150 MB; once full, new words are kept for one slice only
SLICE_TEXTS, SLICE_BYTES = 1024, 2 << 20
_TAILS = (".", ",")
# Letters that keep being one letter in lower case.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
_JOINED = 8192  # words encoded as one text
_MARK = "7"  # a digit is a token of its own where digits are single


def load(path: str):
    from tokenizers import Tokenizer

    return once_per_worker(("tokenizer", path), lambda: Tokenizer.from_file(path))


def forget_words(path: str) -> None:
    """Give back the memory of the words this worker knows."""
    once_per_worker(("words", path), dict).clear()


def _encode(tokenizer, texts: list[str]) -> list[list[int]]:
    return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _marked(tokenizer, words: list[str]) -> dict[str, bytes]:
    """Ids of each word. Many words go in one text, with a marking digit between any two;
    words with that digit, or all if the tokenizer does not keep it apart, go singly."""
    mark, first, last, three = _encode(tokenizer, [_MARK, "a", "b", f"a {_MARK} b"])
    kept_apart = len(mark) == 1 and three == [*first, *mark, *last]
    plain = [w for w in words if _MARK not in w] if kept_apart else []
    single = list(set(words).difference(plain))
    out = {w: array.array("I", x).tobytes() for w, x in zip(single, _encode(tokenizer, single))}
    for at in range(0, len(plain), _JOINED):
        some = plain[at : at + _JOINED]
        ids = np.array(_encode(tokenizer, [f" {_MARK} ".join(some)])[0], dtype="<u4")
        ends = np.flatnonzero(ids == mark[0])
        packed, starts = ids.tobytes(), np.concatenate([[0], ends + 1])
        bounds = zip(some, (4 * starts).tolist(), (4 * np.append(ends, len(ids))).tolist())
        out.update((w, packed[a:b]) for w, a, b in bounds)
    return out


def _word_ends(tokenizer) -> np.ndarray | None:
    """By id, whether the token ends a word; None if the vocabulary does not tell."""
    suffix = tokenizer.model.end_of_word_suffix
    if not suffix:
        return None
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def _letters(words: list[str], tokenizer, path: str) -> dict[str, bytes]:
    """Ids of words of Latin letters only: one word, one token with a word end."""
    ends_word = once_per_worker(("ends", path), lambda: _word_ends(tokenizer))
    if ends_word is None:
        return _marked(tokenizer, words)
    out = {}
    for at in range(0, len(words), _JOINED):
        some = words[at : at + _JOINED]
        ids = np.array(_encode(tokenizer, [" ".join(some)])[0], dtype="<u4")
        ends = (np.flatnonzero(ends_word[ids]) + 1) * 4
        packed = ids.tobytes()
        bounds = zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)
        out.update((w, packed[a:b]) for w, a, b in bounds)
    return out


def _encode_words(tokenizer, path: str, words: set[str], known: dict[str, bytes]) -> None:
    """Add the ids of each word; one of Latin letters and a point or comma is two words' ids.

    Only of Latin letters: others may end in a mark that the tokenizer joins to the point.
    """
    letters, tailed, others = [], [], []
    for word in words:
        if word.isalpha():
            letters.append(word)
        elif word[-1:] in _TAILS and _LATIN(word[:-1]):
            tailed.append(word)
        else:
            others.append(word)
    stems = {word[:-1] for word in tailed}.difference(letters)
    letters += [stem for stem in stems if stem not in known]
    latin = [w for w in letters if _LATIN(w)]
    if len(latin) < len(letters):
        others += set(letters).difference(latin)
    known.update(_letters(latin, tokenizer, path))
    known.update(_marked(tokenizer, [*others, *_TAILS]))
    known.update([(word, known[word[:-1]] + known[word[-1]]) for word in tailed])


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Pieces of texts, each a word and the space or line end behind it, and the first of each text."""
    own = data[offsets[0] : offsets[-1]]
    edge = np.zeros(len(own) + 1, dtype=bool)
    np.logical_or(own == 0x20, own == 0x0A, out=edge[1:])
    edge[offsets - offsets[0]] = True
    edges = np.flatnonzero(edge)
    pieces = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(own))
    return pieces, np.searchsorted(edges, offsets - offsets[0])


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` one after another, and where each begins and the last ends."""
    ends = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=ends[1:])
    places = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)
    return flat[places], ends


def _ids_by_word(texts: pa.Array, path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    tokenizer = load(path)
    known = once_per_worker(("words", path), dict)
    data, offsets = text_buffer(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, row + 1), rows)
        pieces, firsts = _split(data, offsets[row : last + 1])
        coded = pieces.dictionary_encode()
        words = [x.rstrip(" \n") for x in coded.dictionary.to_numpy(zero_copy_only=False)]
        before = len(known)
        _encode_words(tokenizer, path, set(words).difference(known), known)
        packed = list(map(known.__getitem__, words))
        flat = np.frombuffer(b"".join(packed), dtype="<u4")
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        starts = np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy()
        ids, ends = _gather(flat, starts[at], lengths[at])
        yield ids, ends[firsts]
        row = last
        if before > CACHE_WORDS:
            for word in list(islice(reversed(known), len(known) - before)):
                del known[word]


def encode_texts(texts: pa.Array, path: str, drops_spaces: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of every whole text, slice by slice: all of a slice's ids, and its n + 1 bounds.

    ``drops_spaces``: the tokenizer drops white space and never joins what it divides,
    so the words between spaces and line ends are encoded on their own and kept.
    """
    if drops_spaces:
        yield from _ids_by_word(texts, path)
        return
    for at in range(0, len(texts), SLICE_TEXTS):
        found = _encode(load(path), texts.slice(at, SLICE_TEXTS).fill_null("").to_pylist())
        ends = np.cumsum([0, *map(len, found)])
        yield np.fromiter((i for ids in found for i in ids), "<u4", int(ends[-1])), ends
