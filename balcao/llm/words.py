"""Words, shingles and byte classes of Arrow text batches, without a Python loop per word.

Texts are cut into words by byte class. A word is a 64-bit hash of its bytes; a
shingle is a 64-bit hash of its words. All hashes are fixed functions of the
bytes, so every task and every run agrees on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Every byte but ASCII white space, \x09 to \x0D and \x20.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Digits, a to z and every byte of a non-ASCII character.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

#: Bytes of text that a task works on at a time; a longer text is its own piece.
PIECE = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_POWERS = [np.empty(0, dtype=np.uint64)]


def _place_factors(n: int) -> np.ndarray:
    """Odd factors by place in a word, at least ``n`` of them."""
    if len(_POWERS[0]) < n:
        size = max(64, 1 << (n - 1).bit_length())
        _POWERS[0] = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    return _POWERS[0]


@dataclass
class Words:
    """Words of a piece of texts.

    hashes    one number per word
    doc_start first word of each text, and one entry past the last
    lengths   bytes of each word
    letters   the bytes of all words, one after the other, lower-cased
    """

    hashes: np.ndarray
    doc_start: np.ndarray
    lengths: np.ndarray
    letters: np.ndarray

    @property
    def per_doc(self) -> np.ndarray:
        return np.diff(self.doc_start)


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of runs of texts of about ``size`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        end = min(max(end, first + 1), len(texts))
        here = offsets[first : end + 1]
        yield first, end, raw[here[0] : here[-1]], here - here[0]
        first = end


def runs(symbols: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` symbols that cross no text border.

    Returns the first run of each text (and one entry past the last), the first
    kept symbol of each run, and the runs' lengths.
    """
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(symbols)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    first = np.cumsum(inside)[starts] - 1 if len(starts) else np.empty(0, np.int64)
    lengths = np.diff(np.append(first, np.count_nonzero(inside)))
    return np.searchsorted(starts, offsets), first, lengths


def run_hashes(values: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run from a random number for each of its symbols."""
    if not len(first):
        return np.empty(0, np.uint64)
    place = np.arange(len(values), dtype=np.int64) - np.repeat(first, lengths)
    factors = _place_factors(int(lengths.max()))
    return mix(np.add.reduceat(values * factors[place], first) + lengths.astype(np.uint64) * _STEP)


def beginning_hashes(letters: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """What ``run_hashes`` gives for the ``size`` letters from each place on."""
    factors = _place_factors(size)
    total = np.full(len(first), size, dtype=np.uint64) * _STEP
    for j in range(size):
        total += (_BYTE * factors[j])[letters[first + j]]
    return mix(total)


def cut(raw: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> Words:
    """The words of a piece: maximal runs of bytes in class ``kept``, never across texts."""
    low = LOWER[raw]
    inside = kept[low]
    doc_start, first, lengths = runs(low, offsets, inside)
    letters = low[inside]
    return Words(run_hashes(_BYTE[letters], first, lengths), doc_start, lengths, letters)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and the number in each text.

    A text of fewer words gives one, its whole sequence; a text without words none.
    """
    per_doc = words.per_doc
    count = np.where(per_doc == 0, 0, np.maximum(1, per_doc - k + 1))
    begin = np.repeat(words.doc_start[:-1], count)
    begin += np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count)
    short = np.repeat((per_doc < k), count)
    size = np.where(short, np.repeat(per_doc, count), k)
    total = size.astype(np.uint64) * _STEP
    factors = _place_factors(k)
    for j in range(k):
        there = np.minimum(begin + j, len(words.hashes) - 1)
        value = words.hashes[there] * factors[j]
        total += np.where(size > j, value, np.uint64(0))
    return mix(total), count


def distinct_per_doc(values: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their number."""
    doc = np.repeat(np.arange(len(count), dtype=np.int64), count)
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], np.bincount(doc[new], minlength=len(count))


def add_per_doc(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of each text's run of values; 0 for an empty run."""
    ends = np.cumsum(count)
    total = np.append(values.dtype.type(0), np.cumsum(values))
    if values.dtype == np.uint64:
        return total[ends] - total[ends - count]
    out = np.zeros(len(count), dtype=values.dtype)
    full = count > 0
    if full.any():
        out[full] = np.add.reduceat(values, (ends - count)[full])
    return out
