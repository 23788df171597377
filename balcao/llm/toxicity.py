"""Toxicity by noisy-channel restoration of disguised words, then scored evidence.

Most words are plain and stand for themselves. A stretch that mixes letters with
look-alike digits or marks, that spells a word out with gaps, or that doubles or stretches
a letter, is decoded: each symbol run allows several intended letters (itself, what
it looks like, once or twice for a run), gaps vanish or end a word, an exclamation
mark at the end may be just that, and the Viterbi path under a character trigram model, less
the channel's costs, gives the restored words. A stretch spelled out is also read
without its first and without its last letter. Chunks of several letters are joined
where the same model and costs prefer one word.

Evidence is learned from labelled rows: how much more often a word, or a word
beginning of four or five letters, occurs in toxic texts than in others, as a
cautious (lower bound) log ratio. A logistic model over the strongest piece, the
sum, and the sum per word gives the score.

Training takes every labelled row: trigrams from all of them, evidence first from the toxic
texts, then how often the others hold what several toxic ones do, and the logistic model by
Newton steps whose sums Spark adds up over all rows. Scoring covers whole texts of all rows. Null and
empty texts carry no evidence and get the score of that. Without both labels in training, every score is 0. An id labelled both ways
counts as toxic.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import words as W
from balcao.sources.scratch import stage

_BEGINNINGS = (4, 5)
_LEAST_TEXTS = 4

# Letters that digits and marks are commonly written for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
_LOOK_COST, _GAP_COST, _REPEAT_COST = 1.5, 0.5, 0.7
#: Letters of the longest word that joined chunks make.
_JOINED_LETTERS = 64

#: Stretches whose readings a worker remembers before a piece, and the bytes of the longest of them.
_REMEMBERED, _SHORT = 150_000, 64

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True

# What may stand between the letters of a word: white space and marks, also the usual ones outside ASCII.
_GAP = rb"(?:[^a-z0-9@$!|+\x80-\xff]|\xc2[\xa0-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf]|\xe2\x80[\x80-\xbf])+"
_GAPS = re.compile(_GAP)
_DISGUISED = re.compile(
    rb"(?<![a-z0-9])(?:(?P<spelled>([a-z0-9@$!|+])\2*(?:" + _GAP + rb"([a-z0-9@$!|+])\3*){2,}(?![a-z0-9]))"
    rb"|(?<![@$!|+])[a-z0-9@$!|+]*(?:[0-9@$!|+][a-z]|[a-z][0-9@$!|+]|([a-z])\4)[a-z0-9@$!|+]*)"
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"abcdefghijklmnopqrstuvwxyz0123456789@$!|+")] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"@$!|+")] = True
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[97:123] = True
# Bytes that no gap holds: letters outside ASCII begin with these.
_NO_GAP = np.zeros(256, dtype=bool)
_NO_GAP[0xC0:] = True
_NO_GAP[[0xC2, 0xE2]] = False
_NO_LETTERS = re.compile(rb"[^a-z]+")

_SIZE = 27  # the border of a word, then a to z
_CODE = np.full(256, _SIZE, dtype=np.int64)
_CODE[97:123] = np.arange(1, _SIZE)

#: Bytes of text worked on at a time, so that the arrays for them stay in a core's cache.
_PIECE = 1 << 18
#: Bytes after the last text, so that eight can be read at every place.
_PAST = 8
#: Letters up to which words are read eight at a time.
_EIGHTS = 32
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _options(symbol: str, length: int) -> list[tuple[bytes, float]]:
    """The letters that a run of a symbol is meant for, and what each reading costs. Any length over 3 is like 3."""
    meant = [(symbol, 0.0)] if "a" <= symbol <= "z" else [(letter, _LOOK_COST) for letter in LOOK_ALIKES.get(symbol, "")]
    options: list[tuple[bytes, float]] = []
    for letter, cost in meant:
        options.append((letter.encode(), cost + _REPEAT_COST * (length > 1)))
        if length > 1:
            options.append((letter.encode() * 2, cost + _REPEAT_COST * (length > 2)))
    return options or [(b"", _LOOK_COST)]


_OPTIONS = {(chr(symbol), length): _options(chr(symbol), length) for symbol in range(256) for length in (1, 2, 3)}


@dataclass
class ToxicityModel:
    """``trigrams``: log probabilities of a letter after two; ``keys``, ``weights``: evidence."""

    trigrams: np.ndarray
    keys: np.ndarray
    weights: np.ndarray
    logistic: np.ndarray

    @cached_property
    def known(self) -> _Sorted:
        return _Sorted(self.keys)


def restore(trigrams: np.ndarray | list[float], seen: bytes) -> bytes:
    """The likeliest words behind a disguised stretch, with a space between two.

    ``trigrams`` may be a flat list, which is read faster one by one.
    """
    flat = trigrams if isinstance(trigrams, list) else trigrams.ravel().tolist()
    runs: list[list] = []
    for symbol in _GAPS.sub(b" ", seen).decode("latin-1"):
        if runs and runs[-1][0] == symbol:
            runs[-1][1] += 1
        else:
            runs.append([symbol, 1])
    # The best path to each pair of last letters: its score, and its letters as a chain.
    paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for at, (symbol, length) in enumerate(runs):
        ahead: dict[int, tuple[float, tuple | None]] = {}
        if symbol == " ":  # a gap vanishes or ends a word
            ended = [(score + flat[pair * _SIZE], (chain, b" ")) for pair, (score, chain) in paths.items() if pair % _SIZE]
            ahead = {of: (score - _GAP_COST, chain) for of, (score, chain) in paths.items()}
            if ended:
                ahead[0] = max([*ended, *([paths[0]] if 0 in paths else [])], key=lambda x: x[0])
            paths = ahead
            continue
        options = _OPTIONS[symbol, min(length, 3)]
        if symbol == "!" and at and (at + 1 == len(runs) or runs[at + 1][0] == " "):
            options = [*options, (b"", _GAP_COST)]
        for pair, (score, chain) in paths.items():
            for added, cost in options:
                last, total = pair, score - cost
                for letter in added:
                    here = last * _SIZE + letter - 96
                    total += flat[here]
                    last = here % _SIZE**2
                known = ahead.get(last)
                if known is None or known[0] < total:
                    ahead[last] = (total, (chain, added) if added else chain)
        paths = ahead
    ends = ((score + (flat[pair * _SIZE] if pair % _SIZE else 0.0), chain) for pair, (score, chain) in paths.items())
    _, chain = max(ends, key=lambda x: x[0])
    letters = []
    while chain is not None:
        chain, added = chain
        letters.append(added)
    return b"".join(reversed(letters)).strip()


def _padded(symbols: np.ndarray) -> np.ndarray:
    return np.concatenate([symbols, np.zeros(_PAST, dtype=np.uint8)])


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of set flags that cross no text border, and the first run of each text."""
    begins, last = inside.copy(), inside.copy()
    np.greater(inside[1:], inside[:-1], out=begins[1:])
    np.greater(inside[:-1], inside[1:], out=last[:-1])
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    begins[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


def _numbered(first_of: np.ndarray) -> np.ndarray:
    """The text of each run, from the first run of each text and one entry past the last."""
    return np.repeat(np.arange(len(first_of) - 1), np.diff(first_of))


def _holding(places: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which runs hold one of the sorted places or more."""
    holds = np.zeros(len(start), dtype=bool)
    run = np.searchsorted(start, places, side="right") - 1
    holds[run[(run >= 0) & (places < end[run])]] = True
    return holds


def _stretches(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where disguised words stand, all texts at once: texts, starts, ends, and which texts may spell words out.

    The same stretches as ``_DISGUISED`` finds, in texts without three chunks in a row
    that a word spelled out consists of: a middle one of one symbol, between two that are
    of one symbol or hold a mark. Other texts are flagged, to be searched by the pattern.
    """
    symbol, letter = _SYMBOL[low], _PLAIN[low]
    start, end, first_of = _runs(symbol, offsets)
    doc = _numbered(first_of)
    spells = np.zeros(len(offsets) - 1, dtype=bool)
    if not len(start):
        return doc, start, end, spells
    same = low[1:] == low[:-1]
    pair = np.flatnonzero(symbol[1:] & symbol[:-1] & ((letter[1:] != letter[:-1]) | (letter[1:] & same)))
    run = np.searchsorted(start, pair, side="right") - 1
    run = run[pair + 1 < end[run]]
    disguised = np.zeros(len(start), dtype=bool)
    disguised[run] = True
    unit = end - start == 1
    alike = np.flatnonzero((end - start > 1) & (low[start] == low[np.minimum(start + 1, len(low) - 1)]) & (low[start] == low[end - 1]))
    if len(alike):
        changes = np.concatenate([[0], np.cumsum(~same)])
        unit[alike] = changes[end[alike] - 1] == changes[start[alike]]
    side = unit | _holding(np.flatnonzero(_MARK[low]), start, end)
    if len(start) > 2:
        middle = np.flatnonzero(unit[1:-1] & side[:-2] & side[2:] & (doc[2:] == doc[:-2])) + 1
        between = np.flatnonzero(_NO_GAP[low]) if len(middle) else middle
        before, after = np.searchsorted(between, end[middle - 1]), np.searchsorted(between, start[middle])
        joined = before == after
        before, after = np.searchsorted(between, end[middle]), np.searchsorted(between, start[np.minimum(middle + 1, len(start) - 1)])
        spells[doc[middle[joined & (before == after)]]] = True
    return doc[disguised], start[disguised], end[disguised], spells


class _Restorer:
    """Restores stretches, remembering recent ones."""

    def __init__(self, trigrams: np.ndarray):
        self.trigrams, self.flat, self.known = trigrams, trigrams.ravel().tolist(), {}

    def _readings(self, seen: bytes, spelled: bool) -> tuple[bytes, tuple[bytes, ...]]:
        """What a stretch restores to, and the restored words that it does not show itself."""
        if not spelled:
            words = restore(self.flat, seen)
            readings = words.split()
        else:
            # A neighbour of one letter may belong to the text around the stretch.
            seen = _GAPS.sub(b" ", seen)
            words = restore(self.flat, seen)
            ends = seen.index(b" ") + 1, seen.rindex(b" ")
            others = [restore(self.flat, part) for part in (seen[ends[0] :], seen[: ends[1]])]
            readings = b" ".join([words, *others]).split()
        return words, tuple(set(readings).difference(_NO_LETTERS.split(seen)))

    def __call__(self, low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
        """The text of each new word of a piece's disguised stretches, these words, and the restored texts with their borders."""
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        text = low.tobytes()
        docs, starts, ends, spells = _stretches(low, offsets)
        spans = (docs, starts, ends, np.zeros(len(docs), dtype=bool))
        if spells.any():
            matches = []
            for doc in np.flatnonzero(spells).tolist():
                a, b = int(offsets[doc]), int(offsets[doc + 1])
                matches += [(doc, a + m.start(), a + m.end(), m["spelled"] is not None) for m in _DISGUISED.finditer(text[a:b])]
            table = np.array(matches, dtype=np.int64).reshape(-1, 4)
            spans = [np.concatenate([x[~spells[docs]], y.astype(x.dtype)]) for x, y in zip(spans, table.T, strict=True)]
            order = np.argsort(spans[1])
            spans = [x[order] for x in spans]
        docs, starts, ends, spelled = spans
        seen = [text[start:end] for start, end in zip(starts.tolist(), ends.tolist(), strict=True)]
        readings = [known.get(stretch) for stretch in seen]
        for at in [at for at, reading in enumerate(readings) if reading is None]:
            readings[at] = self._reading(seen[at], spelled[at])
        changed = [at for at, reading in enumerate(readings) if reading]
        docs, starts, ends = docs[changed], starts[changed], ends[changed]
        readings = [readings[at] for at in changed]
        words = [words for words, _ in readings]
        plain: list[bytes] = [b""] * (2 * len(words) + 1)
        plain[::2] = [text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True)]
        plain[1::2] = words
        grown = np.concatenate([[0], np.cumsum(np.array([len(x) for x in words], dtype=np.int64) - (ends - starts))])
        borders = offsets + grown[np.searchsorted(starts, offsets)]
        new = [new for _, new in readings]
        texts = np.repeat(docs, np.array([len(x) for x in new], dtype=np.int64))
        return texts, b" ".join(itertools.chain.from_iterable(new)), np.frombuffer(b"".join(plain), dtype=np.uint8), borders

    def _reading(self, seen: bytes, spelled: bool) -> tuple:
        """What a stretch restores to and the words new in that; nothing if it stays as it is."""
        reading = self.known.get(seen)
        if reading is None:
            # Numbers alone are left as they are.
            reading = () if seen.isdigit() else self._readings(seen, spelled)
            reading = () if reading == (seen, ()) else reading
            if len(seen) <= _SHORT:
                self.known[seen] = reading
        return reading


def _joined(
    trigrams: np.ndarray, letters: np.ndarray, first: np.ndarray, lengths: np.ndarray, doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Successive chunks that are likelier one word than several, joined: first letters, lengths and texts.

    Where both chunks have two letters or more, a gap's two options differ only by the
    letters next to it, so all gaps are decided at once. Rows of joined chunks
    are read from and to each chunk within. The letters of chunks follow each other without gaps.
    """
    flat, after = trigrams.ravel(), first + lengths
    join = np.zeros(len(lengths), dtype=bool)  # with the next chunk
    if len(lengths) > 1:
        long = lengths > 1
        b, a = _CODE[letters[after[:-1] - 1]], np.where(long[:-1], _CODE[letters[np.maximum(after[:-1] - 2, 0)]], 0)
        c, d = _CODE[letters[first[1:]]], np.where(long[1:], _CODE[letters[first[1:] + 1]], 0)
        maybe = np.flatnonzero((np.maximum(np.maximum(a, b), np.maximum(c, d)) < _SIZE) & (doc[1:] == doc[:-1]))
        a, b, c, d = a[maybe], b[maybe], c[maybe], d[maybe]
        ab, cd = (a * _SIZE + b) * _SIZE, c * _SIZE + d
        one = flat[ab + c] + flat[b * _SIZE**2 + cd] - _GAP_COST
        join[maybe] = one > flat[ab] + flat[c] + flat[cd]
    begins, ends, last = [], [], np.flatnonzero(join)
    begin = last
    while len(begin):
        last = last + 1
        fits = after[last] - first[begin] <= _JOINED_LETTERS
        begin, last = begin[fits], last[fits]
        begins.append(begin)
        ends.append(last)
        begin, last = begin[join[last]], last[join[last]]
    begin = np.concatenate(begins) if begins else np.empty(0, np.int64)
    last = np.concatenate(ends) if ends else begin
    return first[begin], after[last] - first[begin], doc[begin]


def _keys(letters: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, and its first eight bytes. Letters are padded, and none is a zero byte.

    Up to eight letters are the number itself, longer words are hashed.
    """
    eight = np.ndarray(len(letters) - _PAST + 1, "<u8", letters, strides=(1,))
    seen = eight[first]
    keys = seen & _FIRST[np.minimum(lengths, 8)]
    long = np.flatnonzero(lengths > 8)
    for done in range(8, _EIGHTS, 8):
        if not len(long):
            return keys, seen
        rest = eight[first[long] + done] & _FIRST[np.minimum(lengths[long] - done, 8)]
        keys[long] = W.mix(W.mix(keys[long]) + rest)
        long = long[lengths[long] > done + 8]
    if len(long):
        begin, size = first[long], lengths[long]
        own = np.cumsum(size) - size
        taken = letters[np.repeat(begin - own, size) + np.arange(int(size.sum()))]
        keys[long] = W.run_hashes(W._BYTE[taken], own, size)
    return keys, seen


def _evidence_keys(letters: np.ndarray, first: np.ndarray, lengths: np.ndarray, doc: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Numbers of words and of word beginnings, each with the text that it is in."""
    keys, seen = _keys(letters, first, lengths)
    parts = [(keys, doc)]
    for size in _BEGINNINGS:
        long = np.flatnonzero(lengths > size)
        # No word of eight letters ends in such a byte.
        parts.append((seen[long] & _FIRST[size] | np.uint64(size << 56), doc[long]))
    return parts


def _piecewise(
    texts: pa.Array, restorer: _Restorer, size: int = _PIECE
) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]], np.ndarray]]:
    """(first, end, keys with their texts in parts, words per text)."""
    for begin, end, raw, offsets in W.pieces(texts, size):
        letters = _padded(W.LOWER[raw])
        low = letters[: len(raw)]
        start, stop, first_of = _runs(_LETTER[low], offsets)
        parts = _evidence_keys(letters, start, stop - start, _numbered(first_of))
        given, extra, restored, borders = restorer(low, offsets)
        inside = _LETTER[restored]
        chunk, stop, chunk_of = _runs(inside, borders)
        lengths = stop - chunk
        letters = _padded(restored[inside])
        parts += _evidence_keys(letters, *_joined(restorer.trigrams, letters, np.cumsum(lengths) - lengths, lengths, _numbered(chunk_of)))
        if extra:
            own, stop, _ = _runs(_LETTER[np.frombuffer(extra, dtype=np.uint8)], np.array([0, len(extra)]))
            parts += _evidence_keys(_padded(np.frombuffer(extra, dtype=np.uint8)), own, stop - own, given)
        yield begin, end, parts, np.diff(first_of)


class _Sorted:
    """Sorted keys, found by some bits of a product: most other keys share these with none, so few are compared."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = min(22, 6 + len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        products = keys.view(np.uint64) * W._STEP
        self.order = np.argsort(products)
        self.products = products[self.order]
        self.first = np.searchsorted(self._bits(self.products), np.arange((1 << bits) + 1))
        self.some = np.diff(self.first) > 0

    def _bits(self, products: np.ndarray) -> np.ndarray:
        return (products >> self.shift).view(np.int64)

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the keys of those asked for that are one, and where these stand among the asked."""
        products = asked.view(np.uint64) * W._STEP
        bits = self._bits(products)
        maybe = np.flatnonzero(self.some[bits])
        bits, products = bits[maybe], products[maybe]
        at, end = self.first[bits], self.first[bits + 1]
        left = np.arange(len(maybe))
        place = np.full(len(maybe), -1)
        while len(left):
            hit = self.products[at[left]] == products[left]
            place[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        hit = np.flatnonzero(place >= 0)
        return self.order[place[hit]], maybe[hit]

    def within(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Places among the keys of all keys of the parts that are one, and the texts that hold them."""
        found = [(place, doc[hit]) for asked, doc in parts for place, hit in [self.find(asked.view(self.keys.dtype))]]
        return np.concatenate([place for place, _ in found]), np.concatenate([doc for _, doc in found])


def _trigram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for _, _, raw, offsets in W.pieces(batch.column("text")):
            words = W.cut(raw, offsets, _LETTER)
            _, at = np.unique(words.hashes, return_index=True)
            first = (np.cumsum(words.lengths) - words.lengths)[at]
            lengths = words.lengths[at]
            own = np.cumsum(lengths + 3) - lengths - 3
            letters = np.zeros(int((lengths + 3).sum()), dtype=np.int64)
            place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            letters[np.repeat(own + 2, lengths) + place] = words.letters[np.repeat(first, lengths) + place]
            letters = np.where(letters >= 128, -1, np.maximum(letters - 96, 0))
            three = np.stack([letters[:-2], letters[1:-1], letters[2:]])
            plain = (three >= 0).all(axis=0) & ~((three[1] == 0) & (three[2] == 0)) & ~((three[0] > 0) & (three[1] == 0))
            a, b, c = three[:, plain]
            total += np.bincount((a * _SIZE + b) * _SIZE + c, minlength=_SIZE**3)
        gram = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(total[gram])], ["gram", "n"])


def _trigrams(table: pa.Table) -> np.ndarray:
    counts = np.zeros(_SIZE**3)
    counts[table.column("gram").to_numpy()] = table.column("n").to_numpy()
    three = counts.reshape(_SIZE, _SIZE, _SIZE)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    share = (one + 1) / (one + 1).sum()
    share = (two + 5 * share) / (two.sum(axis=1, keepdims=True) + 5)
    return np.log((three + 5 * share) / (three.sum(axis=2, keepdims=True) + 5))


def train(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic) of training rows only."""
    spark = documents.sparkSession
    given = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("of_doc"))
    given = given.agg(F.max("toxic").cast("int").alias("toxic"))
    texts = documents.select("doc_id", "text").filter("text is not null")
    # Texts meet their labels the same way at every size, and are not sorted for it.
    labelled = texts.join(given.hint("shuffle_hash"), F.col("doc_id") == F.col("of_doc"))
    sample = stage(labelled.select("text", "toxic"), "toxic")
    grams = sample.mapInArrow(_trigram_counts, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    trigrams = _trigrams(grams.toArrow())
    # Tasks that a worker runs one after the other remember what those before have restored.
    restorer = spark.sparkContext.broadcast(_Restorer(trigrams))

    def counted(some: DataFrame, among: np.ndarray | None = None) -> DataFrame:
        """How many of the texts hold each key, or each one of the sorted keys ``among``."""
        sent = spark.sparkContext.broadcast(among)

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin, end, parts, _ in _piecewise(batch.column("text"), restorer.value, W.PIECE):
                    keys, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
                    known, place = np.unique(keys.view(np.int64), return_inverse=True)
                    place, n = _texts_of(place, docs, end - begin)
                    yield pa.RecordBatch.from_arrays([pa.array(known[place]), pa.array(n)], ["key", "n"])

        def found_among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, total = _Sorted(sent.value), np.zeros(len(sent.value), dtype=np.int64)
            for batch in batches:
                for begin, end, parts, _ in _piecewise(batch.column("text"), restorer.value):
                    place, n = _texts_of(*asked.within(parts), end - begin)
                    total[place] += n
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(asked.keys[place]), pa.array(total[place])], ["key", "n"])

        pairs = some.select("text").mapInArrow(found if among is None else found_among, "key bigint, n bigint")
        return pairs.groupBy("key").agg(F.sum("n").alias("n"))

    totals = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_bad, n_good = (int(x or 0) for x in totals)
    if not n_bad or not n_good:
        return ToxicityModel(trigrams, np.empty(0, np.uint64), np.empty(0), np.array([0.0, 0, 0, -1e9]))
    bad = counted(sample.filter("toxic = 1")).filter(f"n >= {_LEAST_TEXTS}").toArrow().sort_by("key")
    keys, bad = bad.column("key").to_numpy(), bad.column("n").to_numpy()
    good = np.zeros(len(keys), dtype=np.int64)
    if len(keys):
        others = counted(sample.filter("toxic <> 1"), keys).toArrow()
        good[np.searchsorted(keys, others.column("key").to_numpy())] = others.column("n").to_numpy()
    keys, weights = _weights(keys, bad, good, n_bad, n_good)
    model = ToxicityModel(trigrams, keys, weights, np.zeros(4))
    sent = spark.sparkContext.broadcast(model)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(x) for x in evidence(sent.value, batch.column("text"), restorer.value).T]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], ["a", "b", "c", "toxic"])

    model.logistic = _logistic(stage(sample.mapInArrow(described, "a double, b double, c double, toxic int"), "toxic-medidas"))
    return model


def _texts_of(place: np.ndarray, docs: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places, sorted, and in how many texts each is."""
    once = np.sort(place * n_texts + docs)
    place = once[np.append(True, once[1:] != once[:-1])[: len(once)]] // n_texts
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
    return place[new], np.diff(np.append(new, len(place)))


def _weights(keys: np.ndarray, bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys with positive evidence, sorted, and their cautious log ratios."""
    low = np.maximum(bad - 1.64 * np.sqrt(bad), 1e-9) / n_bad
    high = (good + 1.64 * np.sqrt(good) + 2) / n_good
    weight = np.log(low / high)
    keep = weight > 0.5
    keys = keys.view(np.uint64)[keep]
    order = np.argsort(keys)
    return keys[order], weight[keep][order]


def evidence(model: ToxicityModel, texts: pa.Array, restorer: _Restorer | None = None) -> np.ndarray:
    """Per text: the strongest piece of evidence, the log of the sum, the sum per word."""
    out = np.zeros((len(texts), 3))
    if not len(model.keys):
        return out
    restorer = restorer or _Restorer(model.trigrams)
    for begin, end, parts, per_doc in _piecewise(texts, restorer):
        place, doc = model.known.within(parts)
        weight = model.weights[place]
        most = np.zeros(end - begin)
        np.maximum.at(most, doc, weight)
        total = np.bincount(doc, weights=weight, minlength=end - begin)
        out[begin:end] = np.stack([most, np.log1p(total), total / np.maximum(per_doc, 20)], axis=1)
    return out


def _logistic(described: DataFrame) -> np.ndarray:
    """Weights and bias by Newton steps on the penalised likelihood; each step's sums come from all rows."""
    z = [F.col("a"), F.col("b"), F.col("c"), F.lit(1.0)]
    w, n = np.zeros(4), described.count()
    penalty = np.diag([1e-2, 1e-2, 1e-2, 1e-4]) * n**0.5
    pairs = [(i, j) for i in range(4) for j in range(i + 1)]
    for _ in range(25):
        linear = sum((x * float(one) for x, one in zip(z[1:], w[1:], strict=True)), z[0] * float(w[0]))
        clipped = F.least(F.greatest(linear, F.lit(-30.0)), F.lit(30.0))
        with_p = described.withColumn("p", 1 / (1 + F.exp(-clipped)))
        off, bends = F.col("p") - F.col("toxic"), F.col("p") * (1 - F.col("p"))
        first = [F.sum(x * off).alias(f"s{i}") for i, x in enumerate(z)]
        sums = with_p.agg(*first, *[F.sum(z[i] * z[j] * bends).alias(f"h{i}{j}") for i, j in pairs]).first()
        slope = np.array([sums[f"s{i}"] for i in range(4)]) + penalty @ w
        bend = penalty.copy()
        for i, j in pairs:
            bend[i, j] += sums[f"h{i}{j}"]
            bend[j, i] = bend[i, j]
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-10:
            break
    return w


class ToxicityColumn:
    """Turns a text column into its score, the probability of being toxic."""

    def __init__(self, model: ToxicityModel, spark):
        self.model = spark.sparkContext.broadcast(model)
        self.restorer = spark.sparkContext.broadcast(_Restorer(model.trigrams))

    def __call__(self, text: Column) -> Column:
        model, restorer = self.model, self.restorer

        @F.arrow_udf("double")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                x = evidence(model.value, texts, restorer.value)
                linear = x @ model.value.logistic[:3] + model.value.logistic[3]
                yield pa.array(np.where(linear < -1e6, 0.0, 1 / (1 + np.exp(-np.clip(linear, -30, 30)))))

        return score(text)
