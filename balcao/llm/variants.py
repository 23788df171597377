"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has 64 bits, one set where over half of the text's shingle
hashes have it set. Two fingerprints link when at most ``RADIUS`` = 2 bits differ.
Cut into ``SEGMENTS`` = 2 halves of 32 bits, two linked fingerprints differ by one
bit at most in one of the halves. So every half is indexed 32 times, each time
with one of its bits struck out, and linked fingerprints share at least one of
these variants: an equality join on the variants finds them, and the count of
differing bits verifies them.

* Copies collapse first: everything after the fingerprints works on distinct ones.
* A variant that more than ``CROWD`` fingerprints share is not joined, as its pairs
  grow with the square of their number. Its fingerprints are linked exactly in
  another way: each is indexed by itself and by its 64 neighbours of one flipped bit.
  Two fingerprints within two bits share one of these 65 keys, and all that share a
  key are within two bits of each other, at most 65 of them; so each key links its
  smallest fingerprint to the others, and no pairs are formed.
* Components are found on fingerprints and named by the smallest id at last.

Defined cases. Null and empty texts, and texts of white space, have fingerprint zero
and link like any other. A text of fewer than three words is one shingle. Rows
without id take part; a component whose rows all lack an id has a null component id.
Repeated rows are each returned. No rows give no rows. Columns other than doc_id and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm.components import components
from balcao.llm.words import LOWER, NON_SPACE, pieces, runs
from balcao.sources.scratch import stage

WORDS = 3
BITS = 64
RADIUS = 2
SEGMENTS = 2
SEED = 42
#: Fingerprints that may share a variant and still be joined pair by pair.
CROWD = 16

_WIDTH = BITS // SEGMENTS
_U = np.uint64
_P1, _P2, _P3, _P4, _P5 = (
    _U(p)
    for p in (
        0x9E3779B185EBCA87,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)
#: Shingles hashed at a time; below 2 ** 16, so that four 16-bit counters fit a word.
_AT_ONCE = 65_535
#: Longer shingles are hashed one by one.
_LONG = 512


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def _round(state: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _rotated(state + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of the slices of a byte buffer, all slices side by side."""
    if not len(begin):
        return np.empty(0, _U)
    low = int(begin.min())
    data, begin = data[low : int((begin + size).max())], begin - low
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    four = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    with np.errstate(over="ignore"):
        first = _U(seed)
        out = np.full(len(begin), first + _P5, _U)
        at = begin.astype(np.int64)
        end = at + size
        wide = np.flatnonzero((size >= 32) & (size <= _LONG))
        if len(wide):
            lanes = [np.full(len(wide), start, _U) for start in (first + _P1 + _P2, first + _P2, first, first - _P1)]
            here, stop = at[wide], end[wide]
            live = np.arange(len(wide))
            while len(live):
                for j in range(4):
                    lanes[j][live] = _round(lanes[j][live], eight[here[live] + 8 * j])
                here[live] += 32
                live = live[here[live] + 32 <= stop[live]]
            joined = sum(_rotated(lane, by) for lane, by in zip(lanes, (1, 7, 12, 18), strict=True))
            for lane in lanes:
                joined = (joined ^ _round(_U(0), lane)) * _P1 + _P4
            out[wide], at[wide] = joined, here
        out += size.astype(_U)
        at[size > _LONG] = end[size > _LONG]
        live = np.flatnonzero(at + 8 <= end)
        while len(live):
            out[live] = _rotated(out[live] ^ _round(_U(0), eight[at[live]]), 27) * _P1 + _P4
            at[live] += 8
            live = live[at[live] + 8 <= end[live]]
        live = np.flatnonzero(at + 4 <= end)
        out[live] = _rotated(out[live] ^ four[at[live]].astype(_U) * _P1, 23) * _P2 + _P3
        at[live] += 4
        live = np.flatnonzero(at < end)
        while len(live):
            out[live] = _rotated(out[live] ^ padded[at[live]].astype(_U) * _P5, 11) * _P1
            at[live] += 1
            live = live[at[live] < end[live]]
        out ^= out >> _U(33)
        out *= _P2
        out ^= out >> _U(29)
        out *= _P3
        out ^= out >> _U(32)
    for i in np.flatnonzero(size > _LONG):
        out[i] = xxhash.xxh64_intdigest(data[begin[i] : begin[i] + size[i]].tobytes(), seed=seed)
    return out


def _marks(raw: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Fingerprint of each text of a piece."""
    low = LOWER[raw]
    inside = NON_SPACE[low]
    doc_start, _, lengths = runs(low, offsets, inside)
    letters = low[inside]
    # Words one after the other, each followed by a space: a shingle is one slice.
    word = np.repeat(np.arange(len(lengths)), lengths)
    spaced = np.full(len(letters) + len(lengths), 32, np.uint8)
    spaced[np.arange(len(letters)) + word] = letters
    end = np.cumsum(lengths + 1) - 1
    per_doc = np.diff(doc_start)
    count = np.where(per_doc == 0, 0, np.maximum(1, per_doc - k + 1))
    doc = np.repeat(np.arange(len(count)), count)
    first = doc_start[:-1][doc] + np.arange(len(doc)) - (np.cumsum(count) - count)[doc]
    last = first + np.minimum(per_doc, k)[doc] - 1
    begin = (end - lengths)[first]
    ones = np.zeros((len(count), BITS), np.int64)
    for start in range(0, len(doc), _AT_ONCE):
        some = slice(start, start + _AT_ONCE)
        hashes = xxh64(spaced, begin[some], end[last[some]] - begin[some])
        edges = np.flatnonzero(np.diff(doc[some], prepend=-1))
        for bit in range(16):
            lanes = np.add.reduceat((hashes >> _U(bit)) & _U(0x0001000100010001), edges)
            for lane in range(4):
                ones[doc[some][edges], bit + 16 * lane] += ((lanes >> _U(16 * lane)) & _U(0xFFFF)).astype(np.int64)
    over = ones * 2 > count[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<i8").reshape(-1)


def mark(text: Column, k: int = WORDS) -> Column:
    """The 64-bit fingerprint of a text, as a signed number."""

    @F.arrow_udf("bigint")
    def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [_marks(raw, offsets, k) for _, _, raw, offsets in pieces(texts)]
            yield pa.array(np.concatenate(found) if found else np.empty(0, np.int64))

    return marked(text)


def signatures(marks: DataFrame) -> DataFrame:
    """(variant, mark): every half of every fingerprint, each with one of its bits struck out.

    A variant's upper part tells which half and which bit, its lower part the other bits.
    """
    one = marks.select("mark", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    half = F.col("mark").bitwiseAND(F.lit((1 << _WIDTH) - 1))
    upper = F.shiftrightunsigned("mark", _WIDTH)
    segment = F.when(F.col("bit") < _WIDTH, half).otherwise(upper)
    struck = segment.bitwiseAND(F.bitwise_not(F.expr(f"shiftleft(1L, bit % {_WIDTH})")))
    return one.select(F.expr(f"shiftleft(bigint(bit), {_WIDTH})").bitwiseOR(struck).alias("variant"), "mark")


def _flips(marks: DataFrame) -> DataFrame:
    """Links (a, b) among fingerprints by shared neighbours of one flipped bit."""
    bits = F.explode(F.sequence(F.lit(-1), F.lit(BITS - 1))).alias("bit")
    flipped = F.expr("if(bit < 0, mark, mark ^ shiftleft(1L, bit))").alias("spot")
    spots = marks.select("mark", bits).select("mark", flipped)
    least = spots.groupBy("spot").agg(F.min("mark").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return spots.join(least, "spot").filter("mark <> a").select("a", F.col("mark").alias("b"))


def links(marks: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b), a < b, that connect all distinct fingerprints within two bits of each other.

    Not every linked pair of a crowded variant is returned, but its members are connected.
    """
    every = signatures(marks)
    shared = stage(every.groupBy("variant").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "variantes")
    # Both sides grow with the corpus, so neither is ever broadcast; a hot variant is split at run time.
    members = stage(every.join(shared.hint("merge"), "variant"), "portadores")
    few = members.filter(F.col("n") <= crowd).select("variant", "mark")
    pairs = few.select("variant", F.col("mark").alias("a")).join(few.withColumnRenamed("mark", "b"), "variant")
    near = pairs.filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS))
    crowded = members.filter(F.col("n") > crowd).select("mark").distinct()
    return near.select("a", "b").unionByName(_flips(crowded)).distinct()


def linked(documents: DataFrame, k: int = WORDS, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    marks = stage(documents.select("doc_id", mark(F.col("text"), k).alias("mark")), "marcas")
    known = stage(marks.groupBy("mark").agg(F.min("doc_id").alias("least_id")), "distintas")
    found = components(stage(links(known.select("mark"), crowd), "ligas"))
    placed = known.join(found, known["mark"] == found["node"], "left").select(
        "mark", "least_id", F.coalesce("component", "mark").alias("component")
    )
    placed = stage(placed, "membros")
    least_of = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_mark = placed.join(least_of, "component").select("mark", "component_id")
    digits = F.lower(F.lpad(F.hex("mark"), BITS // 4, "0")).alias("fingerprint")
    return marks.join(of_mark, "mark").select("doc_id", digits, "component_id")
