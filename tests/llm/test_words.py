import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from balcao.llm import words as W
from balcao.llm.packing import pack, unpack

PATTERNS = [(W.NON_SPACE, rb"[^\x20\x09-\x0D]+"), (W.ALPHANUMERIC, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB z9\t\n.é日", max_size=30)), max_size=12)
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def split(text, pattern):
    return re.findall(pattern, (text or "").encode().translate(LOWER))


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from(PATTERNS), st.integers(1, 5), st.sampled_from([3, 40, 1 << 20]))
def test_words_and_shingles_equal_a_plain_split(texts, kind, k, size):
    seen, seen_shingles = {}, {}
    for begin, end, raw, offsets in W.pieces(pa.array(texts, pa.string()), size):
        words = W.cut(raw, offsets, kind[0])
        grams, count = W.shingles(words, k)
        ends = np.cumsum(count)
        for i in range(end - begin):
            want = split(texts[begin + i], kind[1])
            own = words.hashes[words.doc_start[i] : words.doc_start[i + 1]]
            assert len(own) == len(want)
            for word, number in zip(want, own, strict=True):
                assert seen.setdefault(word, number) == number
            runs = [tuple(want[j : j + k]) for j in range(max(1, len(want) - k + 1))] if want else []
            mine = grams[ends[i] - count[i] : ends[i]]
            assert len(mine) == len(runs)
            for run, number in zip(runs, mine, strict=True):
                assert seen_shingles.setdefault(run, number) == number
    assert len(set(seen.values())) == len(seen)
    assert len(set(seen_shingles.values())) == len(seen_shingles)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packing_returns_what_went_in(numbers):
    values = np.sort(np.array(numbers, dtype=np.uint64))
    assert np.array_equal(unpack(pack(values)), values)


def test_sums_and_distinct_values_per_text():
    values, count = np.array([3, 1, 3, 2, 2], dtype=np.uint64), np.array([3, 0, 2])
    distinct, number = W.distinct_per_doc(values, count)
    assert distinct.tolist() == [1, 3, 2] and number.tolist() == [2, 0, 1]
    assert W.add_per_doc(values, count).tolist() == [7, 0, 4]
    assert W.add_per_doc(values.astype(float), count).tolist() == [7.0, 0.0, 4.0]


def test_beginnings_are_hashed_like_whole_words():
    raw = np.frombuffer(b"river wide idiot abcde", dtype=np.uint8)
    found = W.beginning_hashes(raw, np.array([0, 6, 11, 17]), 4)
    whole = W.cut(np.frombuffer(b"rive wide idio abcd", dtype=np.uint8), np.array([0, 19]), W.NON_SPACE)
    assert found.tolist() == whole.hashes.tolist()
