"""SimHash links against all pairs, hashes against a library, and awkward rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest_llm import SMALL, documents

from balcao.llm import queries, variants
from balcao.llm.tables import given
from balcao.llm.words import pieces

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute_mark(text, k=3):
    words = (text or "").encode().translate(LOWER).split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    """Component label of each mark by all pairs."""
    label = list(range(len(marks)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    values = np.array(marks, np.uint64)
    for i in range(len(marks)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 2):
            a, b = find(i), find(int(j))
            if a != b:
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(marks))]


def brute_rows(rows):
    marks = [brute_mark(text) for _, text in rows]
    label = brute_components(marks)
    least = {}
    for (doc_id, _), group in zip(rows, label, strict=True):
        if doc_id is not None:
            least[group] = min(least.get(group, doc_id), doc_id)
    return sorted(((r[0], f"{m:016x}", least.get(g)) for r, m, g in zip(rows, marks, label, strict=True)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_hashes_equal_library():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 20_000, dtype=np.uint8)
    size = np.concatenate([np.arange(140), rng.integers(0, 3000, 300)])
    begin = rng.integers(0, len(data) - 3000, len(size))
    want = [xxhash.xxh64_intdigest(data[b : b + s].tobytes(), seed=42) for b, s in zip(begin, size, strict=True)]
    assert variants.xxh64(data, begin, size).tolist() == want


def test_marks_equal_plain_count():
    rng = random.Random(2)
    texts = [None, "", "A", "a b", " x  y\tz q ", "é " * 9, "w" * 3000 + " a b c", "same words here " * 30_000]
    texts += [" ".join(rng.choices(["foo", "Bar", "baz", "QUUX", "ß"], k=rng.randrange(60))) for _ in range(200)]
    got = np.concatenate([variants._marks(raw, offsets, 3) for _, _, raw, offsets in pieces(pa.array(texts))])
    assert got.view(np.uint64).tolist() == [brute_mark(text) for text in texts]


@pytest.mark.parametrize("crowd", [1, 3, variants.CROWD])
def test_links_equal_all_pairs(spark, crowd):
    """Fingerprints in balls, in chains of two-bit steps, and in a crowd that shares one half."""
    rng = random.Random(4)
    marks = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(40):
        here = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            marks.add(here)
            for bit in rng.sample(range(64), rng.choice([1, 2, 3])):
                here ^= 1 << bit
    half = rng.getrandbits(32)
    marks |= {half << 32 | rng.getrandbits(7) << rng.choice([0, 9, 20]) for _ in range(150)}
    marks = sorted(marks)
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks]
    edges = variants.links(spark.createDataFrame(signed, "mark bigint"), crowd).collect()
    place = {m[0]: i for i, m in enumerate(signed)}
    label = list(range(len(marks)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        assert (marks[place[a]] ^ marks[place[b]]).bit_count() <= 2
        one, two = find(place[a]), find(place[b])
        label[max(one, two)] = min(one, two)
    assert [find(i) for i in range(len(marks))] == brute_components(marks)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in given(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert found(queries.op13_simhash(spark, SMALL)) == brute_rows(rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(variants.linked(awkward)) == brute_rows(rows)
    assert variants.linked(nothing).collect() == []
    nameless = documents(spark, [(None, "one two three four"), (None, "one two three four"), (3, "other text")])
    assert {r.component_id for r in variants.linked(nameless).collect()} == {None, 3}
