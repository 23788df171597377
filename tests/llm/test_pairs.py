"""Jaccard join and decontamination against brute force, components, and awkward rows."""

import collections
import random

import pytest
from conftest_llm import OTHER, PLAIN, documents

from balcao.llm import decontaminate, jaccard
from balcao.llm.components import components
from balcao.sources.scratch import stage

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def word_set(text, k):
    words = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute_components(rows, k, least):
    sets = [(doc_id, word_set(text, k)) for doc_id, text in rows]
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= least * len(a | b):
                label[find(i)] = find(j)
    least_id = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least_id[find(i)] = min(least_id.get(find(i), doc_id), doc_id)
    return collections.Counter(
        (doc_id, len(s), least_id.get(find(i)) if s else doc_id) for i, (doc_id, s) in enumerate(sets)
    )


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at] = rng.choice(["new", "other", words[at].upper(), str(rng.random())])
    return " ".join(words)


@pytest.mark.parametrize("k, least", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, least):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows = []
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 6, 20, 80, 150]))
        for copy in range(rng.choice([1, 2, 9])):
            text = edited(rng, base, copy)
            rows.append((len(rows), text + (f" {passage}" if group % 3 == 0 else "")))
    base = rng.choices(vocabulary, k=120)
    rows += [(len(rows) + i, edited(rng, base, i % 5)) for i in range(60)]
    rows += [(1000, rows[0][1]), (0, rows[0][1]), (None, rows[5][1]), (None, "all alone here"), (1001, None), (1002, " ")]
    found = jaccard.linked(documents(spark, rows), k, least).select("doc_id", "n_shingles", "component_id")
    assert collections.Counter(map(tuple, found.collect())) == brute_components(rows, k, least)


def test_links_of_awkward_rows(spark, awkward, nothing):
    assert jaccard.linked(nothing).count() == 0
    assert jaccard.deduplicated(nothing).columns == nothing.columns
    found = {(r.doc_id, r.component_id) for r in jaccard.linked(awkward).collect()}
    assert {(1, 1), (6, 1), (None, 1), (7, 7), (2, 2), (None, None)} <= found
    kept = jaccard.deduplicated(awkward)
    assert kept.columns == awkward.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(
        [1, 2, 3, 4, 5, 7, 9, 10, 11, None]  # 8 repeats the words of 1
    )


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(30)]
    found = components(spark.createDataFrame(chain + star, "a int, b int")).collect()
    assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(31)}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


ITEMS = [
    (1, "the first question asks how many red apples fit in a wooden box that is half full of green pears"),
    (2, "short one here"),
    (3, None),
    (4, "  "),
    (5, "the first question asks how many red apples fit in a wooden box that is half full of green pears"),
    (None, "an item without any number but with a good number of rather unusual words in its only sentence"),
]


def brute_matches(rows, items):
    """Every (document, item) with a window of the item's length at similarity 0.8 or more."""
    import regex

    split = lambda text: regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    found = set()
    for doc_id, text in rows:
        words = split(text)
        for item_id, item in items:
            want = split(item)
            if not want or not words:
                continue
            k = min(5, len(want))
            runs = lambda w: collections.Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
            own, width = runs(want), min(len(want), len(words))
            for begin in range(len(words) - width + 1):
                seen = runs(words[begin : begin + width])
                shared = sum((own & seen).values())
                if shared and 2 * shared >= 0.8 * (sum(own.values()) + sum(seen.values())):
                    found.add((doc_id, item_id))
    return found


def test_matches_equal_brute_force(spark):
    first = ITEMS[0][1]
    rows = [
        (1, f"{PLAIN} {first} {OTHER}"),
        (2, first.upper().replace(" ", ",  ")),
        (3, first.replace("wooden", "metal")),
        (4, " ".join(first.split()[:9])),
        (5, " ".join(first.split()[:17])),
        (6, f"{PLAIN} it has a short one here. {OTHER}"),
        (7, PLAIN),
        (8, None),
        (9, ""),
        (None, f"x {ITEMS[5][1]} y"),
        (10, f"{first} {first} {first}"),
        (10, f"{first} {first} {first}"),
        (11, first.replace("question", "riddle").replace("green", "ripe")),
    ]
    benchmark = spark.createDataFrame([(*item, "x") for item in ITEMS], "item_id bigint, text string, length string")
    found = decontaminate.matches(documents(spark, rows), benchmark)
    got = [(r.doc_id, r.item_id) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_matches(rows, ITEMS)
    kept = decontaminate.decontaminated(documents(spark, rows), benchmark)
    left = {r.doc_id for r in kept.collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got}


def test_rows_without_id_and_of_shared_ids_are_judged_by_their_text(spark):
    item = ITEMS[0][1]
    rows = [(None, item), (None, PLAIN), (5, item), (5, PLAIN), (6, OTHER)]
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontaminate.decontaminated(documents(spark, rows), benchmark)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([rows[1], rows[3], rows[4]], key=repr)


def test_matches_of_reordered_items_equal_brute_force(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    items = [(1, f"{one} {two}"), (2, f"{one} {two}"), (3, "x y x y x y x y x y x y")]
    rows = [(1, f"{PLAIN} {two} {one} {OTHER}"), (2, f"{two} {one}"), (3, f"{PLAIN} {two} {PLAIN} {one}"), (4, "y x " * 9)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.matches(documents(spark, rows), benchmark)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == brute_matches(rows, items) and {(1, 1), (1, 2), (2, 1), (4, 3)} <= got


def altered_items(rng, lengths, count, copies):
    """Items of so many words, and texts that hold them with words changed or cut."""
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate(n for n in lengths for _ in range(count))]
    rows = []
    for i, item in items:
        for copy in range(copies):
            words = item.split()
            n = len(words)
            for _ in range(rng.randint(0, max(1, n // 25))):
                words[rng.choice([rng.randrange(n), rng.randrange(min(n, 3)), -1])] = word()
            words = words[rng.choice([0, 0, n // 20, n // 10]) :]
            rows.append((i * 10 + copy, " ".join([word() for _ in range(9)] + words + [word() for _ in range(9)])))
    return items, rows


def test_matches_by_item_length_equal_brute_force(spark):
    """No match above the similarity lies beyond the radius of the fingerprints, short items included."""
    items, rows = altered_items(random.Random(5), [3, 6, 9, 14, 20, 30, 60], count=5, copies=3)
    found = decontaminate.matches(documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    got, want = {(r.doc_id, r.item_id) for r in found.collect()}, brute_matches(rows, items)
    assert got == want
    lengths = dict((i, len(t.split())) for i, t in items)
    assert {lengths[i] for _, i in want} == {3, 6, 9, 14, 20, 30, 60}


def test_unrelated_windows_and_items_do_not_meet(spark):
    """Windows are looked up under the items that opened them: pairs that meet grow with matches, not with the product."""
    items, rows = altered_items(random.Random(1), [30], count=60, copies=4)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    benchmark = decontaminate.with_form(stage(decontaminate.items_of(benchmark), "itens"))
    anchors = stage(decontaminate._anchors(benchmark, 0.8), "ancoras")
    spots = decontaminate._windows(decontaminate._keyed(documents(spark, rows)), benchmark, anchors, 0.8)
    opened = spots.select("key_1", "key_2", "form").distinct().count()
    assert 0 < opened <= 0.05 * len(rows) * len(items)


def test_only_small_sides_are_sent(spark, monkeypatch):
    """The size counts what arrays hold, not rows alone."""
    side = spark.createDataFrame([(1, [(1, 2)] * 50), (2, None)], "a bigint, b array<struct<x: int, y: int>>")
    for limit, sent in ((104, True), (103, False)):  # 2 rows, 2 array sizes, 100 numbers
        monkeypatch.setattr(decontaminate, "BROADCAST_NUMBERS", limit)
        plan = decontaminate._sent(side)._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan) == sent


def test_matches_of_awkward_rows(spark, awkward, nothing):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    empty = benchmark.limit(0)
    for documents_, items in ((nothing, benchmark), (awkward, empty), (nothing, empty)):
        found = decontaminate.matches(documents_, items)
        assert found.columns == ["doc_id", "item_id", "first_word", "n_words", "similarity", "distance"]
        assert found.count() == 0
    assert decontaminate.matches(awkward, benchmark).count() == 0
    assert decontaminate.decontaminated(awkward, benchmark).count() == awkward.count()


def test_the_multi_index_holds_every_value_within_the_radius():
    near = set(decontaminate._near_values())
    blocks = decontaminate._BLOCKS
    assert blocks * (decontaminate._FLIPS + 1) - 1 == decontaminate.RADIUS
    assert blocks * decontaminate._BLOCK_BITS == 64
    assert near == {x for x in range(256) if bin(x).count("1") <= decontaminate._FLIPS}


def test_native_plans_hold_no_python(spark, awkward):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    plan = decontaminate.matches(awkward, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
