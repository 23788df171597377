"""N-gram Jaccard join with prefix filters under several token orders.

A document's set holds its distinct shingles of ``k`` words (lower-cased A-Z, split
at ASCII white space); with fewer words it holds the whole sequence, without any it
is empty and linked with nothing. Two documents link when their sets' Jaccard
similarity is at least ``least`` hundredths.

Documents with equal sets form one class, and only classes are compared. Shingles
are ordered rarest first; of linked sets, the first n - ceil(least * n) + 1 shingles
of each (its prefix) share one, whatever the order. A shingle that occurs in one
class only can't be shared, so a class whose prefix is filled with those is done.
For the others, a pair is a candidate if its prefixes share a shingle in the first
order, and then also in each of two further
orders; only then are the whole sets intersected. Where all shingles that two
prefixes share are known, their number counts: of the two prefixes, the one that
ends first in the order meets the other's set nowhere else, so what it lacks of the
needed overlap must come from the shared ones; and from the first shared one on,
both must have enough shingles left. A bitmap of each set bounds from below by how
many shingles two sets differ, and drops most other pairs where they meet.

Large groups do not produce all their pairs. In two rounds each shingle's classes
are only compared with one of them, first the one with fewest shingles of its own,
then one drawn by hash; the links found join most of a group. Then all remaining
pairs of different components are compared, so no component is cut or merged
wrongly.

How many classes hold a shingle is counted over all of them: groups of texts send
their distinct shingles, each once with its number, to the task that owns a range
of shingles, and get back those that occur elsewhere too.

Rows are told apart by id and text. Null text counts as empty. A row without id
takes part in links; its component has the smallest id among the others, null if
all are null. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import words as W
from balcao.llm.components import components
from balcao.llm.packing import pack, unpack
from balcao.sources.scratch import stage

WORDS, LEAST = 5, 80
STAR_ROUNDS = 2
GROUP_BYTES = 6 << 20
OWNED_SHINGLES = 2_000_000
_SPARE_BITS = 14
#: Bits of a set's parity bitmap: sets differ in at least as many shingles as their bitmaps in bits.
BITS = 1024

_RIGHT = "grp int, key_1 bigint, key_2 bigint, shingles binary, holders binary"


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        F.xxhash64(F.lit(1), "doc_id", "text").alias("key_1"),
        F.xxhash64(F.lit(2), "doc_id", "text").alias("key_2"),
        "text",
    )


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, distinct shingles text by text, number in each)."""
    for begin, end, raw, offsets in W.pieces(texts):
        values, count = W.shingles(W.cut(raw, offsets, W.NON_SPACE), k)
        yield begin, end, *W.distinct_per_doc(values, count)


def shapes(keyed: DataFrame, k: int) -> DataFrame:
    """(doc_id, keys, bytes, n, node): set size and a 128-bit name of the set; null for an empty one."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            n, names = np.zeros(len(texts), np.int32), []
            for begin, end, values, count in _sets(texts, k):
                n[begin:end] = count
                one = W.add_per_doc(W.mix(values + np.uint64(1)), count)
                two = W.add_per_doc(W.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), count)
                name = np.stack([one, two], axis=1).astype(">u8").tobytes()
                names += [name[i * 16 : i * 16 + 16] if c else None for i, c in enumerate(count)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key_1"), batch.column("key_2"), batch.column("size"), pa.array(n), pa.array(names, pa.binary())],
                ["doc_id", "key_1", "key_2", "size", "n", "node"],
            )

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0))).mapInArrow(
        measured, f"doc_id {kind}, key_1 bigint, key_2 bigint, size int, n int, node binary"
    )


def _chosen_texts(texts: pa.Table, rows: pa.Table) -> pa.Array:
    """One text of each class that this group of texts represents, in a fixed order."""
    wanted = set(zip(rows.column("key_1").to_pylist(), rows.column("key_2").to_pylist(), strict=True))
    at: dict[tuple[int, int], int] = {}
    for i, key in enumerate(zip(texts.column("key_1").to_pylist(), texts.column("key_2").to_pylist(), strict=True)):
        if key in wanted:
            at.setdefault(key, i)
    return texts.column("text").take(pa.array([at[key] for key in sorted(at)], pa.int64()))


def _asked(k: int, shift: int, owners: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a group of texts sends to each owner of a range: its shingles and in how many classes they are."""

    def ask(texts: pa.Table, rows: pa.Table) -> pa.Table:
        found = [values >> np.uint64(shift) for _, _, values, _ in _sets(_chosen_texts(texts, rows), k)]
        out: dict[str, list] = {"owner": [], "grp": [], "shingles": [], "holders": []}
        if found:
            values, count = np.unique(np.concatenate(found), return_counts=True)
            owner = _owner_of(values, shift, owners)
            ends = np.searchsorted(owner, np.arange(owners + 1))
            for i in np.flatnonzero(np.diff(ends)):
                part = slice(ends[i], ends[i + 1])
                out["owner"].append(int(i))
                out["grp"].append(rows.column("grp")[0].as_py())
                out["shingles"].append(pack(values[part]))
                out["holders"].append(pack(np.cumsum(count[part])))
        types = [("owner", pa.int32()), ("grp", pa.int32()), ("shingles", pa.binary()), ("holders", pa.binary())]
        return pa.table({name: pa.array(out[name], kind) for name, kind in types})

    return ask


def _owner_of(values: np.ndarray, shift: int, owners: int) -> np.ndarray:
    """Ranges of equal width over the shortened hashes."""
    return (values.astype(np.float64) / 2.0 ** (64 - shift) * owners).astype(np.int64)


def _answered(asked: pa.Table) -> pa.Table:
    """For each group, its shingles that more than one class holds, with how many do."""
    groups = asked.column("grp").to_pylist()
    parts = [unpack(x) for x in asked.column("shingles").to_pylist()]
    counts = [np.diff(unpack(x), prepend=np.uint64(0)) for x in asked.column("holders").to_pylist()]
    every, own = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(own, weights=np.concatenate(counts), minlength=len(every)).astype(np.uint64)
    shingles, holders, at = [], [], 0
    for part in parts:
        held = total[own[at : at + len(part)]]
        at += len(part)
        shared = held > 1
        shingles.append(pack(part[shared]))
        holders.append(pack(np.cumsum(held[shared])))
    empty = pa.nulls(len(groups), pa.int64())
    return pa.table(
        {
            "grp": pa.array(groups, pa.int32()),
            "key_1": empty,
            "key_2": empty,
            "shingles": pa.array(shingles, pa.binary()),
            "holders": pa.array(holders, pa.binary()),
        }
    )


def _bits(tokens: np.ndarray) -> np.ndarray:
    """For each of ``BITS`` values, whether an odd number of the shingles hash to it."""
    odd = np.bincount((tokens % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _orders(tokens: np.ndarray, held: np.ndarray) -> list[np.ndarray]:
    """Positions of a set's shared shingles under three global orders, rarest first."""
    level = np.frexp(held.astype(np.float64))[1]
    return [
        np.lexsort((tokens.view(np.int64), held)),
        np.lexsort((W.mix(tokens + np.uint64(0x51)), level)),
        np.lexsort((W.mix(tokens ^ np.uint64(0x9D5F3C1B2A7E6480)), level)),
    ]


_OPEN = "node binary, n int, single int, held bigint, tokens array<bigint>, bits array<bigint>, first array<bigint>, second array<bigint>, third array<bigint>"


def _opened(k: int, shift: int, least: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Classes whose prefix reaches shared shingles: their sets and prefixes."""

    def finish(texts: pa.Table, rows: pa.Table) -> pa.Table:
        answers = [unpack(x) for x in rows.column("shingles").to_pylist() if x]
        counts = [np.diff(unpack(x), prepend=np.uint64(0)) for x in rows.column("holders").to_pylist() if x]
        known = np.concatenate(answers) if answers else np.empty(0, np.uint64)
        held = np.concatenate(counts) if counts else np.empty(0, np.uint64)
        order = np.argsort(known)
        known, held = known[order], held[order]
        out: dict[str, list] = {name: [] for name in ("node", "n", "single", "held", "tokens", "bits", "first", "second", "third")}
        sets = _sets(_chosen_texts(texts, rows.filter(pa.compute.is_valid(rows.column("key_1")))), k)
        for _, _, values, count in sets:
            if not len(known):
                continue
            short = values >> np.uint64(shift)
            at = np.minimum(np.searchsorted(known, short), len(known) - 1)
            holders = np.where(known[at] == short, held[at], np.uint64(1))
            ends = np.cumsum(count)
            single = W.add_per_doc((holders == 1).astype(np.int64), count)
            prefix = count + (-least * count) // 100 + 1
            for i in np.flatnonzero(single < prefix):
                own = values[ends[i] - count[i] : ends[i]]
                mine = holders[ends[i] - count[i] : ends[i]]
                shared, theirs = own[mine > 1], mine[mine > 1]
                one = W.mix(own + np.uint64(1)).sum(dtype=np.uint64)
                two = W.mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
                out["node"].append(np.array([one, two]).astype(">u8").tobytes())
                out["n"].append(int(count[i]))
                out["single"].append(int(single[i]))
                out["tokens"].append(own.view(np.int64))
                out["bits"].append(_bits(own))
                orders = _orders(shared, theirs)
                out["held"].append(int(theirs[orders[0][prefix[i] - single[i] - 1]]))
                for name, order in zip(("first", "second", "third"), orders, strict=True):
                    out[name].append(shared[order[: prefix[i] - single[i]]].view(np.int64))
        lists = pa.list_(pa.int64())
        types = {"node": pa.binary(), "n": pa.int32(), "single": pa.int32(), "held": pa.int64()}
        return pa.table({name: pa.array(rows, types.get(name, lists)) for name, rows in out.items()})

    return finish


def open_classes(keyed: DataFrame, known: DataFrame, k: int, least: int) -> DataFrame:
    """Classes that may have a partner, from all texts and their (staged) shapes."""
    one = known.filter("n > 0").groupBy("node").agg(
        F.min(F.struct("key_1", "key_2")).alias("key"), F.first("n").alias("n")
    )
    size, total = known.agg(F.sum("size"), F.sum("n")).first()
    groups = max(1, -(-int(size or 0) // GROUP_BYTES))
    owners = max(1, -(-int(total or 0) // OWNED_SHINGLES))
    shift = max(0, 64 - int(total or 1).bit_length() - _SPARE_BITS)

    def group(key: Column) -> Column:
        return F.pmod(key, groups).cast("int").alias("grp")

    texts = keyed.select(group(F.col("key_1")), "key_1", "key_2", "text").groupBy("grp")
    chosen = one.select(group(F.col("key.key_1")), "key.key_1", "key.key_2")
    asked = texts.cogroup(chosen.groupBy("grp")).applyInArrow(
        _asked(k, shift, owners), "owner int, grp int, shingles binary, holders binary"
    )
    answers = asked.groupBy("owner").applyInArrow(_answered, _RIGHT)
    empty = F.lit(None).cast("binary")
    rows = chosen.select("*", empty.alias("shingles"), empty.alias("holders")).unionByName(answers)
    return texts.cogroup(rows.groupBy("grp")).applyInArrow(_opened(k, shift, least), _OPEN)


def _checked(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) that link: prefixes meet in the other orders too, then whole sets."""

    def side(name: str, *columns: str) -> DataFrame:
        return classes.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    filters = ("second", "third")
    near = (
        pairs.join(side("a", *filters), "a")
        .join(side("b", *filters), "b")
        .filter(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
        .select("a", "b")
    )
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        near.join(side("a", "tokens", "n"), "a")
        .join(side("b", "tokens", "n"), "b")
        .withColumn("common", common)
        .filter(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * least)
        .select("a", "b")
    )


def _sizes_fit(least: int) -> Column:
    return F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * least


def _bits_near(least: int) -> Column:
    """Whether the bitmaps leave room for a link, which allows only so many differing shingles."""
    differ = sum(
        F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("other_bits", F.lit(i)))) for i in range(BITS // 64)
    )
    return differ * (100 + least) <= (F.col("n") + F.col("other_n")) * (100 - least)


def _room(least: int) -> Column:
    """Whether enough shingles are left from where the prefixes meet; true where they meet first, if they link."""
    room = F.least(F.col("n") - F.col("at"), F.col("other_n") - F.col("other_at"))
    return room * (100 + least) >= (F.col("n") + F.col("other_n")) * least


def _up(numerator: Column, denominator: int) -> Column:
    """Whole division, rounded up."""
    return F.floor((numerator + (denominator - 1)) / denominator)


def _enough(least: int) -> Column:
    """How many shingles the two prefixes must share, if all that they share are counted."""
    ends_first = F.when(F.col("last") <= F.col("other_last"), F.col("n")).otherwise(F.col("other_n"))
    needed = _up((F.col("n") + F.col("other_n")) * least, 100 + least)
    return needed - _up(ends_first * least, 100) + 1


def _draw(k: int) -> list[Column]:
    """What decides, smallest first, which class leads a shingle's others in a round."""
    by_hash = F.xxhash64(F.lit(k), "node").alias("draw")
    return [by_hash] if k else [F.col("single").alias("own"), by_hash]


def links(classes: DataFrame, least: int) -> DataFrame:
    """(node, component) of the classes that may link with others."""
    ends = F.struct("held", F.element_at("first", -1).alias("token")).alias("last")
    places = classes.select("node", "n", "single", "bits", ends, F.posexplode("first").alias("at", "token"))
    places = stage(places.select("token", "node", "n", "single", "last", "bits", (F.col("at") + F.col("single")).alias("at")), "prefixos")
    labels = classes.select("node", F.col("node").alias("component"))
    own_columns = ("node", "n", "at", "component", "last", "bits")
    for k in range(STAR_ROUNDS + 1):
        own = places.join(labels, "node")
        mixed = own.groupBy("token").agg(
            F.min(F.struct(*_draw(k), *own_columns)).alias("lead"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        mixed = mixed.filter(F.col("low") != F.col("high"))
        if k < STAR_ROUNDS:
            other = mixed.select("token", *[F.col(f"lead.{c}").alias(f"other_{c}") for c in own_columns])
        else:
            other = own.join(mixed.select("token"), "token", "left_semi").select(
                "token", *[F.col(c).alias(f"other_{c}") for c in own_columns]
            )
        apart = (F.col("component") != F.col("other_component")) & _sizes_fit(least) & _bits_near(least)
        if k == STAR_ROUNDS:
            apart = apart & (F.col("node") < F.col("other_node"))
        met = own.join(other, "token").filter(apart)
        if k == STAR_ROUNDS:
            counted = met.groupBy("node", "other_node").agg(
                F.count(F.lit(1)).alias("shared"),
                F.max(_enough(least)).alias("enough"),
                F.bool_or(_room(least)).alias("room"),
            )
            met = counted.filter((F.col("shared") >= F.col("enough")) & F.col("room"))
        pairs = met.select(
            F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")
        ).distinct()
        new = stage(_checked(stage(pairs, "pares"), classes, least), "ligas")
        labels = stage(_merged(labels, new), "grupos")
    return labels


def _merged(labels: DataFrame, new: DataFrame) -> DataFrame:
    """Labels (node, component) after further edges (a, b), which meet as edges between components."""
    one = labels.select(F.col("node").alias("a"), F.col("component").alias("one"))
    two = labels.select(F.col("node").alias("b"), F.col("component").alias("two"))
    between = new.join(one, "a").join(two, "b").filter(F.col("one") != F.col("two"))
    ordered = between.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")).distinct()
    found = components(ordered).select(F.col("node").alias("component"), F.col("component").alias("above"))
    return labels.join(found, "component", "left").select("node", F.coalesce("above", "component").alias("component"))


def linked(documents: DataFrame, k: int = WORDS, least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and the keys that tell rows apart."""
    keyed = _keyed(documents.select("doc_id", "text"))
    known = stage(shapes(keyed, k), "formas")
    classes = stage(open_classes(keyed, known, k, least), "classes")
    found = links(classes, least)
    ids = known.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least_id"))
    placed = ids.join(found, "node", "left").select(
        "node", "least_id", F.coalesce("component", "node").alias("component")
    )
    placed = stage(placed, "membros")
    least_of = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_node = placed.join(least_of, "component").select("node", "component_id")
    return known.join(of_node, "node", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "key_1",
        "key_2",
    )


def deduplicated(documents: DataFrame, k: int = WORDS, least: int = LEAST) -> DataFrame:
    """One document of each group stays, the one with the smallest id, with all its columns.

    Rows without id stay only if no row of their group has one, then all do. Of rows
    with the group's smallest id, all that are equal in id and text stay as one.
    """
    marks = linked(documents, k, least).filter("component_id is null or doc_id = component_id")
    kept = stage(marks.select("key_1", "key_2").distinct(), "ficam")
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    keyed = documents.select(
        row, F.xxhash64(F.lit(1), "doc_id", "text").alias("key_1"), F.xxhash64(F.lit(2), "doc_id", "text").alias("key_2")
    )
    return keyed.join(kept, ["key_1", "key_2"]).dropDuplicates(["key_1", "key_2"]).select("row.*")
