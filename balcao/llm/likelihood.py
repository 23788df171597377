"""Language-model scores of documents: context-tree weighting, beside a smoothed word count.

A text is scored as the bytes of its words (lower-cased A-Z, split at ASCII white
space), each followed by a space, and a line end; before its first byte stand line
ends. ``score`` is the log10 probability of these bytes under a context tree of
``DEPTH`` bytes trained on the training texts (``context_tree`` has the model);
``base_score`` is that of its tokens, the words and one end, with add-one counts.

Counts cover all training texts and nothing whole is sent anywhere. Training texts
send their distinct grams (context and byte) and words, with numbers, to the task
that owns them; a gram's owner is chosen by its two nearest context bytes, so it owns
whole subtrees. Texts to score are dealt out in groups; a group asks the owners for
its distinct grams and words, gets their log probabilities and counts back, and adds
them up per text. Only the tree's top, of no or one context byte, is shared by all.

Null text counts as empty: one end token. Null ids are ids like any other, repeated
rows are scored alike. Without training texts every bit has probability a half and
every token 1. Only ``doc_id``, ``text`` and the fold are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import context_tree as tree
from balcao.llm import words as W
from balcao.llm.packing import pack, unpack
from balcao.sources.scratch import stage

DEPTH = 5
GROUP_BYTES = 6 << 20
OWNED_BYTES = 16 << 20
_GRAM, _WORD = 0, 1
_SPACE, _END = 32, 10


def _canonical(words: W.Words, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each after ``depth`` line ends; where scored bytes are, and their number per text."""
    per_doc = words.per_doc
    n_docs, n_words = len(per_doc), len(words.lengths)
    doc = np.repeat(np.arange(n_docs), per_doc)
    first = np.cumsum(words.lengths) - words.lengths
    begin = first + np.arange(n_words) + (doc + 1) * depth + doc
    letters = np.append(first, len(words.letters))[words.doc_start]
    scored = np.diff(letters) + per_doc + 1
    ends = np.cumsum(scored + depth)
    out = np.full(int(ends[-1]) if n_docs else 0, _SPACE, dtype=np.uint8)
    place = np.arange(len(words.letters)) + np.repeat(begin - first, words.lengths)
    out[place] = words.letters
    out[ends - 1] = _END
    pads = ((ends - scored - depth)[:, None] + np.arange(depth)).reshape(-1)
    out[pads] = _END
    is_scored = np.ones(len(out), dtype=bool)
    is_scored[pads] = False
    return out, is_scored, scored


def _grams(words: W.Words, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every scored byte, and the number of them in each text."""
    raw, is_scored, scored = _canonical(words, depth)
    wide = raw.astype(np.uint64)
    n = len(raw) - depth
    gram = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(1, depth + 1):
        gram <<= np.uint64(8)
        gram |= wide[depth - j : depth - j + n]
    gram <<= np.uint64(8)
    gram |= wide[depth:]
    return gram[is_scored[depth:]], scored


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several (keys, counts), with counts added up."""
    keys = np.concatenate([k for k, _ in parts]) if parts else np.empty(0, np.uint64)
    counts = np.concatenate([n for _, n in parts]) if parts else np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    return keys[starts], np.add.reduceat(counts, starts)


class _Plan:
    """Who owns which key."""

    def __init__(self, depth: int, owners: int):
        self.depth, self.owners = depth, owners

    def split(self, kind: int, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(owner, positions of its keys), in an order that depends on the keys alone."""
        near = keys >> np.uint64(8 * (self.depth - 1)) if kind == _GRAM else keys
        owner = (W.mix(near + np.uint64(1)) % np.uint64(self.owners)).astype(np.int32)
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(self.owners + 1))
        for i in np.flatnonzero(np.diff(ends)):
            yield int(i), order[ends[i] : ends[i + 1]]

    def pieces(self, texts: pa.Array) -> Iterator[tuple[int, int, W.Words, np.ndarray, np.ndarray, np.ndarray]]:
        """(first, end, words, word keys, grams, grams per text)."""
        for begin, end, raw, offsets in W.pieces(texts):
            words = W.cut(raw, offsets, W.NON_SPACE)
            yield begin, end, words, words.hashes, *_grams(words, self.depth)

    def distinct(self, texts: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, keys, counts) of all texts together."""
        found: tuple[list, list] = ([], [])
        for _, _, _, words, grams, _ in self.pieces(texts):
            found[_GRAM].append(np.unique(grams, return_counts=True))
            found[_WORD].append(np.unique(words, return_counts=True))
        return [(kind, *_added(parts)) for kind, parts in enumerate(found)]


_COUNTS = "kind int, owner int, keys binary, counts binary"
_COUNT_TYPES = {"kind": pa.int32(), "owner": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}


def _table(rows: dict[str, list], types: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array(rows[name], kind) for name, kind in types.items()})


def _counted(plan: _Plan) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in _COUNT_TYPES}
            for kind, keys, counts in plan.distinct(batch.column("text")):
                for owner, at in plan.split(kind, keys):
                    for name, value in zip(rows, (kind, owner, pack(keys[at]), pack(np.cumsum(counts[at]))), strict=True):
                        rows[name].append(value)
            yield from _table(rows, _COUNT_TYPES).to_batches()

    return count


def _steps(packed: bytes) -> np.ndarray:
    return np.diff(unpack(packed), prepend=np.uint64(0)).astype(np.int64)


def _owned(rows: pa.Table) -> pa.Table:
    """One row of an owner's keys with total counts."""
    parts = [
        (unpack(k), _steps(n))
        for k, n in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist(), strict=True)
    ]
    keys, counts = _added(parts)
    return pa.table(
        {
            "kind": rows.column("kind")[:1],
            "owner": rows.column("owner")[:1],
            "keys": pa.array([pack(keys)], pa.binary()),
            "counts": pa.array([pack(np.cumsum(counts))], pa.binary()),
            "n_keys": pa.array([len(keys)], pa.int64()),
            "total": pa.array([int(counts.sum())], pa.int64()),
        }
    )


def _handed_up(depth: int) -> Callable:
    """Nodes of one-byte contexts, as far as this owner's subtrees make them up."""

    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                _, (key, *values) = tree.build(unpack(packed), _steps(counts), depth)
                up, at = np.unique((key >> 16) << 8 | (key & 255), return_inverse=True)
                sums = [pa.array(np.bincount(at, weights=v, minlength=len(up))) for v in values]
                yield pa.RecordBatch.from_arrays([pa.array(up), *sums], ["key", "zeros", "ones", "logs"])

    return hand


_ASK_TYPES = {"kind": pa.int32(), "owner": pa.int32(), "grp": pa.int32(), "keys": pa.binary()}
_ANSWER_TYPES = {"grp": pa.int32(), "kind": pa.int32(), "owner": pa.int32(), "values": pa.binary()}


def _asked(plan: _Plan) -> Callable[[pa.Table], pa.Table]:
    def ask(texts: pa.Table) -> pa.Table:
        rows: dict[str, list] = {name: [] for name in _ASK_TYPES}
        group = texts.column("grp")[0].as_py()
        for kind, keys, _ in plan.distinct(texts.column("text")):
            for owner, at in plan.split(kind, keys):
                for name, value in zip(rows, (kind, owner, group, pack(keys[at])), strict=True):
                    rows[name].append(value)
        return _table(rows, _ASK_TYPES)

    return ask


def _answered(depth: int, top) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Log probabilities of grams, and counts of words, in the order that each group asked."""

    def answer(asked: pa.Table, owned: pa.Table) -> pa.Table:
        rows: dict[str, list] = {name: [] for name in _ANSWER_TYPES}
        if asked.num_rows:
            kind, owner = asked.column("kind")[0].as_py(), asked.column("owner")[0].as_py()
            parts = [unpack(x) for x in asked.column("keys").to_pylist()]
            every, where = np.unique(np.concatenate(parts), return_inverse=True)
            keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
            if owned.num_rows:
                keys, counts = unpack(owned.column("keys")[0].as_py()), _steps(owned.column("counts")[0].as_py())
            if kind == _WORD:
                at = np.minimum(np.searchsorted(keys, every), max(len(keys) - 1, 0))
                value = np.where(keys[at] == every, counts[at], 0) if len(keys) else np.zeros(len(every), np.int64)
            else:
                levels = tree.build(keys, counts, depth)[0] if len(keys) else []
                value = tree.log10_probability(every, depth, levels, top.value).astype(np.float32)
            at = 0
            for group, part in zip(asked.column("grp").to_pylist(), parts, strict=True):
                own = value[where[at : at + len(part)]]
                at += len(part)
                packed = pack(np.cumsum(own)) if kind == _WORD else pa.compress(own.tobytes(), codec="zstd", asbytes=True)
                for name, item in zip(rows, (group, kind, owner, packed), strict=True):
                    rows[name].append(item)
        return _table(rows, _ANSWER_TYPES)

    return answer


class _Finder:
    """Looks up many numbers among few: a table by hash, then a search for what fell out of it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 6).bit_length())
        self.keys, self.values, self.shift = keys, values, np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, dtype=np.int32)
        self.slots[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(wanted)]
        lost = np.flatnonzero(self.keys[at] != wanted)
        at[lost] = np.searchsorted(self.keys, wanted[lost])
        return self.values[at]


_RESULT = "held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint"


def _finished(plan: _Plan, train_tokens: int, vocabulary: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def finish(texts: pa.Table, answers: pa.Table) -> pa.Table:
        packed = {
            (kind, owner): value
            for kind, owner, value in zip(*[answers.column(c).to_pylist() for c in ("kind", "owner", "values")], strict=True)
        }
        finders = []
        for kind, keys, _ in plan.distinct(texts.column("text")):
            values = np.zeros(len(keys), dtype=np.float64)
            for owner, at in plan.split(kind, keys):
                raw = packed[kind, owner]
                values[at] = (
                    _steps(raw)
                    if kind == _WORD
                    else np.frombuffer(pa.decompress(raw, 4 * len(at), codec="zstd", asbytes=True), dtype=np.float32)
                )
            finders.append(_Finder(keys, values))
        n = texts.num_rows
        tokens, known, size = np.zeros((3, n), dtype=np.int64)
        base, score = np.zeros((2, n))
        whole = float(train_tokens + vocabulary + 1)
        for begin, end, words, keys, grams, per_doc in plan.pieces(texts.column("text")):
            count = finders[_WORD](keys) if len(keys) else np.zeros(0)
            here = slice(begin, end)
            tokens[here] = words.per_doc
            known[here] = W.add_per_doc((count > 0).astype(np.int64), words.per_doc)
            base[here] = W.add_per_doc(np.log10((count + 1) / whole), words.per_doc)
            score[here] = W.add_per_doc(finders[_GRAM](grams), per_doc)
            size[here] = per_doc
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": texts.column("held_out"),
                "n_tokens": tokens,
                "n_known": known,
                "base_score": base,
                "score": score,
                "n_bytes": size,
            }
        )

    return finish


def scored(documents: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    if not 2 <= depth <= 7:
        raise ValueError("a gram has 3 to 8 bytes")
    spark = documents.sparkSession
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    size, train_docs = rows.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held_out"))
    ).first()
    plan = _Plan(depth, max(1, -(-size // OWNED_BYTES)))

    counts = rows.filter(~F.col("held_out")).select("text").mapInArrow(_counted(plan), _COUNTS)
    merged = counts.groupBy("kind", "owner").applyInArrow(_owned, _COUNTS + ", n_keys bigint, total bigint")
    owned = stage(merged, "contagens")
    distinct, total = owned.filter(F.col("kind") == _WORD).agg(F.sum("n_keys"), F.sum("total")).first()
    vocabulary, train_tokens = (distinct or 0) + (train_docs > 0), (total or 0) + train_docs
    handed = owned.filter(F.col("kind") == _GRAM).mapInArrow(
        _handed_up(depth), "key bigint, zeros double, ones double, logs double"
    )
    sums = handed.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "logs")])
    nodes = sums.toArrow()  # at most 256 contexts of 255 nodes
    top = tree.top(*[nodes.column(c).to_numpy() for c in ("key", "zeros", "ones", "logs")])

    groups = max(1, -(-size // GROUP_BYTES))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "text"), groups).cast("int").alias("grp"), "doc_id", "held_out", "text")
    texts = dealt.groupBy("grp")
    asked = texts.applyInArrow(_asked(plan), "kind int, owner int, grp int, keys binary")
    answers = (
        asked.groupBy("kind", "owner")
        .cogroup(owned.select("kind", "owner", "keys", "counts").groupBy("kind", "owner"))
        .applyInArrow(_answered(depth, spark.sparkContext.broadcast(top)), "grp int, kind int, owner int, values binary")
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = texts.cogroup(answers.groupBy("grp")).applyInArrow(
        _finished(plan, train_tokens, vocabulary), f"doc_id {kind}, {_RESULT}"
    )
    end = F.log10(F.lit((train_docs + 1) / (train_tokens + vocabulary + 1)))
    return found.select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + int(train_docs > 0)).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + end).alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
