"""Language identification by words, then by ever shorter character n-grams.

A word seen in training scores its log frequency in each language. Any other
word is scored by its character n-grams: at each character the longest known
n-gram that starts there counts, from ``LONGEST`` characters down to one, with its
log frequency divided by its length, as each character is then covered about
once. The language with the largest sum over the text wins; equal sums go to the
language that sorts first.

Training takes a sample of about ``bytes_per_language`` bytes of text from each
language (all text of a smaller one, and one row at least), so the model's size has a
bound whatever the corpus, but for the length of single texts. Prediction works on whole texts, batch by batch.

Null and empty texts, and texts without letters, are ``und`` with score 0. Without
any training text all are. Rows with null language are not learned from. Repeated rows
each get the same answer; columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import words as W
from balcao.llm.tables import share_of_rows

UNDETERMINED = "und"
LONGEST = 4
BYTES_PER_LANGUAGE = 2_000_000
_SMOOTHING = 0.5
_COUNTS = "kind int, gram bigint, lang string, n bigint"


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and a random number."""
    points = np.arange(0x110000, dtype=np.uint64)
    return np.array([chr(i).isalpha() for i in range(0x110000)]), W.mix(points + np.uint64(1))


@dataclass
class _Piece:
    """Letter runs of some texts: random numbers of all letters, and where words lie."""

    values: np.ndarray
    first: np.ndarray
    lengths: np.ndarray
    doc_start: np.ndarray
    hashes: np.ndarray


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, _Piece]]:
    is_letter, values = _letters()
    for begin, end, raw, offsets in W.pieces(texts):
        data = raw.tobytes()
        low = [data[a:b].decode("utf-8", "replace").lower() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        borders = np.cumsum([0, *map(len, low)])
        inside = is_letter[points]
        doc_start, first, lengths = W.runs(points, borders, inside)
        own = values[points[inside]]
        yield begin, end, _Piece(own, first, lengths, doc_start, W.run_hashes(own, first, lengths))


def _grams(values: np.ndarray, first: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram at each letter, and whether it lies within its word."""
    left = np.repeat(first + lengths, lengths) - np.arange(len(values))
    total = np.zeros(len(values), dtype=np.uint64)
    factors = W._place_factors(n)
    for j in range(n):
        total[: len(values) - j] += values[j:] * factors[j]
    return W.mix(total + np.uint64(n)), left >= n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (kind 0) and n-grams (kind n) with counts, by language."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        found: dict[tuple[int, str], list[np.ndarray]] = {}
        for begin, end, piece in _pieces(batch.column("text")):
            per_doc = np.diff(piece.doc_start)
            name = np.array(langs[begin:end], dtype=object)
            of_word = np.repeat(name, per_doc)
            of_letter = np.repeat(of_word, piece.lengths)
            for lang in set(name):
                found.setdefault((0, lang), []).append(piece.hashes[of_word == lang])
            for n in range(1, LONGEST + 1):
                grams, whole = _grams(piece.values, piece.first, piece.lengths, n)
                for lang in set(name):
                    found.setdefault((n, lang), []).append(grams[whole & (of_letter == lang)])
        for (kind, lang), parts in found.items():
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(gram), kind, np.int32)),
                    pa.array(gram.view(np.int64)),
                    pa.array([lang] * len(gram), pa.string()),
                    pa.array(n.astype(np.int64)),
                ],
                ["kind", "gram", "lang", "n"],
            )


@dataclass
class LanguageModel:
    """Languages, and by kind the sorted hashes with log frequencies in each language."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]


def train(labelled: DataFrame, bytes_per_language: int = BYTES_PER_LANGUAGE) -> LanguageModel:
    """Learn from ``doc_id``, ``text`` and non-null ``lang`` of the given rows."""
    rows = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    # The first row of each language by hash is always taken, however long its rows are.
    place = F.xxhash64(F.lit("first"), "doc_id", "text")
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("size"), F.min(place).alias("first"))
    rates = sizes.select(
        F.col("lang").alias("of_lang"),
        "first",
        F.least(F.lit(1.0), F.lit(float(bytes_per_language)) / F.greatest("size", F.lit(1))).alias("share"),
    )
    sample = rows.join(F.broadcast(rates), F.col("lang") == F.col("of_lang")).filter(
        share_of_rows(F.col("share"), "doc_id", "text") | (place == F.col("first"))
    )
    counts = sample.select("lang", "text").mapInArrow(_counted, _COUNTS)
    table = counts.groupBy("kind", "gram", "lang").agg(F.sum("n").alias("n")).toArrow()
    return _model(table)


def _model(table: pa.Table) -> LanguageModel:
    languages = sorted(set(table.column("lang").to_pylist()), key=lambda x: x.encode())
    number = {lang: i for i, lang in enumerate(languages)}
    kind = table.column("kind").to_numpy()
    gram = table.column("gram").to_numpy().view(np.uint64)
    lang = np.array([number[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
    count = table.column("n").to_numpy()
    keys, logs = [], []
    for k in range(LONGEST + 1):
        of_kind = kind == k
        own, at = np.unique(gram[of_kind], return_inverse=True)
        table_of = np.zeros((len(own), len(languages)))
        table_of[at, lang[of_kind]] = count[of_kind]
        total = table_of.sum(axis=0) + _SMOOTHING * max(1, len(own))
        keys.append(own)
        logs.append((np.log(table_of + _SMOOTHING) - np.log(total)).astype(np.float32))
    return LanguageModel(languages, keys, logs)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _word_scores(model: LanguageModel, piece: _Piece) -> np.ndarray:
    """A row per distinct word, and for each word the number of its row."""
    distinct, where, inverse = np.unique(piece.hashes, return_index=True, return_inverse=True)
    at, known = _found(model.keys[0], distinct)
    scores = np.zeros((len(distinct), len(model.languages)))
    scores[known] = model.logs[0][at[known]]
    new = np.flatnonzero(~known)
    if len(new):
        first, lengths = piece.first[where[new]], piece.lengths[where[new]]
        own = np.cumsum(lengths) - lengths
        take = np.repeat(first - own, lengths) + np.arange(int(lengths.sum()))
        values = piece.values[take]
        here = np.zeros((len(values), len(model.languages)))
        open_at = np.ones(len(values), dtype=bool)
        for n in range(LONGEST, 0, -1):
            grams, whole = _grams(values, own, lengths, n)
            ask = np.flatnonzero(open_at & whole)
            at, hit = _found(model.keys[n], grams[ask])
            here[ask[hit]] = model.logs[n][at[hit]] / n
            open_at[ask[hit]] = False
        scores[new] = np.add.reduceat(here, own)
    return scores, inverse


def predictor(model: LanguageModel, spark) -> "LanguageColumn":
    return LanguageColumn(spark.sparkContext.broadcast(model))


class LanguageColumn:
    """Turns a text column into a struct of ``lang_pred`` and ``score``."""

    def __init__(self, model):
        self.model = model

    def __call__(self, text: Column) -> Column:
        model = self.model

        @F.arrow_udf("struct<lang_pred:string,score:double>")
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield predicted(model.value, texts)

        return predict(text)


def predicted(model: LanguageModel, texts: pa.Array) -> pa.Array:
    """Language and score of each text; the score is its posterior under equal priors."""
    lang = np.full(len(texts), UNDETERMINED, dtype=object)
    score = np.zeros(len(texts))
    for begin, end, piece in _pieces(texts):
        per_doc = np.diff(piece.doc_start)
        if not model.languages or not per_doc.any():
            continue
        rows, of_word = _word_scores(model, piece)
        full = np.flatnonzero(per_doc)
        total = np.add.reduceat(rows[of_word], piece.doc_start[:-1][full])
        best = total.argmax(axis=1)
        lang[begin + full] = np.array(model.languages, dtype=object)[best]
        score[begin + full] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return pa.StructArray.from_arrays(
        [pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"]
    )
