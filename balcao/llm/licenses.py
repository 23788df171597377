"""License notices in documents by diagonal voting.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters. Every
run of three words of every text is hashed; the hashes that occur in a template are
kept with the words around them (a region), and Spark joins them to their positions
in the templates. A hash at word p of a text and q of a template votes for the
diagonal p - q. A phrase stands in a text wherever one diagonal has all its votes.
For longer templates, diagonals up to three words apart are merged, so that added
or lost words don't split a notice, and a merged span with at least half the votes
is verified: twice the longest common subsequence of its words and the template's,
over both lengths, must reach ``SIMILARITY``.

A text's score is 1 with a phrase, else its best verified similarity, else 0. Null
text counts as empty; texts of fewer than three words hold nothing. Rows are told
apart by id and text and each row gets its result, repeated ones too. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balcao.llm import words as W
from balcao.sources.scratch import stage

K = 3
SIMILARITY = 0.8
_APART = 3
_GAP, _MARGIN = 50, 10

# Phrases with the labels that they stand for.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Openings of common license notices, with short labels.
NOTICES = [
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "mit",
    ),
    ("licensed under the apache license version 2 0", "apache-2"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
        "apache-2",
    ),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        "gpl",
    ),
    (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation",
        "lgpl",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    (
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        "cc-by-nc",
    ),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
        "mpl-2",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        "isc",
    ),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def _hashed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a template's words and of its runs of ``K`` words."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    words = W.cut(raw, np.array([0, len(raw)]), W.ALPHANUMERIC)
    return words.hashes, W.shingles(words, K)[0]


def template_rows(phrases=PHRASES, notices=NOTICES) -> list[tuple]:
    """(template, label, is_phrase, words, grams) of every template; a few hundred words in all."""
    made = []
    for number, (text, label) in enumerate([*phrases, *notices]):
        words, grams = _hashed(text)
        if len(words) < K:
            raise ValueError(f"a template needs {K} words: {text!r}")
        made.append((number, label, number < len(phrases), words.view(np.int64).tolist(), grams.view(np.int64).tolist()))
    return made


_REGIONS = "array<struct<begin:int,words:array<bigint>,grams:array<bigint>>>"


def _scanned(known: np.ndarray):
    """Per text: number of words, and the regions around hashes that occur in templates."""
    region_type = pa.list_(
        pa.struct([("begin", pa.int32()), ("words", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, regions = np.zeros(len(batch), np.int64), [[] for _ in range(len(batch))]
            for begin, end, raw, offsets in W.pieces(batch.column("text")):
                words = W.cut(raw, offsets, W.ALPHANUMERIC)
                n[begin:end] = words.per_doc
                if not len(words.hashes):
                    continue
                grams, count = W.shingles(words, K)
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                hit = np.flatnonzero((known[at] == grams) & np.repeat(words.per_doc >= K, count))
                ends = np.cumsum(count)
                doc = np.searchsorted(ends, hit, side="right")
                place = hit - (ends[doc] - count[doc])
                new = np.ones(len(hit), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > _GAP)
                starts = np.flatnonzero(new)
                for a, b in zip(starts, np.append(starts, len(hit))[1:], strict=True):
                    d = doc[a]
                    low = max(0, int(place[a]) - _MARGIN)
                    high = min(int(words.per_doc[d]), int(place[b - 1]) + K + _MARGIN)
                    first_word, first_gram = words.doc_start[d], ends[d] - count[d]
                    regions[begin + d].append(
                        {
                            "begin": low,
                            "words": words.hashes[first_word + low : first_word + high].view(np.int64),
                            "grams": grams[first_gram + low : first_gram + high - K + 1].view(np.int64),
                        }
                    )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key_1"), batch.column("key_2"), pa.array(n), pa.array(regions, region_type)],
                ["doc_id", "key_1", "key_2", "n_words", "regions"],
            )

    return scan


def _common(one: list[int], two: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of ``one``."""
    masks: dict[int, int] = {}
    for i, word in enumerate(one):
        masks[word] = masks.get(word, 0) | 1 << i
    every = (1 << len(one)) - 1
    row = every
    for word in two:
        both = row & masks.get(word, 0)
        row = ((row + both) | (row - both)) & every
    return len(one) - row.bit_count()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of each span's words to its template's."""
    for batch in batches:
        spans, templates = batch.column("span").to_pylist(), batch.column("words").to_pylist()
        similarity = [2 * _common(t, s) / (len(t) + len(s)) for s, t in zip(spans, templates, strict=True)]
        kept = [batch.column(name) for name in ("key_1", "key_2", "label", "first_word", "last_word")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(similarity, pa.float64())], ["key_1", "key_2", "label", "first_word", "last_word", "similarity"]
        )


def _scan(documents: DataFrame, templates: list[tuple]) -> DataFrame:
    known = np.unique(np.array([g for row in templates for g in row[4]], dtype=np.int64).view(np.uint64))
    keyed = documents.select(
        "doc_id",
        F.xxhash64(F.lit(1), "doc_id", "text").alias("key_1"),
        F.xxhash64(F.lit(2), "doc_id", "text").alias("key_2"),
        "text",
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    return stage(
        keyed.mapInArrow(_scanned(known), f"doc_id {kind}, key_1 bigint, key_2 bigint, n_words bigint, regions {_REGIONS}"),
        "licencas",
    )


_KEY = ["key_1", "key_2"]


def _diagonals(scanned: DataFrame, templates: list[tuple]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The regions, the templates, and the votes of each region's diagonals."""
    spark = scanned.sparkSession
    names = "template int, label string, is_phrase boolean, words array<bigint>, grams array<bigint>"
    table = spark.createDataFrame(templates, names)
    regions = (
        scanned.filter(F.size("regions") > 0)
        .dropDuplicates(_KEY)
        .select(*_KEY, F.posexplode("regions").alias("region", "found"))
        .select(*_KEY, "region", "found.*")
    )
    places = table.select("template", "is_phrase", F.size("grams").alias("n_grams"), F.posexplode("grams").alias("q", "gram"))
    runs = regions.select(*_KEY, "region", "begin", F.posexplode("grams").alias("p", "gram"))
    votes = runs.join(F.broadcast(places), "gram").groupBy(  # the templates are a fixed list
        *_KEY, "region", "template", "is_phrase", "n_grams", (F.col("begin") + F.col("p") - F.col("q")).alias("diagonal")
    )
    counted = votes.agg(F.count_distinct("q").alias("votes"), F.min("q").alias("from_q"), F.max("q").alias("to_q"))
    return regions, table, stage(counted, "diagonais")


def phrase_places(diagonals: DataFrame, table: DataFrame) -> DataFrame:
    """(key, label, at): a row for every place where a phrase stands."""
    full = diagonals.filter("is_phrase and votes = n_grams")
    return full.join(F.broadcast(table.select("template", "label")), "template").select(
        *_KEY, "label", F.col("diagonal").cast("bigint").alias("at")
    )


def notice_spans(regions: DataFrame, table: DataFrame, diagonals: DataFrame) -> DataFrame:
    """(key, label, first_word, last_word, similarity) of verified notices."""
    by_place = Window.partitionBy(*_KEY, "region", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(by_place)
    grouped = diagonals.filter(~F.col("is_phrase")).withColumn("new", (F.coalesce(step, F.lit(_APART + 1)) > _APART).cast("int"))
    grouped = grouped.withColumn("band", F.sum("new").over(by_place))
    # Twice the common words over the words of both is 0.8 or more only where neither has over
    # one and a half times the words of the other. However few votes are left, no such span is passed over.
    width = "(last_word - first_word + 1)"
    spans = (
        grouped.groupBy(*_KEY, "region", "template", "n_grams", "band")
        .agg(
            F.sum("votes").alias("votes"),
            F.min(F.col("diagonal") + F.col("from_q")).alias("first_word"),
            (F.max(F.col("diagonal") + F.col("to_q")) + K - 1).alias("last_word"),
        )
        .filter(f"3 * {width} >= 2 * (n_grams + {K - 1}) and 2 * {width} <= 3 * (n_grams + {K - 1})")
    )
    own = regions.select(*_KEY, "region", "begin", F.col("words").alias("around"))
    cut = F.slice("around", F.col("first_word") - F.col("begin") + 1, F.col("last_word") - F.col("first_word") + 1)
    asked = (
        spans.join(own, [*_KEY, "region"])
        .join(F.broadcast(table.select("template", "label", "words")), "template")
        .select(*_KEY, "label", "first_word", "last_word", cut.alias("span"), "words")
    )
    verified = asked.mapInArrow(
        _verified, "key_1 bigint, key_2 bigint, label string, first_word int, last_word int, similarity double"
    )
    return verified.filter(F.col("similarity") >= SIMILARITY)


def scanned_licenses(documents: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates = template_rows(phrases, notices)
    scanned = _scan(documents.select("doc_id", "text"), templates)
    regions, table, diagonals = _diagonals(scanned, templates)
    base = phrase_places(diagonals, table).groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n_base"),
        F.min("at").alias("first_word"),
        F.max("at").alias("last_word"),
        F.collect_set("label").alias("base"),
    )
    more = notice_spans(regions, table, diagonals).groupBy(*_KEY).agg(
        F.collect_set("label").alias("more"), F.max("similarity").alias("similarity")
    )
    none = F.array().cast("array<string>")
    base_labels, more_labels = F.coalesce("base", none), F.coalesce("more", none)
    return (
        scanned.select("doc_id", *_KEY, "n_words")
        .join(base, _KEY, "left")
        .join(more, _KEY, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
            "first_word",
            "last_word",
            F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union(base_labels, more_labels)), ",").alias("labels"),
            F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("similarity", F.lit(0.0))).alias("score"),
        )
    )
