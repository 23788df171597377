"""Language, quality and toxicity: held-out accuracy, and awkward rows."""

import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from balcao.llm import language, quality, queries, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_texts(spark):
    found = queries.op1_language(spark, FOLDER)
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    held = found.filter("held_out").join(given, "doc_id")
    right, least, most = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right > 0.98 and 0 <= least and most <= 1
    assert found.count() == given.count()


def test_language_backs_off_to_shorter_grams(spark):
    english = "the quick brown fox jumps over the lazy dog while the old cat sleeps on the warm mat near the door"
    german = "der schnelle braune Fuchs springt ueber den faulen Hund und die alte Katze schlaeft auf der Matte"
    rows = [(1, english, "en"), (2, german, "de")]
    model = language.train(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    new = ["quickly jumping dogs", "schnellste Katzen", None, "", "12 34"]
    got = language.predicted(model, pa.array(new, pa.string()))
    assert got.field("lang_pred").to_pylist() == ["en", "de", "und", "und", "und"]
    assert got.field("score").to_pylist()[2:] == [0, 0, 0]


def test_every_language_is_learned_however_long_its_texts(spark):
    """Twenty languages of two texts each, every text longer than what a language may take."""
    rows = [(10 * i + j, f"{chr(97 + i)}word{i} " * 4000, f"l{i:02d}") for i in range(20) for j in range(2)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = language.train(frame, bytes_per_language=20_000)
    assert model.languages == sorted({lang for _, _, lang in rows})
    found = language.predicted(model, pa.array([text for _, text, _ in rows])).field("lang_pred").to_pylist()
    assert found == [lang for _, _, lang in rows]


@pytest.mark.parametrize("rows", ["awkward", "nothing"])
def test_language_of_awkward_rows(spark, awkward, nothing, rows):
    frame = awkward if rows == "awkward" else nothing
    predict = language.predictor(language.train(frame), spark)
    found = frame.select("doc_id", "text", predict(F.col("text")).alias("p")).collect()
    assert len(found) == frame.count()
    for row in found:
        letters = row.text is not None and any(c.isalpha() for c in row.text)
        assert (row.p.lang_pred == "und") == (not letters)


@pytest.mark.parametrize("query, label", [(queries.op8_quality, "quality"), (queries.op9_toxicity, "toxic")])
def test_scores_of_held_out_texts(spark, query, label):
    found = query(spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = found.filter("held_out").join(labels, "doc_id").select("score", label).collect()
    one = [r.score for r in rows if r[label] == 1]
    zero = [r.score for r in rows if r[label] == 0]
    ranked = np.mean([(a > b) + 0.5 * (a == b) for a in one for b in zero])
    assert ranked > (0.97 if label == "quality" else 0.8)
    assert found.filter("score is null or score < 0 or score > 1 or (predicted = 1) != (score >= 0.5)").isEmpty()


def test_quality_finds_the_prior_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    good = rng.normal(1, 1, (4000, quality.FEATURES)) * ([1.0] * 5 + [0.0] * (quality.FEATURES - 5))
    bad = rng.normal(-1, 1, (4000, quality.FEATURES)) * ([1.0] * 5 + [0.0] * (quality.FEATURES - 5))
    model = quality.fit(good[:2000], np.vstack([good[2000:], bad[:1000]]))
    assert 0.55 < model.prior < 0.8
    assert (model.scores(bad[1000:]) < 0.5).mean() > 0.95


@pytest.mark.parametrize("rows", ["awkward", "nothing"])
@pytest.mark.parametrize("labelled", [[], [(1, 1, 1), (5, 0, 0), (None, 1, 1), (7, 1, 0), (9, None, None)]])
def test_scores_of_awkward_rows(spark, awkward, nothing, rows, labelled):
    frame = awkward if rows == "awkward" else nothing
    labels = spark.createDataFrame(labelled, "doc_id bigint, quality int, toxic int")
    good = quality.QualityColumn(quality.train(frame, labels), spark)
    bad = toxicity.ToxicityColumn(toxicity.train(frame, labels), spark)
    found = frame.select(good(F.col("text")).alias("g"), bad(F.col("text")).alias("b")).collect()
    assert len(found) == frame.count()
    assert all(0 <= r.g <= 1 and 0 <= r.b <= 1 for r in found)
    if not labelled:
        assert all(r.g == 0.5 and r.b == 0 for r in found)


def test_disguises_are_undone(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.train(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    disguised = {b"1d10t": b"idiot", b"m o r o n": b"moron", b"stuuupid": b"stupid", b"tr@sh": b"trash"}
    for seen, meant in disguised.items():
        assert toxicity.restore(model.trigrams, seen) == meant
    texts = pa.array(["you 1d10t", "you m o r o n", "the river is wide"])
    strongest = toxicity.evidence(model, texts)[:, 0]
    assert strongest[0] > 1 and strongest[1] > 1 and strongest[2] == 0


def test_disguises_by_gaps_doubling_and_neighbours_are_undone(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.train(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert toxicity.restore(model.trigrams, b"i d i o t m o r o n") == b"idiot moron"
    disguised = ["you are a m o r o n", "i d i o t m o r o n", "you i  d  i  o  t", "i--d--i--o--t", "i\td\ti\to\tt"]
    disguised += ["m\no\nr\no\nn", "m,o,r,o,n", "m/o/r/o/n", "you id iot", "iddiioott", "mor0n!", "idio+"]
    strongest = toxicity.evidence(model, pa.array([*disguised, "the river is wide"]))[:, 0]
    assert [x for x, s in zip(disguised, strongest, strict=False) if s < 1] == [] and strongest[-1] == 0


def test_toxicity_learns_from_every_labelled_row(spark):
    """Each word is in the fewest toxic texts that count: leaving out any labelled row would lose some."""
    words = [f"{first}olmer" for first in "bcdfghjkmnpqrtvw"]
    texts = [word for word in words for _ in range(4)]
    n = len(texts) + 20_000
    rows = [(i, texts[i] if i < len(texts) else f"the river is wide {i % 90}") for i in range(n)]
    documents = spark.createDataFrame(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    labels = spark.createDataFrame(pa.table({"doc_id": list(range(n)), "toxic": [int(i < len(texts)) for i in range(n)]}))
    model = toxicity.train(documents, labels)
    assert (toxicity.evidence(model, pa.array(words))[:, 0] > 0).all()


def test_texts_meet_their_labels_the_same_way_however_few(spark, monkeypatch):
    """A few labels must not be broadcast: what is shuffled would jump where they are more."""
    plans, write = [], toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label))
    documents = spark.createDataFrame([(1, "you idiot"), (2, "the river"), (2, "is wide"), (None, "x"), (3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (3, 1), (None, 1)], "doc_id bigint, toxic int")
    toxicity.train(documents, labels)
    assert "ShuffledHashJoin" in plans[0] and "Broadcast" not in plans[0]


@pytest.mark.parametrize("kind", [np.int64, np.uint64])
@pytest.mark.parametrize("n", [0, 1, 3000])
def test_keys_are_found_as_by_a_plain_search(kind, n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n).view(kind))
    others = np.concatenate([keys[:1] ^ kind(1 << 40), rng.integers(-(2**63), 2**63 - 1, 500).view(kind)])
    asked = rng.permutation(np.concatenate([keys, keys[::7], others]))
    place, hit = toxicity._Sorted(keys).find(asked)
    assert hit.tolist() == np.flatnonzero(np.isin(asked, keys)).tolist()
    assert keys[place].tolist() == asked[hit].tolist()


def _odd_texts(n: int) -> list[str]:
    rng = np.random.default_rng(n)
    parts = ["a", "b", "tt", "ee", "1", "0", "!", "@", "$", "|", " ", " ", "  ", "\n", ".", "-", "é", "ж", "​", "\x00", "Idiot", "m o r o n ", "x" * 40]
    return ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(n)]


def _even_model(end: float = -3.3):
    """Every letter is as likely after any two; ``end`` is the log probability of a word's end."""
    trigrams = np.full((27, 27, 27), -3.3)
    trigrams[:, :, 0] = end
    return toxicity.ToxicityModel(trigrams, np.array([1], np.uint64), np.ones(1), np.zeros(4))


def test_stretches_are_those_of_the_pattern():
    low = [toxicity.W.LOWER[np.frombuffer(text.encode(), np.uint8)] for text in _odd_texts(3000)]
    borders = np.concatenate([[0], np.cumsum([len(x) for x in low])])
    docs, starts, ends, spells = toxicity._stretches(np.concatenate(low), borders)
    for doc, text in enumerate(low):
        meant = list(toxicity._DISGUISED.finditer(text.tobytes()))
        if spells[doc]:
            continue
        assert all(m["spelled"] is None for m in meant)
        mine = docs == doc
        found = zip(starts[mine] - borders[doc], ends[mine] - borders[doc], strict=True)
        assert [m.span() for m in meant] == [(int(a), int(b)) for a, b in found]
    assert spells.any() and not spells.all()


def test_evidence_does_not_depend_on_the_pieces():
    texts = pa.array([*_odd_texts(500), None, "", "ж" * 500, "ab" * 3000, "a b " * 90])
    restorer, found = toxicity._Restorer(_even_model().trigrams), []
    for size in (1, 700, 1 << 20):
        held = {}
        for begin, _, parts, per_doc in toxicity._piecewise(texts, restorer, size):
            held |= {begin + i: ([], int(n)) for i, n in enumerate(per_doc)}
            for keys, docs in parts:
                for key, doc in zip(keys.tolist(), docs.tolist(), strict=True):
                    held[begin + doc][0].append(key)
        found.append(held)
    assert found[0] == found[1] == found[2] and len(found[0]) == len(texts)


def test_words_and_beginnings_of_any_length_have_numbers_of_their_own():
    words = sorted({"x" * n + end for n in range(70) for end in ("y", "z")} | {"abcd", "abcde", "abcdef", "abcdefgh", "abcdefghi"})
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, stop, _ = toxicity._runs(toxicity._LETTER[raw], np.array([0, len(raw)]))
    (keys, _), *beginnings = toxicity._evidence_keys(toxicity._padded(raw), start, stop - start, np.arange(len(words)))
    assert len(np.unique(keys)) == len(words)
    for size, (some, docs) in zip((4, 5), beginnings, strict=True):
        assert not np.isin(some, keys).any()
        assert len(np.unique(some)) == len({words[doc][:size] for doc in docs})
        assert docs.tolist() == [i for i, word in enumerate(words) if len(word) > size]


def test_evidence_costs_little_time_and_memory_beside_cutting_words():
    """One pass over text in a core's cache: not several over arrays of 16 bytes and more per letter."""
    text = "the tall river in the northern valley runs slowly past small hills and l3ttered fields, "
    texts, model = pa.array([text * 40] * 600), _even_model(end=-0.1)
    restorer, ratios = toxicity._Restorer(model.trigrams), []
    toxicity.evidence(model, texts, restorer)
    for _ in range(5):
        began = time.thread_time()
        for _, _, raw, offsets in toxicity.W.pieces(texts):
            toxicity.W.cut(raw, offsets, toxicity._LETTER)
        cut = time.thread_time() - began
        toxicity.evidence(model, texts, restorer)
        ratios.append((time.thread_time() - began - cut) / cut)
    tracemalloc.start()
    toxicity.evidence(model, texts, restorer)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * toxicity.W.PIECE
    assert sorted(ratios)[2] < 6
