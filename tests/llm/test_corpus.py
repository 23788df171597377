"""Mixing, likelihood, licenses, neighbours, page text and the pipeline."""

import collections
import math
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import OTHER, PLAIN, SMALL, documents
from pyspark.sql import functions as F

import corpus_pipeline
from balcao.llm import context_tree, extract, licenses, likelihood, mixing, neighbours
from balcao.llm.tables import fold

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return (text or "").encode().translate(LOWER).split()


# --- mixing ---------------------------------------------------------------------------


def brute_targets(sizes):
    """Targets by resharing round after round; sizes: source -> words, null last."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = [n for n in names if n not in stopped]
        left = total - sum(stopped.values())
        share = {n: left * weight[n] / sum(weight[x] for x in open_) for n in open_}
        over = {n: 3 * sizes[n] for n in open_ if share[n] > 3 * sizes[n]}
        if not over:
            return stopped | share
        stopped |= over


def test_mix_meets_brute_force_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), "en", "cab"[i % 3]) for i in range(400)]
    rows += [(1000 + i, "w " * (i % 5), "en", None) for i in range(9)] + [(2000, "w w", "en", "Z"), (2001, None, "en", "é")]
    found = mixing.mixed(documents(spark, rows)).collect()
    again = mixing.mixed(documents(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len(tokens(text))
    want, taken = brute_targets(sizes), collections.Counter()
    assert len(found) == len(rows)
    by_id = {row[0]: row for row in rows}
    for r in found:
        source = by_id[r.doc_id][3]
        assert r["size"] == len(tokens(by_id[r.doc_id][1])) and r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[source] += r.taken
    for source in want:
        assert abs(taken[source] - want[source]) <= max(2, 0.01 * want[source])


def test_mix_of_awkward_rows(spark, awkward, nothing):
    assert mixing.mixed(nothing).count() == 0
    found = mixing.mixed(awkward)
    assert found.count() == awkward.count()
    assert found.filter("taken > 3 * size or taken < 0 or taken is null or target is null").isEmpty()
    assert mixing.mixed(awkward.filter("text is null")).agg(F.sum("taken")).first()[0] == 0


# --- likelihood -----------------------------------------------------------------------


def test_base_score_equals_brute_force(spark, awkward):
    held = fold("doc_id", 7) == 2
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    rows = awkward.select("doc_id", "text").collect()
    train = [tokens(r.text) for r in rows if not out(r.doc_id)]
    counts = collections.Counter(w for t in train for w in t)
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    want = collections.Counter()
    for r in rows:
        own = [counts[w] for w in tokens(r.text)] + [len(train)]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in own)
        want[r.doc_id, out(r.doc_id), len(own), sum(c > 0 for c in own), n, round(base, 5)] += 1
    found = likelihood.scored(awkward, held).collect()
    got = collections.Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found
    )
    assert got == want
    assert all(r.score < 0 for r in found)


def test_likelihood_without_rows_or_training(spark, awkward, nothing):
    assert likelihood.scored(nothing, F.lit(False)).count() == 0
    found = likelihood.scored(awkward, F.lit(True)).collect()
    for r in found:
        text = b"".join(w + b" " for w in tokens(awkward.filter(F.col("doc_id").eqNullSafe(F.lit(r.doc_id))).first().text))
        if r.doc_id is not None:
            assert r.score == pytest.approx(-(len(text) + 1) * 8 * math.log10(2), rel=1e-6)
        assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0)


def test_word_keys_are_whole_hashes():
    """However small the corpus, so that no two of its words are taken for one."""
    plan = likelihood._Plan(likelihood.DEPTH, 1)
    words = [f"w{i}" for i in range(60_000)]
    (_, keys, counts), = [part for part in plan.distinct(pa.array([" ".join(words)])) if part[0] == likelihood._WORD]
    assert len(keys) == len(words) and set(counts) == {1} and int(keys.max()).bit_length() == 64


def recursive_tree(text, depth):
    """Context-tree weighting by its definition, node by node."""
    counts = collections.defaultdict(lambda: [0, 0])
    padded = b"\n" * depth + text
    for i in range(depth, len(padded)):
        for d in range(depth + 1):
            for bit in range(8):
                partial = (1 << bit) | (padded[i] >> (8 - bit))
                counts[padded[i - d : i], partial][(padded[i] >> (7 - bit)) & 1] += 1
    children = collections.defaultdict(list)
    for context, partial in counts:
        if context:
            children[context[1:], partial].append(context)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighed(context, partial):
        own = kt(*counts[context, partial])
        if len(context) == depth:
            return own, None
        below = sum(weighed(c, partial)[0] for c in children[context, partial])
        return math.log(0.5) + np.logaddexp(own, below), below

    def log10(context, byte):
        total = 0.0
        for bit in range(8):
            partial, p = (1 << bit) | (byte >> (8 - bit)), None
            for d in range(depth, -1, -1):
                c = context[depth - d :]
                if (c, partial) not in counts:
                    continue
                a, b = counts[c, partial]
                share = (b + 0.5) / (a + b + 1)
                if p is None:
                    p = share
                else:
                    weight = 1 / (1 + math.exp(weighed(c, partial)[1] - kt(a, b)))
                    p = weight * share + (1 - weight) * p
            p = 0.5 if p is None else p
            total += math.log10(p if (byte >> (7 - bit)) & 1 else 1 - p)
        return total

    return log10


def test_tree_equals_its_definition_and_is_a_distribution():
    depth, text = 3, b"abracadabra abracadabra banana bandana\n"
    pack = lambda context, byte: int.from_bytes(context[::-1] + bytes([byte]), "big")
    padded = b"\n" * depth + text
    grams = [pack(padded[i - depth : i], padded[i]) for i in range(depth, len(padded))]
    values, counts = np.unique(np.array(grams, dtype=np.uint64), return_counts=True)
    levels, handed = context_tree.build(values, counts, depth)
    keys, at = np.unique((handed[0] >> 16) << 8 | (handed[0] & 255), return_inverse=True)
    top = context_tree.top(keys, *[np.bincount(at, weights=x) for x in handed[1:]])
    want = recursive_tree(text, depth)
    for context in (b"abr", b"ana", b"xyz", b"\n\nb", b"zan"):
        asked = np.array([pack(context, byte) for byte in range(256)], dtype=np.uint64)
        got = context_tree.log10_probability(asked, depth, levels, top)
        assert (10**got).sum() == pytest.approx(1)
        for byte in b"abz \n\xff":
            assert got[byte] == pytest.approx(want(context, byte), abs=1e-6)


# --- licenses -------------------------------------------------------------------------


@pytest.mark.parametrize("changed", [0, 4, 8, 9])
def test_notices_of_the_stated_similarity_are_found(spark, changed):
    """Every fifth word changed leaves few runs of three words, but 0.8 of the words."""
    words = licenses.NOTICES[1][0].split()
    for i in range(changed):
        words[2 + 5 * i] = f"other{i}"
    rows = [(1, f"{PLAIN} {' '.join(words)} {OTHER}"), (2, PLAIN), (3, " ".join(words[:20]))]
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scanned_licenses(documents(spark, rows)).collect()}
    assert found[1][0] == "mit" and found[1][1] >= 0.8
    assert found[2] == ("", 0) and found[3] == ("", 0)


def test_license_phrases_equal_brute_force_and_notices_survive_edits(spark):
    notice = licenses.NOTICES[1][0]
    rows = [
        (1, "Released UNDER the-MIT license; under the mit license!"),
        (2, "Licensed under the Apache License, Version 2.0. cc by-nc 4.0 cc by nc"),
        (3, f"{PLAIN} {notice.replace('copy of this', 'full copy of all of this').replace('limitation', 'limits')} {OTHER}"),
        (4, "under the mit"),
        (5, PLAIN),
        (6, None),
        (1, "Released UNDER the-MIT license; under the mit license!"),
        (None, "xcc by nc"),
        (7, "This work is licensed under the GNU General Public License, version 3."),
        (8, ("cc by nc " * 2000)),
        (9, "underé the mit license é under\x00the\x1fmit license"),
    ]
    found = licenses.scanned_licenses(documents(spark, rows)).collect()
    got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found)
    want = collections.Counter()
    for doc_id, text in rows:
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER))
        places = [
            (i, label)
            for phrase, label in licenses.PHRASES
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.encode().split()
        ]
        at = [i for i, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        want[doc_id, len(words), len(at), min(at, default=None), max(at, default=None), labels] += 1
    assert got == want
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].labels == "mit" and 0.8 <= by_id[3].score < 1
    assert by_id[7].labels == "gpl-3" and by_id[5].labels == "" and by_id[5].score == 0 and by_id[1].score == 1


def test_licenses_of_awkward_rows(spark, awkward, nothing):
    assert licenses.scanned_licenses(nothing).count() == 0
    assert licenses.scanned_licenses(awkward).filter("n_base = 0 and score = 0 and labels = ''").count() == awkward.count()


# --- neighbours -----------------------------------------------------------------------


def test_hilbert_curve_visits_neighbours():
    cells = np.array([(x, y) for x in range(16) for y in range(16)])
    keys = neighbours.hilbert_keys(cells, 4)
    path = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(256))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    found = neighbours.nearest(rows, F.col("vec_id") % 100 == 0).toPandas()
    table = rows.orderBy("vec_id").toPandas()
    ids, x = table.vec_id.to_numpy(), np.stack(table.vector).astype(float)
    hits = 0
    for query, part in found.groupby("query_id"):
        part = part.sort_values("rank")
        distance = np.sqrt(((x - x[ids == query]) ** 2).sum(axis=1))
        distance[ids == query] = np.inf
        assert part["rank"].tolist() == list(range(1, 11))
        assert part.score.tolist() == distance[np.searchsorted(ids, part.vec_id)].tolist()
        hits += len(set(part.vec_id) & set(ids[np.lexsort((ids, distance))[:10]]))
    assert len(set(found.query_id)) == (ids % 100 == 0).sum()
    assert hits >= 0.9 * len(found)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 4), 1.0]) for i in range(40)]
    rows += [(40, None), (41, [0.0, 0.0]), (42, [nan, 1.0]), (43, [inf, 1.0]), (44, [1.0, None]), (45, [1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<float>")
    found = neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    for query in (0, 20):
        own = [r for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == query]
        equal = [i for i in range(0, 40, 4) if i != query]
        assert [r.vec_id for r in own] == [*equal, 1] and [r.score for r in own] == [0.0] * 9 + [1.0]
    assert {r.query_id for r in found} == {0, 20}
    few = frame.filter("vec_id < 3")
    assert sorted((r["rank"], r.vec_id) for r in neighbours.nearest(few, F.col("vec_id") == 0).collect()) == [(1, 1), (2, 2)]
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0


def brute_neighbours(rows, query, count=10):
    """The nearest other rows of a query, (vec_id, distance), ties by smaller id."""
    own = dict(rows)[query]
    far = [(math.dist(np.float32(own), np.float32(v)), i) for i, v in rows if i != query]
    return [(i, pytest.approx(d)) for d, i in sorted(far)[:count]]


@pytest.mark.parametrize("n", [5, 8, 11, 16, 20, 40])
def test_few_vectors_are_searched_whole(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(n)]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id bigint, vector array<float>"), F.col("vec_id") < 2).collect()
    for query in (0, 1):
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        assert [(r.vec_id, r.score) for r in own] == brute_neighbours(rows, query)


def test_ties_between_different_vectors_go_to_smaller_ids(spark):
    signs = [[float(i == j) * s for j in range(16)] for s in (1, -1) for i in range(16)]
    rows = [(0, [3.0] * 16), *((i + 1, v) for i, v in enumerate(signs)), *((i + 40, v) for i, v in enumerate(signs[:4]))]
    large = [(i, [x + 1e6 for x in v]) for i, v in rows]
    for given in (rows, large):
        frame = spark.createDataFrame(given, "vec_id bigint, vector array<float>")
        found = neighbours.nearest(frame, F.col("vec_id").isin(0, 5)).collect()
        for query in (0, 5):
            own = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
            assert [(r.vec_id, r.score) for r in own] == brute_neighbours(given, query)


# --- page text ------------------------------------------------------------------------

PAGE = (
    "<html><head><title>no</title><script>var a='</p>';</script></head><body><nav><a href=x>no</a></nav>"
    "<div class='cookie-notice'>no</div><article><h1>Title &amp; more</h1><p>One\n <b>two<br>three</b><p>four</p>"
    "<aside>no</aside><ul><li>five<li>six</ul></article><section id=comments><p>no</p></section>"
    "<form>no<input value=no></form><footer>no</footer></body></html>"
)


def test_main_text(spark):
    rows = [
        (1, "u", PAGE, "no"),
        (2, None, None, "no"),
        (None, "u", "", "no"),
        (3, "u", "plain &lt;text&gt;", "no"),
        (4, "u", "<p>unclosed <b>bold", "no"),
        (5, "u", "<div>" * 3000 + "deep" + "</div>" * 10, "no"),
        (6, "u", "<nav>only a menu", "no"),
        (7, "u", "<p>" + "long " * 50_000, "no"),
        (1, "u", PAGE, "no"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = extract.pages_text(pages).collect()
    texts = [(r.page_id, r.text) for r in found]
    assert texts.count((1, "Title & more\nOne two three\nfour\nfive\nsix")) == 2
    rest = {k: v for k, v in texts if k != 1}
    assert rest[2] == rest[None] == rest[6] == "" and rest[3] == "plain <text>"
    assert rest[4] == "unclosed bold" and rest[5] == "deep" and len(rest[7]) == 5 * 50_000 - 1
    assert all(r.n_chars == len(r.text) for r in found)
    assert extract.pages_text(pages.limit(0)).count() == 0


def test_given_pages_keep_their_article(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    import html as entities

    for row in extract.pages_text(pages).collect():
        inner = html[row.page_id].partition("<article>")[2].partition("</article>")[0]
        parts = re.split(r"</?h1>|</?p>|<br>", re.sub(r"</?b>", "", inner))
        cleaned = [re.sub(r"\s+", " ", entities.unescape(x)).strip() for x in parts]
        assert row.text == "\n".join(x for x in cleaned if x)


@pytest.mark.parametrize(
    "html",
    [
        "<div class='content-sidebar-wrap'><main><p>kept</p></main></div>",
        "<div class='has-sidebar'><p>kept</p></div>",
        "<div id='page-header-fixed'><p>kept</p></div>",
        "<section class='post comments-open'><p>kept</p></section>",
        "<div class='sidebar-layout'><div class=menu>no</div><article><p>kept</p></article></div>",
        "<form id=aspnetForm><nav>no</nav><article><p>kept</p></article></form>",
        "<form><header>no</header><div><p>kept</p></div></form>",
        "<article><p><math><mi>kept</mi></math></p></article>",
        "<article><p>kept</p><section id=comments><article>no</article></section></article>",
        "<p>kept</p><div class='site-footer'>no</div><form>no</form><div class='cookie-notice'>no</div>",
    ],
)
def test_wrappers_keep_their_article(html):
    assert extract.main_text(f"<html><body>{html}</body></html>") == "kept"


@pytest.mark.parametrize(
    "line",
    [
        "<p class='form'>kept</p>",
        "<h2 id='search-results'>kept</h2>",
        "<h2 id='related-work'>kept</h2>",
        "<p id='comment'>kept</p>",
        "<h3 class='section-header'>kept</h3>",
    ],
)
def test_lines_of_an_article_are_kept_whatever_their_names(line):
    page = f"<body><article><p>first line</p>{line}<p class=ad>buy</p><div class=comments><p>no</p></div></article></body>"
    assert extract.main_text(page) == "first line\nkept"


@pytest.mark.parametrize("tag", ["div", "ul", "div class=menu", "section", "a", "p"])
def test_deep_and_unclosed_tags_take_linear_time(tag):
    inside = "<p>one</p><li>two" * 2000
    start = time.process_time()
    found = extract.main_text(f"<body>{f'<{tag}>' * 100_000}{inside}<article>three</article></body>")
    assert time.process_time() - start < 5
    assert found.splitlines()[-1] == "three"


def test_tags_that_never_end_are_text():
    start = time.process_time()
    assert extract.main_text("<p>x &amp; <a " + "<a " * 50_000) == ("x & <a " + "<a " * 50_000).strip()
    assert time.process_time() - start < 2
    assert extract.main_text("<p>one</p><a title='u > v <b &amp") == "one\n<a title='u > v <b &"


# --- pipeline -------------------------------------------------------------------------


def test_mix_takes_copies_of_a_row_apart(spark):
    """Rows equal in id, source and text: some are taken more often than others, and the sums fit."""
    rows = [(7, "w " * 10, "en", "a")] * 1000 + [(8, "v " * 10, "en", "b")] * 3000 + [(None, None, "en", None)] * 5
    first = mixing.mixed(documents(spark, rows)).collect()
    again = mixing.mixed(documents(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)
    want, taken = brute_targets({"a": 10_000, "b": 30_000, None: 0}), collections.Counter()
    for r in first:
        taken[r.source] += r.taken
    assert len(first) == 4005 and taken[None] == 0
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in "ab")


def test_pipeline_decides_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, SMALL).cache()
        assert docs.columns == columns, name
        kept = docs.count()
        assert 0 < kept <= before, name
        before = kept
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert mixed.count() == before
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, mixed.collect()))


def test_stages_of_awkward_rows(spark, awkward, nothing):
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, nothing, SMALL).count() == 0
        apply(spark, awkward, SMALL).collect()


def test_fold_of_null_ids(spark, awkward):
    rows = awkward.select("doc_id", fold("doc_id", 5).alias("f")).collect()
    for r in rows:
        assert r.f == zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5
