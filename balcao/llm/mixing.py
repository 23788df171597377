"""Mix sources to target weights by entropy balancing.

Sizes are words. The sources, ordered by code point with null last, get the given
weights in turn; each source's target is its share of all words, stopped at
``MOST`` times its own words, the excess being shared again by weight.

Document rates are those closest in (bounded) entropy to one copy each that meet
the targets: rate = MOST / (1 + (MOST - 1) * exp(-tilt * x)), with
x = sqrt(size / mean size of the source), so a long document bends more than a
short one and no rate leaves 0 to MOST. The tilt of each source solves the convex
dual by Newton steps, kept inside a bracket; each step is one aggregation over a
histogram of (source, size), far smaller than the documents. Rates become whole
copies by a hash of the document, and what rounding leaves over is settled by
adding or removing single copies, largest fitting documents first, found with
bounded histograms per source.

Sums of rates are taken in decimals, so that tilts depend on the rows alone, not on
how they are spread or in what order they are added.

Null text and text without words have size 0 and take 0. Null is a source. Rows
repeated in full are numbered and drawn for one by one, so that they need not all be
taken equally often. An empty table gives an empty result. Only ``doc_id``, ``source``
and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from balcao.operators.ordered import position, with_prefix
from balcao.sources.scratch import stage

MOST = 3
WEIGHTS = (5, 2, 1)
ROUNDS = 5
_STEPS = 1 << 30
_BINS = 256
_STEEPEST = 500.0
#: Sums of rates, to a millionth of a word.
_WORDS = "decimal(38,6)"
#: Repeated rows that one task writes out.
_TOGETHER = 100_000


def sized(documents: DataFrame) -> DataFrame:
    """Document sizes in words, with a hash that rounding draws from, another one for each copy of a row."""
    drawn = documents.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("doc_id", "source", "text").alias("draw"),
    )
    counted = drawn.groupBy("doc_id", "source", "size", "draw").agg(F.count(F.lit(1)).alias("times"))
    # Runs of copies are dealt out before they are written out, so that no task has a whole hot group.
    starts = F.sequence(F.lit(1).cast("bigint"), "times", F.lit(_TOGETHER).cast("bigint"))
    runs = counted.withColumn("first", F.explode(starts)).repartition("draw", "first")
    last = F.least(F.col("times"), F.col("first") + F.lit(_TOGETHER - 1))
    single = runs.withColumn("copy", F.explode(F.sequence("first", last)))
    draw = F.when(F.col("copy") == 1, F.col("draw")).otherwise(F.xxhash64("draw", "copy"))
    return single.select("doc_id", "source", "size", draw.alias("draw"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to rows of (source, source_size)."""
    placed = with_prefix(
        sources.withColumn("last", F.col("source").isNull()), [], ["last", "source"], place=position()
    )
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, len(weights)).cast("int") + 1)
    weighted = stage(
        placed.select("source", "source_size", turn.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("top")),
        "fontes",
    )
    total = float(weighted.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        at_top = F.col("weight") * F.lit(level) >= F.col("top")
        tops, count, open_weight = weighted.agg(
            F.coalesce(F.sum(F.when(at_top, F.col("top"))), F.lit(0.0)),
            F.count_if(at_top),
            F.coalesce(F.sum(F.when(~at_top, F.col("weight"))), F.lit(0.0)),
        ).first()
        if count == stopped or not open_weight:
            break
        level, stopped = (total - tops) / open_weight, count
    return weighted.select("source", "source_size", F.least("top", F.col("weight") * F.lit(level)).alias("target"))


def _rate(tilt: Column, x: Column, most: int) -> Column:
    return F.lit(float(most)) / (1 + (most - 1) * F.exp(F.least(F.lit(700.0), -tilt * x)))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def tilts(histogram: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """Add ``tilt`` to the sources, so that the rates of (source, size, n) meet ``target``."""
    known = sources.withColumns({"tilt": F.lit(0.0), "low": F.lit(-_STEEPEST), "high": F.lit(_STEEPEST)})
    for _ in range(40):
        own = known.withColumnRenamed("source", "of")
        x = F.sqrt(F.col("size") / F.col("mean"))
        rate = _rate(F.col("tilt"), x, most)
        words = F.col("n") * F.col("size") * rate
        sums = (
            histogram.filter("size > 0")
            .join(own, _same("source", "of"))
            .groupBy("source")
            .agg(F.sum(words.cast(_WORDS)).alias("words"), F.sum((words * (1 - rate / most) * x).cast(_WORDS)).alias("bend"))
            .select(F.col("source").alias("of"), *[F.col(c).cast("double").alias(c) for c in ("words", "bend")])
        )
        off = F.coalesce(F.col("words"), F.lit(0.0)) - F.col("target")
        low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(off, F.col("bend"))
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
        ahead = F.when(off == 0, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2)
        moved = stage(
            known.join(sums, _same("source", "of"), "left").select(
                "source",
                "source_size",
                "mean",
                "target",
                ahead.alias("tilt"),
                low.alias("low"),
                high.alias("high"),
                (F.abs(off) / F.greatest(F.col("target"), F.lit(1.0))).alias("off"),
                (high - low).alias("width"),
            ),
            "inclinacao",
        )
        known = moved.drop("off", "width")
        if not moved.filter("off > 1e-7 and width > 1e-6 and source_size > 0").limit(1).count():
            break
    return known.drop("low", "high")


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, rate, copies."""
    docs = stage(sized(documents), "tamanhos")
    histogram = stage(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histograma")
    sums = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n")
    )
    aimed = targets(stage(sums, "somas").select("source", "source_size"), weights, most)
    means = histogram.groupBy(F.col("source").alias("of")).agg(
        F.greatest(F.sum(F.col("size") * F.col("n")) / F.sum("n"), F.lit(1.0)).alias("mean")
    )
    sources = tilts(histogram, aimed.join(means, _same("source", "of")).drop("of"), most)
    rate = _rate(F.col("tilt"), F.sqrt(F.col("size") / F.col("mean")), most)
    uniform = F.pmod(F.col("draw"), _STEPS) / F.lit(float(_STEPS))
    copies = F.least(F.lit(most), F.floor(F.col("rate") + uniform).cast("int"))
    rated = docs.join(sources.withColumnRenamed("source", "of"), _same("source", "of"))
    placed = stage(
        rated.withColumn("rate", rate).select("doc_id", "source", "size", "draw", "rate", copies.alias("copies")), "copias"
    )
    for k in range(ROUNDS):
        placed = _settled(placed, sources.select("source", "target"), k, most)
    own = sources.withColumnRenamed("source", "of")
    return placed.join(own, _same("source", "of")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
        "source",
        "rate",
        "copies",
    )


def _settled(placed: DataFrame, sources: DataFrame, k: int, most: int) -> DataFrame:
    """One round that brings each source's words nearer its target by single copies.

    Documents that fit what is missing (or too much) are ordered by size class,
    largest first, and within it by hash; the longest run of these bins that fits
    is taken. A source has at most 64 classes of ``_BINS`` bins.
    """
    taken = placed.groupBy(F.col("source").alias("of")).agg(F.sum(F.col("copies") * F.col("size")).alias("words"))
    rest = stage(
        sources.join(taken, _same("source", "of")).select("of", (F.col("target") - F.col("words")).alias("missing")),
        "resto",
    )
    size_class = 63 - F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)))).cast("int")
    bin_of = size_class * _BINS + F.pmod(F.xxhash64(F.lit(k), "draw"), _BINS).cast("int")
    fits = (F.col("size") > 0) & (F.col("size") <= F.abs("missing"))
    fits = fits & F.when(F.col("missing") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
    bins = (
        placed.join(rest, _same("source", "of"))
        .filter(fits)
        .groupBy("source", bin_of.alias("bin"))
        .agg(F.sum("size").alias("words"), F.max(F.abs("missing")).alias("room"))
    )
    so_far = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    last = (
        bins.withColumn("so_far", so_far)
        .filter("so_far <= room")
        .groupBy(F.col("source").alias("in"))
        .agg(F.max("bin").alias("last"))
    )
    chosen = stage(
        rest.join(last, _same("of", "in"), "left").select("of", "missing", F.coalesce("last", F.lit(-1)).alias("last")),
        "limite",
    )
    step = F.when(fits & (bin_of <= F.col("last")), F.signum("missing").cast("int")).otherwise(0)
    moved = placed.join(chosen, _same("source", "of"))
    return stage(
        moved.select("doc_id", "source", "size", "draw", "rate", (F.col("copies") + step).alias("copies")), "copias"
    )
