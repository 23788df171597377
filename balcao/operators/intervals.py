"""Which of many intervals are open on a day, without a row per interval and day.

Days are grouped in spans of 1, 2, 4, ... days, each half of the next larger one. An
interval is the union of few whole spans, at most two of each size, and a day lies in one span of each
size. So an interval is written to the spans that make it up, a day looks at the spans it
lies in, and the two meet by equality: how many intervals are open, and the smallest of
their ids, are sums and minima over those spans. An interval of a week forms about
four rows, one of a century about twenty.

The n-th open interval by id is found from coarse to fine: ids are numbered in order,
and the numbers cut into 16 ranges, each of these into 16, and so on. At each
level the spans of every range still asked for tell how much of it is open in each of its 16
parts; the part that holds the n-th one is next. There are as many levels as the
number of intervals has hexadecimal digits.

What is found for spans, places and answers grows with the input, and stored files of it are many times
smaller than its rows in memory. Joins with it are shuffled at every size, so none of it
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.operators.ordered import position, with_prefix
from balcao.operators.spreading import left_lookup, shuffled
from balcao.sources.scratch import stage

#: Sizes of spans, as powers of two; days are counted from the year 1 and end in 9999.
_SIZES = 22
_YEAR_ONE = -719_162

_BITS = 4
_PARTS = 1 << _BITS


def _number(day: str) -> Column:
    return F.unix_date(day).cast("bigint") - F.lit(_YEAR_ONE)


def _span(size: str, place: str) -> str:
    """One number for a span, from its size and its place among those of its size."""
    return f"shiftleft(1L, {_SIZES} - {size}) + ({place})"


def known_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals (id, first, last) that have a day: both ends known and in order."""
    return intervals.filter(F.col("first") <= F.col("last"))


def spans_of(intervals: DataFrame, *keep: str) -> DataFrame:
    """(keep, span): the whole spans that make up each interval."""
    ends = known_intervals(intervals).select(
        *keep, _number("first").alias("_a"), (_number("last") + 1).alias("_b"),
        F.explode(F.sequence(F.lit(0), F.lit(_SIZES))).alias("_size"),
    )
    # Of each size, the spans from l up to but without r lie inside; an odd l, or the one before an
    # odd r, is no half of a larger span inside.
    bounded = ends.select(
        *keep, "_size",
        F.expr("shiftright(_a + shiftleft(1L, _size) - 1, _size)").alias("_l"), F.expr("shiftright(_b, _size)").alias("_r"),
    ).filter("_l < _r")
    left = F.expr(f"if(_l % 2 = 1, {_span('_size', '_l')}, null)")
    right = F.expr(f"if(_r % 2 = 1, {_span('_size', '_r - 1')}, null)")
    return bounded.select(*keep, F.explode(F.array_compact(F.array(left, right))).alias("span"))


def spans_around(days: DataFrame) -> DataFrame:
    """The rows of ``days``, once for each span that their day lies in."""
    sizes = F.explode(F.sequence(F.lit(0), F.lit(_SIZES))).alias("_size")
    numbered = days.filter(F.col("day").isNotNull()).select("*", _number("day").alias("_n"), sizes)
    return numbered.withColumn("span", F.expr(_span("_size", "shiftright(_n, _size)"))).drop("_n", "_size")


def open_on(days: DataFrame, intervals: DataFrame) -> DataFrame:
    """(day, n, least): number and smallest id of the intervals open on each of the distinct days.

    Days on which none is open are left out.
    """
    held = spans_of(intervals, "id").groupBy("span").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    met = spans_around(days.select("day")).join(shuffled(held), "span")
    return met.groupBy("day").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def _ranked_spans(intervals: DataFrame) -> tuple[DataFrame, int]:
    """(rank, id, span) of the intervals numbered by id from 0, stored, and the levels of their numbers."""
    kept = known_intervals(intervals).select("id", "first", "last")
    ranked = with_prefix(kept, [], ["id", "first", "last"], place=position()).withColumn("rank", F.col("place") - 1)
    spans = stage(spans_of(ranked, "rank", "id"), "trechos")
    top = spans.agg(F.max("rank")).first()[0] or 0
    return spans, max(1, -(-top.bit_length() // _BITS))


def _open_before(places: DataFrame, spans: DataFrame, level: int) -> DataFrame:
    """Of each distinct (range, day) how many intervals are open in the parts before each part, and in all."""
    parts = F.pmod(F.shiftright("rank", _BITS * level), F.lit(_PARTS))
    held = spans.groupBy(F.shiftright("rank", _BITS * (level + 1)).alias("range"), "span").agg(
        *[F.count_if(parts <= i).alias(f"open_{i}") for i in range(_PARTS)]
    )
    met = spans_around(places).join(shuffled(held), ["range", "span"])
    sums = [F.sum(f"open_{i}") for i in range(_PARTS)]
    return met.groupBy("range", "day").agg(F.array(F.lit(0).cast("bigint"), *sums).alias("before"))


def _part() -> Column:
    """Part of a range that holds its k-th open interval."""
    return F.size(F.filter("before", lambda n: n <= F.col("k"))) - 1


def pick_open(rows: DataFrame, day: str, pick: str, intervals: DataFrame, row_key: str, name: str) -> DataFrame:
    """Rows with the id, as ``name``, of one of the intervals open on their day: number ``pick`` modulo how many there are.

    The intervals count by id, from 0; the id is null where none is open. Rows meet one row per
    day, and one per day and place that rows ask for, by equality, and null days are spread by ``row_key``.
    """
    spans, levels = _ranked_spans(intervals)
    days = rows.select(F.lit(0).cast("bigint").alias("range"), F.col(day).alias("day")).distinct()
    top = stage(_open_before(days, spans, levels - 1).select(F.col("day").alias(day), F.col("before").alias("_abertos")), "abertos")
    placed = left_lookup(rows, top, day, row_key).withColumn("_nth", F.pmod(F.col(pick), F.element_at("_abertos", -1)))
    asked = placed.select(
        F.col(day).alias("day"), F.col("_nth").alias("nth"), F.col("_nth").alias("k"), F.col("_abertos").alias("before")
    )
    asked = asked.filter("nth is not null").withColumn("part", _part()).select(
        "day", "nth", F.col("part").cast("bigint").alias("range"), (F.col("k") - F.get("before", F.col("part"))).alias("k")
    )
    found = _descended(asked.distinct(), spans, levels - 1)
    named = found.select(F.col("day").alias(day), F.col("nth").alias("_nth"), F.col("id").alias(name))
    return left_lookup(placed.drop("_abertos", name), shuffled(named), [day, "_nth"], row_key).drop("_nth")


def nth_open(questions: DataFrame, intervals: DataFrame) -> DataFrame:
    """(day, nth, id): the nth interval, from 0 and by id, of those open on a day.

    ``questions`` has distinct (day, nth); those without an answer are left out.
    """
    spans, levels = _ranked_spans(intervals)
    asked = questions.filter("day is not null and nth >= 0")
    asked = asked.select("day", "nth", F.lit(0).cast("bigint").alias("range"), F.col("nth").cast("bigint").alias("k"))
    return _descended(asked, spans, levels)


def _descended(asked: DataFrame, spans: DataFrame, levels: int) -> DataFrame:
    """(day, nth, id) from (day, nth, range, k): the range's k-th open interval, over so many more levels."""
    for level in reversed(range(levels)):
        asked = stage(asked, "perguntas")
        counts = _open_before(asked.select("range", "day").distinct(), spans, level)
        found = asked.join(shuffled(counts), ["range", "day"]).filter(F.col("k") < F.element_at("before", -1))
        asked = found.withColumn("part", _part()).select(
            "day", "nth", (F.col("range") * _PARTS + F.col("part")).alias("range"),
            (F.col("k") - F.get("before", F.col("part"))).alias("k"),
        )
    ids = spans.groupBy(F.col("rank").alias("range")).agg(F.first("id").alias("id"))
    return asked.join(shuffled(ids), "range").select("day", "nth", "id")
