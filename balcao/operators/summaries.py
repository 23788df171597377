"""Declared summaries: keys, measures and order of a mart.

A measure consists of parts that add up (counts, exact sums, maxima) and a last
step that turns the merged parts into the reported value. Marts can therefore be
computed from the rows, or from one finer summary that several marts share, with
the same result. Measures are declared by name and built when a session exists.

Distinct whole-number ids add up as bitmaps: a summary that does not keep the id as a
key holds, per range of ids (a bucket of 32,768), a bit for each id seen. Bitmaps of a
bucket merge by OR, their counts add up over buckets, and so every coarser count is exact.
A sale has one id and hence one bucket, so sums and counts are split over buckets and add up, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.functions import money


@dataclass(frozen=True)
class Part:
    """An aggregate over rows, and how its values over finer groups combine."""

    name: str
    of_rows: Callable[[], Column]
    merge: Callable[[str], Column] | None = F.sum
    ids: str | None = None  # column whose distinct values are counted


@dataclass(frozen=True)
class Measure:
    parts: Sequence[Part]
    finish: Callable[..., Column]


def _count(column: str) -> Part:
    return Part(f"n_{column}", lambda: F.count(column))


def _sum(column: str) -> Part:
    return Part(f"soma_{column}", lambda: F.sum(F.col(column).cast(money.AMOUNT)))


def known(column: str) -> Measure:
    """Rows in which the column is not null."""
    return Measure([_count(column)], lambda n: n)


def units(column: str) -> Measure:
    """Sum of whole numbers."""
    return Measure([Part(f"itens_{column}", lambda: F.sum(column))], lambda total: total)


def amount(column: str) -> Measure:
    return Measure([_sum(column)], lambda total: F.round(total, 2).cast("double"))


def mean(column: str) -> Measure:
    return Measure([_sum(column), _count(column)], money.mean_of)


def latest(column: str, finish: Callable[[Column], Column] = lambda day: day) -> Measure:
    return Measure([Part(f"ultimo_{column}", lambda: F.max(column), F.max)], finish)


def share_pct(name: str, condition: str, of: str) -> Measure:
    """Percentage of the known rows that meet a condition."""
    hits = Part(f"n_{name}", lambda: F.count_if(F.expr(condition)))
    return Measure([hits, _count(of)], lambda n, whole: F.round(F.try_divide(n * 100, whole), 2))


def distinct(column: str) -> Measure:
    """Distinct values. A finer summary keeps the column as a key, or bitmaps of whole-number ids."""
    exact = Part(f"distintos_{column}", lambda: F.countDistinct(column), None, column)
    return Measure([exact], lambda n: n)


def _parts(measures: Iterable[Measure]) -> dict[str, Part]:
    return {part.name: part for measure in measures for part in measure.parts}


def _finished(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    values = [
        measure.finish(*[F.col(part.name) for part in measure.parts]).alias(name)
        for name, measure in measures.items()
    ]
    return df.select(*keys, *values)


def summarize(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """Measures per key, from rows."""
    parts = _parts(measures.values()).values()
    grouped = df.groupBy(*keys).agg(*[part.of_rows().alias(part.name) for part in parts])
    return _finished(grouped, keys, measures)


BUCKET = "_balde"


def _counted_ids(keys: Sequence[str], parts: Iterable[Part]) -> Part | None:
    """The part that needs bitmaps: its ids are not among the keys."""
    found = [part for part in parts if part.ids and part.ids not in keys]
    if len(found) > 1:
        raise ValueError(f"one kind of ids per summary, not {[part.ids for part in found]}")
    return found[0] if found else None


def fine_summary(df: DataFrame, keys: Sequence[str], measures: Iterable[Measure]) -> DataFrame:
    """The parts that add up, per combination of all keys: one pass for many marts.

    Where distinct ids are counted that are no key, there is a row per combination and bucket
    of ids. Rows are first combined per id, which takes what a frequent id weighs out of the
    shuffle; each bucket's at most 32,768 ids then meet in one task, so that its bitmap of 4 KB
    is made once, not once per task that saw one of its ids.
    """
    parts = _parts(measures).values()
    additive = [part for part in parts if part.merge]
    ids = _counted_ids(keys, parts)
    if ids is None:
        return df.groupBy(*keys).agg(*[part.of_rows().alias(part.name) for part in additive])
    bucketed = df.withColumn(BUCKET, F.bitmap_bucket_number(ids.ids))
    per_id = bucketed.groupBy(*keys, BUCKET, ids.ids).agg(*[part.of_rows().alias(part.name) for part in additive])
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(ids.ids)).alias(ids.name)
    merged = [part.merge(part.name).alias(part.name) for part in additive]
    return per_id.repartition(*keys, BUCKET).groupBy(*keys, BUCKET).agg(*merged, bits)


def roll_up(fine: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """Measures per key, from a finer summary."""
    parts = _parts(measures.values()).values()
    ids = next((part for part in parts if part.ids and part.name in fine.columns), None)
    if ids is not None:
        # Bitmaps meet within their bucket; their counts are then parts like others.
        merged = [part.merge(part.name).alias(part.name) for part in parts if part.merge]
        bits = F.bitmap_count(F.bitmap_or_agg(ids.name)).alias(ids.name)
        fine = fine.groupBy(*keys, BUCKET).agg(*merged, bits)
        counted = {ids.name: F.sum(ids.name)}
    else:
        counted = {}
    merged = fine.groupBy(*keys).agg(
        *[
            counted.get(part.name, part.merge(part.name) if part.merge else part.of_rows()).alias(part.name)
            for part in parts
        ]
    )
    return _finished(merged, keys, measures)


@dataclass(frozen=True)
class Mart:
    """One row per key. ``rank_by`` sorts downwards, with the keys breaking ties.

    A mart whose rows grow with the data (``grows``) is left unsorted, as a stored
    table keeps no order that readers may rely on; ``in_order`` sorts it at reading.
    """

    keys: Sequence[str]
    measures: Mapping[str, Measure]
    rank_by: str | None = None
    top: int | None = None
    grows: bool = False

    def of(self, df: DataFrame) -> DataFrame:
        """From rows."""
        return self.arrange(summarize(df, self.keys, self.measures))

    def of_summary(self, fine: DataFrame) -> DataFrame:
        """From a finer summary that has the mart's keys and parts."""
        return self.arrange(roll_up(fine, self.keys, self.measures))

    def arrange(self, df: DataFrame) -> DataFrame:
        if self.top is None:
            return df if self.grows else self.in_order(df)
        return self.in_order(df).limit(self.top)

    def in_order(self, df: DataFrame) -> DataFrame:
        ranked = [F.desc(self.rank_by)] if self.rank_by else []
        return df.orderBy(*ranked, *self.keys)
