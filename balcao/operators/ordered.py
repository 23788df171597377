"""Operators that depend on row order within a group.

A plain window gathers a whole group in one task. ``with_prefix`` does not: it
cuts the ordered rows into blocks of similar size, works inside each block, and
carries only one summary row per group and block across block borders. A group
that holds most of the table is thus spread over as many tasks as any other data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from balcao.sources.scratch import stage

BLOCK = "_bloco"


def latest_n(df: DataFrame, group: Sequence[str], newest_first: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` newest rows of each group.

    Spark limits each group to ``n`` rows per task before the shuffle, so the
    size of a group does not matter.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*newest_first))
    return df.withColumn("_vez", place).filter(F.col("_vez") <= n).drop("_vez")


def latest_per_group(df: DataFrame, group: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    return latest_n(df, group, newest_first, 1)


@dataclass(frozen=True)
class Prefix:
    """A value that depends on the rows before (or up to) the current one.

    inside   value from the rows of the same block
    summary  aggregate of one whole block, given the order columns
    carry    summary of all earlier blocks of the group
    combine  joins carry and inside into the result
    """

    inside: Callable[[WindowSpec], Column]
    summary: Callable[[Sequence[str]], Column]
    carry: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]


def previous(value: str) -> Prefix:
    """Last non-null value of an earlier row."""

    def last_of_block(order: Sequence[str]) -> Column:
        known = F.when(F.col(value).isNotNull(), F.struct(*order))
        return F.max_by(value, known)

    return Prefix(
        inside=lambda w: F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        summary=last_of_block,
        carry=lambda summary: F.last(summary, True),
        combine=lambda carried, here: F.coalesce(here, carried),
    )


def running_max(value: str) -> Prefix:
    """Largest value up to and including the current row."""
    return Prefix(
        inside=lambda w: F.max(value).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        summary=lambda order: F.max(value),
        carry=F.max,
        combine=F.greatest,
    )


def position() -> Prefix:
    """Place of the row in its group, from 1."""
    return Prefix(
        inside=lambda w: F.row_number().over(w).cast("bigint"),
        summary=lambda order: F.count(F.lit(1)),
        carry=F.sum,
        combine=lambda carried, here: F.coalesce(carried, F.lit(0)) + here,
    )


def with_prefix(
    df: DataFrame, group: Sequence[str], order: Sequence[str], **wanted: Prefix
) -> DataFrame:
    """Add one column per ``Prefix``; ``order`` must be unique within a group."""
    blocked = _in_blocks(df, group, order)
    inside = Window.partitionBy(*group, BLOCK).orderBy(*order)
    here = blocked.withColumns({name: prefix.inside(inside) for name, prefix in wanted.items()})
    carried = _carried(blocked, group, order, wanted)
    same = F.lit(True)
    for name in (*group, BLOCK):
        same = same & F.col(name).eqNullSafe(F.col(f"_de_{name}"))
    combined = here.join(F.broadcast(carried), same, "left").withColumns(
        {
            name: prefix.combine(F.col(f"_de_{name}"), F.col(name))
            for name, prefix in wanted.items()
        }
    )
    return combined.select(*df.columns, *wanted)


def _carried(
    blocked: DataFrame, group: Sequence[str], order: Sequence[str], wanted: Mapping[str, Prefix]
) -> DataFrame:
    """What each block takes over from earlier blocks: at most one row per block.

    Rows are ordered by group first, so only the group that a block begins with
    can have begun before.
    """
    ends = blocked.groupBy(*group, BLOCK).agg(
        *[prefix.summary(order).alias(f"_fim_{name}") for name, prefix in wanted.items()]
    )
    blocks_of_group = Window.partitionBy(*group).orderBy(BLOCK)
    earlier = blocks_of_group.rowsBetween(Window.unboundedPreceding, -1)
    taken = {
        f"_de_{name}": prefix.carry(F.col(f"_fim_{name}")).over(earlier)
        for name, prefix in wanted.items()
    }
    placed = ends.withColumns({"_lugar": F.row_number().over(blocks_of_group), **taken})
    renamed = [F.col(name).alias(f"_de_{name}") for name in (*group, BLOCK)]
    return placed.filter(F.col("_lugar") > 1).select(*renamed, *taken)


def _in_blocks(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number the partitions of an ordering by group and order, and write them.

    Adaptive execution merges neighbouring partitions of a small table, which keeps
    their order. Block borders come from a sample, so they are fixed by writing the
    table once: rows and summaries must see the same ones.
    """
    ranged = df.repartitionByRange(*group, *order)
    return stage(ranged.withColumn(BLOCK, F.spark_partition_id()), "blocos")
