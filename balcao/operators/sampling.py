"""Exact sampling without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from balcao.functions.draws import BITS, Draws
from balcao.operators.ordered import position, with_prefix
from balcao.sources.scratch import stage

COARSE = BITS - 16
FINE = BITS - 32


def sample_exact(
    df: DataFrame, key: str, fraction: float, seed: int = 0, portable: bool = False
) -> DataFrame:
    """Exactly ``floor(rows * fraction)`` rows, chosen by a hash of ``key`` (never null).

    The cut is the n-th smallest hash. Two histograms of at most 65,536 buckets
    close in on it, so the rows themselves are only filtered, never sorted. ``df``
    is read several times and should be a stored table. Where the cut falls among
    copies of one key, as many of them as needed are taken.
    """
    draw = Draws(key, seed, portable).bits("amostra")
    wanted = int(df.count() * fraction)
    if wanted <= 0:
        return df.limit(0)
    rows = df.select(draw.alias("sorteio"), F.col(key).alias("chave"))
    coarse, wanted = _bucket_of(rows, F.shiftright("sorteio", COARSE), wanted)
    rows = rows.filter(F.shiftright("sorteio", COARSE) == coarse)
    fine, wanted = _bucket_of(rows, F.shiftright("sorteio", FINE), wanted)
    # What is left are the keys of one bucket in 2**32, counted per key.
    keys = rows.filter(F.shiftright("sorteio", FINE) == fine).groupBy("sorteio", "chave")
    cut, wanted = _reached(keys, ["sorteio", "chave"], wanted)
    at_cut = (draw == cut["sorteio"]) & (F.col(key) == cut["chave"])
    before = (draw < cut["sorteio"]) | ((draw == cut["sorteio"]) & (F.col(key) < cut["chave"]))
    if wanted == cut["linhas"]:
        return df.filter(before | at_cut)
    return df.filter(before).unionByName(_some(df.filter(at_cut), wanted))


def _some(copies: DataFrame, wanted: int) -> DataFrame:
    """Any ``wanted`` rows. Their numbers are written once, so they stay the same."""
    numbered = stage(copies.withColumn("_numero", F.monotonically_increasing_id()), "copias")
    placed = with_prefix(numbered, [], ["_numero"], _lugar=position())
    return placed.filter(F.col("_lugar") <= wanted).select(*copies.columns)


def _bucket_of(rows: DataFrame, bucket: Column, wanted: int) -> tuple[int, int]:
    """Bucket that holds row number ``wanted``, and that row's number inside it."""
    hit, rest = _reached(rows.groupBy(bucket.alias("faixa")), ["faixa"], wanted)
    return hit["faixa"], rest


def _reached(groups, order: list[str], wanted: int) -> tuple[Row, int]:
    """First group, in order, at which ``wanted`` rows are reached.

    There are few groups, whatever the number of rows, so one task adds them up.
    """
    sizes = groups.agg(F.count(F.lit(1)).alias("linhas"))
    upto = F.sum("linhas").over(Window.orderBy(*order))
    reached = sizes.withColumn("ate", upto).filter(F.col("ate") >= wanted)
    hit = reached.orderBy(*order).limit(1).first()
    return hit, wanted - (hit["ate"] - hit["linhas"])
