"""Lookups into other tables.

Tables that grow with the input are shuffled at every size: two columns of a stored file
are many times smaller than their rows in memory, and the driver builds what is broadcast.
Adaptive execution splits a partition that a hot key has made too large. Null keys match
nothing, so they are scattered over the tasks instead of meeting in one. Which coupons are
valid on which days is found by ``intervals``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.operators import intervals
from balcao.operators.spreading import left_lookup, shuffled
from balcao.sources.scratch import stage


def lookup_default(
    df: DataFrame, other: DataFrame, key: str, column: str, default: object, row_key: str
) -> DataFrame:
    """Add ``column`` of ``other`` by ``key``, with ``default`` where nothing is found."""
    found = left_lookup(df, shuffled(other.select(key, column)), key, row_key)
    return found.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def _coupon_intervals(coupons: DataFrame) -> DataFrame:
    return coupons.select(
        F.col("cupom_id").alias("id"), F.col("validade_inicio").alias("first"), F.col("validade_fim").alias("last")
    )


def valid_pairs_per_day(sales: DataFrame, coupons: DataFrame) -> DataFrame:
    """Number of (sale, valid coupon) pairs per sale day, without forming the pairs."""
    sold = sales.groupBy(F.col("data_venda").alias("day")).agg(F.count(F.lit(1)).alias("vendas"))
    sold = stage(sold.filter(F.col("day").isNotNull()), "vendas-dia")
    return sold.join(intervals.open_on(sold, _coupon_intervals(coupons)), "day").select(
        F.col("day").alias("data_venda"), "vendas", F.col("n").alias("cupons"), F.col("least").alias("menor_cupom"),
        (F.col("vendas") * F.col("n")).alias("pares"),
    )


def smallest_valid_coupon(sales: DataFrame, coupons: DataFrame, row_key: str = "venda_id") -> DataFrame:
    """Each sale with the smallest id among the coupons valid on its day."""
    days = sales.select(F.col("data_venda").alias("day")).distinct()
    valid = intervals.open_on(days, _coupon_intervals(coupons))
    per_day = valid.select(F.col("day").alias("data_venda"), F.col("least").alias("cupom_id"))
    return left_lookup(sales, per_day, "data_venda", row_key)


def assign_valid_coupon(sales: DataFrame, coupons: DataFrame, eligible: Column, pick: Column, row_key: str) -> DataFrame:
    """Give each eligible sale one of the coupons valid on its day, as ``cupom_id``.

    A sale takes number ``pick`` modulo the number of coupons valid on its day, in the order
    of their ids. Both the number and the coupon are equality joins on what is found for each
    day, and each day and number, that sales ask for: no sale ever meets all the
    coupons of its day, and no coupon unfolds into days. Sales that are not eligible, or
    have no valid coupon, keep a null; they stay where they are.
    """
    can_have = F.coalesce(eligible, F.lit(False))
    drawn = sales.filter(can_have).withColumn("_sorteio", pick)
    chosen = intervals.pick_open(drawn, "data_venda", "_sorteio", _coupon_intervals(coupons), row_key, "cupom_id")
    chosen = chosen.drop("_sorteio")
    without = sales.filter(~can_have).withColumn("cupom_id", F.lit(None).cast(coupons.schema["cupom_id"].dataType))
    return chosen.unionByName(without)
