"""Exact money arithmetic.

Amounts are columns of doubles at rest, because that is what consumers read. All
arithmetic runs in decimals, so that a total does not depend on the order in
which tasks add it up and half cents round the same way everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Precisions are chosen so that the product below stays within 38 digits.
PRICE = "decimal(14,4)"
UNITS = "decimal(9,0)"
PERCENT = "decimal(7,4)"
HUNDREDTH = "decimal(3,2)"
AMOUNT = "decimal(20,4)"


def line_value(price: Column, units: Column, discount_pct: Column) -> Column:
    """Price x units less a percentage, rounded half up to cents."""
    return F.round(_exact_line(price, units, discount_pct), 2).cast("double")


def _exact_line(price: Column, units: Column, discount_pct: Column) -> Column:
    kept = (F.lit(100) - discount_pct).cast(PERCENT)
    return price.cast(PRICE) * units.cast(UNITS) * kept * F.lit("0.01").cast(HUNDREDTH)


def total(amount: Column) -> Column:
    """Exact sum, in cents, as double."""
    return F.round(F.sum(amount.cast(AMOUNT)), 2).cast("double")


def mean(amount: Column) -> Column:
    """Exact sum over non-null count, rounded to cents."""
    return mean_of(F.sum(amount.cast(AMOUNT)), F.count(amount))


def mean_of(summed: Column, counted: Column) -> Column:
    return F.round(F.try_divide(summed.cast("double"), counted), 2)


def invoice_value(price: Column, units: Column, discount_pct: Column, freight: Column) -> Column:
    """Line value plus freight, rounded once."""
    return F.round(_exact_line(price, units, discount_pct) + freight.cast(AMOUNT), 2).cast("double")
