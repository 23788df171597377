"""Reproducible random columns.

A draw is a hash of the row's key, a name and a seed, never ``rand()``: the value
does not depend on how rows are split over tasks, or on a task being run again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 52
SCALE = 1 << BITS


class Draws:
    """Named draws for one key column.

    ``portable`` takes the bits from MD5 text, which other SQL engines compute
    alike; the default hash is Spark's own and much cheaper.
    """

    def __init__(self, key: str | Column, seed: int, portable: bool = False):
        self.key = F.col(key) if isinstance(key, str) else key
        self.seed = seed
        self.portable = portable

    def bits(self, name: str) -> Column:
        """Uniform integer below 2**52."""
        if self.portable:
            text = F.concat(F.lit(f"{self.seed}:{name}:"), self.key.cast("string"))
            return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
        return F.pmod(F.xxhash64(F.lit(self.seed), F.lit(name), self.key), F.lit(SCALE))

    def unit(self, name: str) -> Column:
        """Uniform in [0, 1)."""
        return self.bits(name) / F.lit(float(SCALE))

    def uniform(self, name: str, low: Column | float, high: Column | float) -> Column:
        low, high = _column(low), _column(high)
        return low + self.unit(name) * (high - low)

    def integer(self, name: str, low: Column | int, high: Column | int) -> Column:
        """Uniform integer in [low, high]."""
        low, high = _column(low), _column(high)
        return (low + F.pmod(self.bits(name), high - low + 1)).cast("int")

    def key_in(self, name: str, count: int) -> Column:
        """Uniform key in [1, count]."""
        return F.pmod(self.bits(name), F.lit(count)) + 1

    def choice(self, name: str, values: Sequence) -> Column:
        return self._pick(name, F.array(*[F.lit(v) for v in values]))

    def choice_by(self, name: str, given: Column, values: Mapping[str, Sequence]) -> Column:
        """Choice from the list that belongs to the value of another column."""
        pairs = [
            part for k, vs in values.items() for part in (F.lit(k), F.array(*[F.lit(v) for v in vs]))
        ]
        return self._pick(name, F.try_element_at(F.create_map(*pairs), given))

    def _pick(self, name: str, options: Column) -> Column:
        place = F.pmod(self.bits(name), F.size(options).cast("bigint")) + 1
        return F.element_at(options, place.cast("int"))

    def uniform_by(
        self, name: str, given: Column, ranges: Mapping[str, tuple[float, float]]
    ) -> Column:
        """Uniform number in the range that belongs to the value of another column."""
        low = _by_value(given, {k: float(r[0]) for k, r in ranges.items()})
        high = _by_value(given, {k: float(r[1]) for k, r in ranges.items()})
        return self.uniform(name, low, high)

    def weighted(self, name: str, weights: Mapping) -> Column:
        """Choice in proportion to the weights."""
        return self.choice(name, slots(weights))

    def chance(self, name: str, probability: float) -> Column:
        return self.unit(name) < probability


def slots(weights: Mapping) -> list:
    """Each value as often as its weight, in the smallest whole numbers."""
    exact = {value: Fraction(str(weight)) for value, weight in weights.items()}
    whole = lcm(*[weight.denominator for weight in exact.values()])
    counts = {value: int(weight * whole) for value, weight in exact.items()}
    unit = gcd(*counts.values())
    return [value for value, count in counts.items() for _ in range(count // unit)]


def _by_value(given: Column, values: Mapping[str, float]) -> Column:
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), given)


def _column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
