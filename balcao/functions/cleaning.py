"""Column expressions that clean and label raw values.

Every function takes and returns ``Column`` objects, so the work stays inside
Spark's generated code and filters on the inputs can still reach the file scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and limits that downstream reports filter on.
SCORE_BANDS = [(700, "bom"), (500, "regular")]
SCORE_BELOW = "ruim"
SHIFT_ENDS = [(12, "manhã"), (18, "tarde")]
SHIFT_AFTER = "noite"


def digits_only(value: Column) -> Column:
    """Strip the mask of a tax id."""
    return F.regexp_replace(value, r"\D", "")


def bucketize(value: Column, floors: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the highest floor that ``value`` reaches; null values get ``below``."""
    label = F.lit(below)
    for floor, name in sorted(floors):
        label = F.when(value >= floor, name).otherwise(label)
    return label


def score_band(score: Column) -> Column:
    return bucketize(score, SCORE_BANDS, SCORE_BELOW)


def hour_of_day(clock: Column) -> Column:
    """Hour of an ``HH:mm:ss`` text, or of a timestamp; anything unreadable becomes null."""
    time = F.substring_index(clock.cast("string"), " ", -1)
    return F.substring_index(time, ":", 1).try_cast("int")


def part_of_day(clock: Column) -> Column:
    """Shift of an ``HH:mm:ss`` text. An unknown hour falls into the last shift."""
    hour = hour_of_day(clock)
    label = F.lit(SHIFT_AFTER)
    for end, name in sorted(SHIFT_ENDS, reverse=True):
        label = F.when(hour < end, name).otherwise(label)
    return label


def reference_day(as_of: date | str | None) -> Column:
    """The day reports look back from: a given one, else the day of the run."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def active_on(start: Column, end: Column, as_of: date | str | None = None) -> Column:
    """True where the day lies in [start, end], both ends included."""
    return reference_day(as_of).between(start, end)


def flag_gt(value: Column, limit: float) -> Column:
    return value > limit


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def percent_change(current: Column, previous: Column) -> Column:
    """Change against ``previous`` in percent, two places; null without a base."""
    return F.round((current - previous) * 100 / F.nullif(previous, F.lit(0)), 2)
