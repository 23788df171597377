"""How the rows of a join are dealt out: shuffled at every size, and without a key not to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffled(df: DataFrame) -> DataFrame:
    """A table that joins are to shuffle, however small its files make it look."""
    return df.hint("merge")


def left_lookup(
    df: DataFrame, other: DataFrame, keys: str | Sequence[str], row_key: str
) -> DataFrame:
    """Left join on same-named columns that tolerates many null keys in ``df``.

    ``row_key`` is a column of ``df`` with many values; rows without a key are
    spread by its hash, over as many tasks as there are.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    no_match = F.lit(False)
    for name in names:
        no_match = no_match | F.col(name).isNull()
    spread = F.xxhash64(row_key).bitwiseOR(F.lit(1).cast("bigint"))  # never 0
    salted = df.withColumn("_sal", F.when(no_match, spread).otherwise(F.lit(0).cast("bigint")))
    # Always 0, but not a literal: the planner would drop a constant join key and
    # with it the spreading.
    known = other.withColumn("_sal", F.pmod(F.xxhash64(*names), F.lit(1).cast("bigint")))
    return salted.join(known, [*names, "_sal"], "left").drop("_sal")
