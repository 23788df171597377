"""Typing and key checks on raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REJECTED = "colunas_invalidas"


def cast_columns(df: DataFrame, types: Mapping[str, str], on_error: str = "raise") -> DataFrame:
    """Cast columns by name.

    ``raise`` fails on the first value that does not convert, ``null`` blanks such
    values, and ``quarantine`` blanks them and lists the columns concerned in
    ``colunas_invalidas``, so that one pass serves both the good and the bad rows.
    """
    if on_error == "raise":
        return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    if on_error not in ("null", "quarantine"):
        raise ValueError(f"unknown treatment of bad values: {on_error}")
    lenient = {c: F.col(c).try_cast(t) for c, t in types.items()}
    if on_error == "quarantine":
        lost = [
            F.when(F.col(c).isNotNull() & value.isNull(), F.lit(c)) for c, value in lenient.items()
        ]
        lenient[REJECTED] = F.array_compact(F.array(*lost))
    return df.withColumns(lenient)


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows in which any of the key columns is null, as filters a scan can use."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df
