"""Columns and bounded samples that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a table that are sent to a Python task at once, about.
BATCH_ROWS = 2000

_HASH_STEPS = 1 << 30


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder. Texts go to Python tasks in batches of ``BATCH_ROWS`` rows at most."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting)) > BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def share_of_rows(share: Column | float, *identity: str) -> Column:
    """True for about this share of the rows, always the same ones."""
    share = F.lit(float(share)) if isinstance(share, (int, float)) else share
    return F.pmod(F.xxhash64(F.lit("sample"), *identity), F.lit(_HASH_STEPS)) < share * _HASH_STEPS


def bounded_rows(rows: DataFrame, bound: int, *identity: str) -> DataFrame:
    """About ``bound`` of the rows at most, chosen by hash; all of them if they are fewer."""
    total = rows.count()
    return rows if total <= bound else rows.filter(share_of_rows(bound / total, *identity))
