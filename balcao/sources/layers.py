"""Tables of a layered warehouse: publish, append, read back, history, inspection.

A publish writes a new version folder and then logs it; readers follow the log.
A table can therefore be rebuilt from itself, and a failed write leaves the
previous version in place. Every write has a folder of its own, so publishers that
start from the same state do not touch each other's files; the later one is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from balcao.sources import schemas

LOG = "publish_log"


def rows_to_df(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """A few in-memory rows as a table. The schema is declared, so null columns work."""
    return spark.createDataFrame(list(rows), schema)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write ``df`` and return its row count, both from one execution."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("linhas")).write.format(fmt).mode("errorifexists").save(path)
    return seen.get.get("linhas", 0)


def publish_log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(schemas.PUBLISH_LOG).parquet(f"{root}/{LOG}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in (missing.getCondition() or ""):
            return None
        raise


def table_history(
    spark: SparkSession, root: str, layer: str, name: str, n: int | None = 1
) -> DataFrame | None:
    """Last ``n`` publishes of a table, newest first (all of them with ``n=None``)."""
    log = publish_log(spark, root)
    if log is None:
        return None
    mine = log.filter((F.col("camada") == layer) & (F.col("tabela") == name))
    newest_first = mine.orderBy(F.desc("versao"), F.desc("publicado_em"))
    return newest_first if n is None else newest_first.limit(n)


class Version(NamedTuple):
    """One publish of a table, as logged."""

    camada: str
    tabela: str
    versao: int
    operacao: str
    linhas: int
    caminho: str
    publicado_em: datetime


Versions = dict[tuple[str, str], Version]


def latest_versions(spark: SparkSession, root: str) -> Versions:
    """Latest version of every table: one row per table, however long the log is."""
    log = publish_log(spark, root)
    if log is None:
        return {}
    first = ("versao", "publicado_em")
    fields = F.struct(*first, *[f for f in log.columns if f not in first])
    newest = log.groupBy("camada", "tabela").agg(F.max(fields).alias("ultima"))
    rows = newest.select("ultima.*").select(*Version._fields).collect()
    return {(row["camada"], row["tabela"]): Version(*row) for row in rows}


def write_version(
    df: DataFrame, root: str, layer: str, name: str, known: Versions, fmt: str = "parquet"
) -> Version:
    """Write the next version of a table. It counts as published once it is logged."""
    last = known.get((layer, name))
    number = last.versao + 1 if last else 1
    path = f"{root}/{layer}/{name}/v{number:08d}-{uuid.uuid4().hex[:12]}"
    rows = write_counted(df, path, fmt)
    operation = "OVERWRITE" if last else "CREATE"
    return Version(layer, name, number, operation, rows, path, datetime.now(timezone.utc))


def log_versions(spark: SparkSession, root: str, versions: Iterable[Version]) -> None:
    rows = [tuple(version) for version in versions]
    if rows:
        append(rows_to_df(spark, rows, schemas.PUBLISH_LOG).coalesce(1), f"{root}/{LOG}")


def publish_all(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    layer: str,
    fmt: str = "parquet",
) -> dict[str, int]:
    """Overwrite each named table with its frame; returns rows written per table."""
    known = latest_versions(spark, root)
    written = [write_version(df, root, layer, name, known, fmt) for name, df in frames.items()]
    log_versions(spark, root, written)
    return {version.tabela: version.linhas for version in written}


def publish(df: DataFrame, root: str, layer: str, name: str, fmt: str = "parquet") -> int:
    return publish_all(df.sparkSession, {name: df}, root, layer, fmt)[name]


def read_table(
    spark: SparkSession,
    root: str,
    layer: str,
    name: str,
    fmt: str = "parquet",
    known: Versions | None = None,
) -> DataFrame | None:
    """Latest published version of a table; None if it was never published."""
    versions = latest_versions(spark, root) if known is None else known
    newest = versions.get((layer, name))
    return None if newest is None else spark.read.format(fmt).load(newest.caminho)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, as a table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def describe_tables(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Name, type and fill of every column of every table, one pass per table."""
    return reduce(DataFrame.unionByName, [_describe(name, df) for name, df in frames.items()])


def sample_rows(
    frames: Mapping[str, DataFrame], n: int = 5, seed: int = 0, keys: Mapping[str, str] | None = None
) -> DataFrame:
    """``n`` rows of every table as JSON text, drawn by hash: the same ones however the table is spread.

    A row's hash is of all its columns, or, for tables with a key in ``keys``, the MD5 of seed and
    key as text, which other engines compute alike; equal hashes go by the row's text. Each
    task keeps its ``n`` smallest, so a table is read once and not sorted.
    """
    keys = keys or {}

    def drawn(name: str, df: DataFrame) -> DataFrame:
        line = F.to_json(F.struct("*"))
        if name in keys:
            draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(keys[name]).cast("string")).cast("binary"))
        else:
            draw = F.xxhash64(F.lit(seed), line)
        return df.select(F.lit(name).alias("tabela"), draw.alias("sorteio"), line.alias("linha")).orderBy("sorteio", "linha").limit(n)

    samples = [drawn(name, df).select("tabela", "linha") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, samples)


def _describe(name: str, df: DataFrame) -> DataFrame:
    filled = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in df.schema])
    per_column = F.array(
        *[
            F.struct(
                F.lit(position).alias("posicao"),
                F.lit(field.name).alias("coluna"),
                F.lit(field.dataType.simpleString()).alias("tipo"),
                F.col(field.name).alias("preenchidos"),
            )
            for position, field in enumerate(df.schema, 1)
        ]
    )
    return filled.select(F.lit(name).alias("tabela"), F.inline(per_column))
