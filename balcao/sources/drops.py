"""Timestamped CSV drops: ``<table>_<yyyyMMdd'T'HHmmss>.csv``, a file or a folder of parts."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

STAMP = r"(\d{8}T\d{6})"
#: What may follow the stamp: a file, compressed or not, or a folder of such parts.
ENDING = r"(\.csv(?:\.(?:gz|bz2|deflate|lz4|snappy|zst))?)(?:$|/part-[^/]+$)"
REJECTED = "registro_invalido"


class DropHeaderError(ValueError):
    """A drop's header does not name the declared columns."""


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a drop, in its own order; () if it holds nothing at all.

    Reads the beginning of one file. The parts of a drop share one header, which the
    scan checks again file by file.
    """
    first = spark.read.option("header", False).option("mode", "PERMISSIVE").csv(path).first()
    return () if first is None else tuple((name or "").lstrip("\ufeff").strip() for name in first)


def _mapped(header: tuple[str, ...], declared: StructType, path: str) -> dict[str, int]:
    """Place of each declared column that a header names, whatever the case."""
    places = [name.lower() for name in header]
    wanted = {field.name.lower(): field.name for field in declared}
    twice = sorted({name for name in places if places.count(name) > 1 and name in wanted})
    if twice:
        raise DropHeaderError(f"{path}: named more than once: {', '.join(twice)}")
    return {wanted[name]: at for at, name in enumerate(places) if name in wanted}


def _read_form(
    spark: SparkSession, paths: list[str], header: tuple[str, ...], declared: StructType, on_error: str
) -> DataFrame:
    """All drops of one header, in one scan, as the declared columns in their declared order.

    The scan goes by position, so its schema has the header's order, and columns that
    are not declared stand in it as text. Spark compares it with the header of every file.
    """
    at = _mapped(header, declared, paths[0])
    missing = [field.name for field in declared if field.name not in at]
    unknown = [name for i, name in enumerate(header) if i not in at.values()]
    if on_error == "raise" and (missing or unknown):
        raise DropHeaderError(f"{paths[0]}: without {missing}, with unknown {unknown}")
    fields = {i: StructField(name, declared[name].dataType) for name, i in at.items()}
    in_order = [fields.get(i, StructField(name or f"_c{i}", StringType())) for i, name in enumerate(header)]
    reader = spark.read.option("header", True).option("enforceSchema", False)
    columns = [
        F.col(f"`{field.name}`") if field.name in at else F.lit(None).cast(field.dataType).alias(field.name)
        for field in declared
    ]
    if on_error == "raise":
        return reader.schema(StructType(in_order)).option("mode", "FAILFAST").csv(paths).select(*columns)
    if on_error == "null":
        return reader.schema(StructType(in_order)).csv(paths).select(*columns)
    kept = reader.option("columnNameOfCorruptRecord", REJECTED)
    rows = kept.schema(StructType([*in_order, StructField(REJECTED, StringType())])).csv(paths)
    rejected = F.col(REJECTED)
    if missing:
        # No row of such a drop is complete; a line that could be read is put together again.
        rejected = F.coalesce(rejected, F.to_csv(F.struct(*[F.col(f"`{field.name}`") for field in in_order])))
    return rows.select(*columns, rejected.alias(REJECTED))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Drops with a header each, whose columns are found by name, in whatever order they stand.

    Values that do not fit the schema fail the read (``raise``), become null
    (``null``), or become null with the whole line kept in ``registro_invalido``
    (``quarantine``). A declared column that a drop lacks fails the read (``raise``), is
    null in its rows (``null``), or is null with all of its rows kept like unreadable ones
    (``quarantine``). A column that is not declared fails the read (``raise``) or is left
    out; ``header_report`` names it. Drops without content have no rows. Drops of the
    same header are read in one scan, however many; a file that differs from the
    header of its drop fails the read.

    Without a schema Spark infers one for each header, at the cost of a pass, and
    columns that only some headers have are null in the other rows.
    """
    if on_error not in ("raise", "null", "quarantine"):
        raise ValueError(f"unknown treatment of bad values: {on_error}")
    paths = [path] if isinstance(path, str) else list(path)
    forms: dict[tuple[str, ...], list[str]] = {}
    for one in paths:
        forms.setdefault(header_of(spark, one), []).append(one)
    held = {header: group for header, group in forms.items() if header}
    if schema is None:
        reader = spark.read.option("header", True).option("inferSchema", True)
        found = [reader.csv(group) for group in held.values()] or [reader.csv(paths)]
        return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), found)
    declared = StructType.fromDDL(schema)
    if not held:
        empty = StructType([*declared, *([StructField(REJECTED, StringType())] if on_error == "quarantine" else [])])
        return spark.createDataFrame([], empty)
    found = [_read_form(spark, group, header, declared, on_error) for header, group in held.items()]
    return reduce(DataFrame.unionByName, found)


def drop_files(spark: SparkSession, folder: str, table: str = "*") -> DataFrame | None:
    """One row per file of the table's drops: table, stamp, file, length, and the drop's path.

    Backups, partial uploads and other names that merely begin like a drop are left out.
    Only file listings are read; the ``content`` column is pruned from the scan. Files
    without a byte are not listed.
    Returns None where no file matches.
    """
    try:
        files = spark.read.format("binaryFile").load(f"{folder}/{table}_*.csv*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in (missing.getCondition() or ""):
            return None
        raise
    name = "([^/]+)" if table == "*" else f"({table})"
    pattern = rf"/{name}_{STAMP}{ENDING}"
    found = files.select(
        F.regexp_extract("path", pattern, 1).alias("tabela"),
        F.regexp_extract("path", pattern, 2).alias("carimbo"),
        F.col("path").alias("caminho"),
        F.col("length").alias("bytes"),
        F.regexp_extract("path", rf"^(.*/{name}_{STAMP}{ENDING[: ENDING.rindex("(?:$")]})", 1).alias("drop"),
    )
    return found.filter(F.col("carimbo") != "")


def pick_drop(
    spark: SparkSession,
    folder: str,
    table: str,
    schema: str | None = None,
    which: str = "latest",
    on_error: str = "raise",
) -> DataFrame | None:
    """Rows of the latest, first or all drops of a table; None if there is no drop.

    Drops may differ in the order of their columns, and in which they have (``read_csv``).
    """
    if which not in ("latest", "first", "all"):
        raise ValueError(f"unknown choice of drop: {which}")
    drops = _drops(spark, folder, table)
    if not drops:
        return None
    stamps = {"first": min(drops.values()), "latest": max(drops.values())}
    paths = sorted(drop for drop, stamp in drops.items() if which == "all" or stamp == stamps[which])
    return read_csv(spark, paths, schema, on_error)


def _drops(spark: SparkSession, folder: str, table: str) -> dict[str, str]:
    """Path and stamp of every drop of a table: a row per drop, however many parts it has."""
    files = drop_files(spark, folder, table)
    if files is None:
        return {}
    return {row["drop"]: row["carimbo"] for row in files.select("drop", "carimbo").distinct().collect()}


def header_report(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    """How the header of each drop compares with the schema.

    A row per drop and column: its place in the header (null if missing), and whether it is
    as declared (``ok``), out of its declared place (``deslocada``), missing (``ausente``) or
    not declared (``desconhecida``).
    """
    declared = StructType.fromDDL(schema)
    rows = []
    for path, stamp in sorted(_drops(spark, folder, table).items()):
        header = header_of(spark, path)
        at = _mapped(header, declared, path)
        rows += [
            (table, stamp, name, at[name] + 1, "ok" if at[name] == place else "deslocada")
            if name in at
            else (table, stamp, name, None, "ausente")
            for place, name in enumerate(declared.names)
            if header
        ]
        rows += [(table, stamp, name, i + 1, "desconhecida") for i, name in enumerate(header) if i not in at.values()]
    return spark.createDataFrame(rows, "tabela string, carimbo string, coluna string, posicao int, situacao string")


def export_csv(df: DataFrame, folder: str, table: str, stamp: datetime | str) -> str:
    """Write a drop as a folder of CSV parts with headers, and return its path."""
    text = stamp if isinstance(stamp, str) else stamp.strftime("%Y%m%dT%H%M%S")
    path = f"{folder}/{table}_{text}.csv"
    df.write.option("header", True).csv(path)
    return path


def drop_report(spark: SparkSession, folder: str) -> DataFrame | None:
    """Files and size per table and drop, from the listing alone."""
    files = drop_files(spark, folder)
    if files is None:
        return None
    return (
        files.groupBy("tabela", "carimbo")
        .agg(
            F.count(F.lit(1)).alias("arquivos"),
            F.sum("bytes").alias("bytes"),
            F.round(F.sum("bytes") / F.lit(1_048_576), 1).alias("tamanho_mb"),
        )
        .orderBy("tabela", "carimbo")
    )
