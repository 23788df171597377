"""The audit marts kept up to date: small tables that take in only what the log gained.

A fold reads the log files that no earlier fold has read, merges them into the state
tables, and publishes these together with the list of files they hold, in one
append. A fold that fails leaves the last published state and list, and the next one reads
the same files again; log rows appended meanwhile wait for the next one.

Merging does not depend on order, so late rows, of a run or a time long past, change the marts
as they would change a recomputation from the whole log:

* ``fases``: the last ``RECENT`` successes of each layer, table and phase. A late
  success counts if it is among the last ones, and is passed over if it is not.
* ``totais``: time and outcome per layer, run and table; late rows add to their run.
* ``volumes``: rows and time per layer, table and run; the largest value stays.
* ``quantis``: a quantile sketch per layer, table and phase of all successes ever logged, which
  merges with the sketch of the new ones. Its ranks keep to a stated error in any order of merging.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from balcao.plans import audit
from balcao.sources import schemas
from balcao.sources.layers import latest_versions, log_versions, read_table, rows_to_df, write_version

LAYER = "estado"
FILES = "arquivos"
RECENT = 30


class State(NamedTuple):
    """How a state table comes from log rows, takes in more, and answers its question."""

    of_rows: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    answer: Callable[[DataFrame], DataFrame]


STATES: Mapping[str, State] = {
    "fases": State(audit.successes, lambda both: audit.recent_successes(both, RECENT), audit.stats_of_recent),
    "totais": State(audit.table_totals, audit.merged_table_totals, audit.totals_of_tables),
    "volumes": State(audit.run_volumes, audit.merged_run_volumes, audit.volumes_of_runs),
    "quantis": State(audit.duration_sketches, audit.merged_sketches, audit.quantiles_of_sketches),
}


def log_files(spark: SparkSession, log: str) -> list[str]:
    """Files of the log, one per append; [] before the first."""
    try:
        return spark.read.schema(schemas.AUDIT).parquet(log).inputFiles()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in (missing.getCondition() or ""):
            return []
        raise


def pending(spark: SparkSession, root: str, log: str) -> tuple[list[str], DataFrame | None]:
    """Log files that are not yet in the state, and their rows (None if there are none)."""
    held = read_table(spark, root, LAYER, FILES)
    known = set() if held is None else {row[0] for row in held.collect()}  # one short row per append
    new = [path for path in log_files(spark, log) if path not in known]
    return new, spark.read.schema(schemas.AUDIT).parquet(*new) if new else None


def fold(spark: SparkSession, root: str, log: str) -> int:
    """Take the new log files into the state; returns how many there were."""
    new, rows = pending(spark, root, log)
    if rows is None:
        return 0
    known = latest_versions(spark, root)
    written = []
    for name, state in STATES.items():
        merged, before = state.of_rows(rows), read_table(spark, root, LAYER, name, known=known)
        if before is not None:
            merged = before.unionByName(merged)
        written.append(write_version(state.merge(merged), root, LAYER, name, known))
    files, before = rows_to_df(spark, [(path,) for path in new], "caminho string"), read_table(spark, root, LAYER, FILES, known=known)
    files = files if before is None else before.unionByName(files)
    written.append(write_version(files.coalesce(1), root, LAYER, FILES, known))
    log_versions(spark, root, written)
    return len(new)


def state_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return read_table(spark, root, LAYER, name)
