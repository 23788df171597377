"""Whole-layer runs: raw drops to raw tables, to cleaned tables, to marts.

Each table is read from published inputs, written in one execution and timed
around that execution. A table that fails, or lacks an input, leaves the others
running; its dependents are skipped. Every few tables, and at its end whatever
happens, a layer publishes what it has written and appends the outcome of every
phase to the audit log.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.operators.typing import REJECTED
from balcao.plans import audit, audit_state, gold, silver
from balcao.sources import schemas
from balcao.sources.drops import REJECTED as RAW_REJECTED
from balcao.sources.drops import pick_drop
from balcao.sources.layers import latest_versions, log_versions, read_table, write_version
from balcao.sources.scratch import stage

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
AUDIT_LOG = "pipeline_audit"
#: Phases between two appends to the logs: a lost driver loses the record of no more.
FLUSH_EVERY = 8

#: Columns that mark rows with unreadable values, and how; such rows go to ``<table>_rejeitados``.
REJECTION_MARKS: dict[str, Callable[[], Column]] = {
    RAW_REJECTED: lambda: F.col(RAW_REJECTED).isNotNull(),
    REJECTED: lambda: F.size(REJECTED) > 0,
}
REJECTS = "_rejeitados"

log = logging.getLogger(__name__)


def new_run_id() -> str:
    """A fresh id per run, to be shared by the run's layers."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


class Job(NamedTuple):
    """How a table is built: a function of published tables, given as (layer, name).

    ``dated`` jobs take ``as_of``, ``typed`` ones convert values and take ``on_error``.
    """

    build: Callable[..., DataFrame]
    inputs: Sequence[tuple[str, str]]
    dated: bool = False
    typed: bool = False


def _from(layer: str, *names: str) -> list[tuple[str, str]]:
    return [(layer, name) for name in names]


# In an order in which every table comes after its inputs.
SILVER_JOBS = {
    "fornecedores": Job(silver.fornecedores, _from(BRONZE, "fornecedores")),
    "cupons": Job(silver.cupons, _from(BRONZE, "cupons"), dated=True, typed=True),
    "fretes": Job(silver.fretes, _from(BRONZE, "fretes"), typed=True),
    "pagamentos": Job(silver.pagamentos, _from(BRONZE, "pagamentos"), typed=True),
    "clientes": Job(silver.clientes, _from(BRONZE, "clientes", "vendas"), typed=True),
    "produtos": Job(
        silver.produtos, _from(BRONZE, "produtos") + _from(SILVER, "fornecedores"), typed=True
    ),
    "vendas": Job(
        silver.vendas,
        _from(BRONZE, "vendas") + _from(SILVER, "produtos", "clientes", "fretes", "pagamentos"),
        typed=True,
    ),
    "avaliacoes": Job(
        silver.avaliacoes, _from(BRONZE, "avaliacoes") + _from(SILVER, "vendas", "produtos"), typed=True
    ),
}

# Marts straight from the cleaned tables, one scan each.
DIRECT_GOLD_JOBS = {
    **{name: Job(mart.of, _from(SILVER, "vendas")) for name, mart in gold.SALES_MARTS.items()},
    "top_clientes": Job(gold.top_clientes, _from(SILVER, "vendas", "clientes")),
    "satisfacao_categoria": Job(gold.satisfacao_categoria, _from(SILVER, "avaliacoes")),
    "satisfacao_regiao": Job(gold.satisfacao_regiao, _from(SILVER, "avaliacoes", "clientes")),
    "estoque_critico": Job(gold.estoque_critico, _from(SILVER, "produtos")),
    "clientes_rfm": Job(gold.clientes_rfm, _from(SILVER, "vendas", "clientes"), dated=True),
    "cupons_performance": Job(gold.cupons_performance, _from(SILVER, "vendas", "cupons")),
}

# The same marts in a whole run: most of those over sales share three summaries.
GOLD_JOBS = {
    gold.BY_PRODUCT: Job(gold.product_summary, _from(SILVER, "vendas")),
    gold.BY_CUSTOMER: Job(gold.customer_summary, _from(SILVER, "vendas")),
    gold.BY_KIND: Job(gold.kind_summary, _from(SILVER, "vendas")),
    gold.BY_MONTH: Job(gold.month_summary, _from(SILVER, "vendas")),
    **DIRECT_GOLD_JOBS,
    **{
        name: Job(gold.SALES_MARTS[name].of_summary, _from(GOLD, source))
        for name, source in gold.SERVED_BY.items()
    },
    "top_clientes": Job(
        gold.top_clientes_of_summary, _from(GOLD, gold.BY_CUSTOMER) + _from(SILVER, "clientes")
    ),
    "clientes_rfm": Job(
        gold.clientes_rfm_of_summary,
        _from(GOLD, gold.BY_CUSTOMER) + _from(SILVER, "clientes"),
        dated=True,
    ),
}

# Audit marts, and the state table that each is answered from.
AUDIT_MARTS = {
    "duracao_fase_tabela": "fases",
    "duracao_camada_total": "totais",
    "volume_dados_por_tabela": "volumes",
}


class LayerRun:
    """Collects the audit records of one layer in one run."""

    def __init__(self, spark: SparkSession, root: str, layer: str, run_id: str):
        self.spark, self.root, self.layer, self.run_id = spark, root, layer, run_id
        self.records: list[tuple] = []
        self.versions = latest_versions(spark, root)
        self.written: list = []
        self.status: dict[str, str] = {}

    @contextmanager
    def phase(self, table: str, name: str) -> Iterator[dict]:
        """Time a phase. An error is recorded and ends the table, not the layer."""
        began, clock = datetime.now(timezone.utc), time.monotonic()
        seen, status, message = {"rows": 0}, audit.OK, None
        try:
            yield seen
        except Exception as problem:
            status, message = audit.FAILED, str(problem)
            log.exception("%s.%s failed in %s", self.layer, table, name)
        self.status[table] = status
        took = round((time.monotonic() - clock) * 1000)
        self.records.append(
            (self.run_id, began, self.layer, table, name, took, seen["rows"], status, message)
        )

    def skip(self, table: str, reason: str) -> None:
        self.status[table] = audit.SKIPPED
        now = datetime.now(timezone.utc)
        self.records.append(
            (self.run_id, now, self.layer, table, "leitura", 0, 0, audit.SKIPPED, reason)
        )

    def table(self, name: str, read: Callable[[], Sequence[DataFrame] | None], build) -> None:
        """Read, build and write one table."""
        inputs = None
        with self.phase(name, "leitura"):
            inputs = read()
        if self.status[name] == audit.FAILED:
            return
        if inputs is None:
            self.records.pop()
            self.skip(name, "entrada ausente")
            return
        with self.phase(name, audit.WRITE_PHASE) as seen:
            df = build(*inputs)
            for column, marked in REJECTION_MARKS.items():
                if column in df.columns:
                    rejected = marked()
                    # Written once: the good and the rejected rows come from one execution.
                    both = stage(df, name)
                    self._write(both.filter(rejected), f"{name}{REJECTS}")
                    df = both.filter(~rejected).drop(column)
            seen["rows"] = self._write(df, name)
        if len(self.records) >= FLUSH_EVERY:
            self.flush()

    def _write(self, df: DataFrame, name: str) -> int:
        version = write_version(df, self.root, self.layer, name, self.versions)
        self.versions[self.layer, name] = version
        self.written.append(version)
        return version.linhas

    def published(self, layer: str, name: str) -> DataFrame | None:
        return read_table(self.spark, self.root, layer, name, known=self.versions)

    def flush(self) -> None:
        """Publish what was written since the last time, and log how it went, in one append each."""
        log_versions(self.spark, self.root, self.written)
        self.written = []
        if self.records:
            audit.audit_append(self.spark, self.records, f"{self.root}/{AUDIT_LOG}")
            self.records = []

    def __enter__(self) -> LayerRun:
        return self

    def __exit__(self, *problem: object) -> None:
        self.flush()


def run_bronze(
    spark: SparkSession,
    drops: str,
    root: str,
    run_id: str,
    which: str = "latest",
    on_error: str = "raise",
) -> dict[str, str]:
    with LayerRun(spark, root, BRONZE, run_id) as run:
        for name, schema in schemas.RAW.items():

            def read(name=name, schema=schema):
                found = pick_drop(spark, drops, name, schema, which, on_error)
                return None if found is None else [found]

            run.table(name, read, lambda df: df)
    return run.status


Stale = frozenset[tuple[str, str]]


def stale_tables(layer: str, status: dict[str, str]) -> Stale:
    """Tables that a layer's run did not renew, as (layer, name)."""
    return frozenset((layer, name) for name, outcome in status.items() if outcome != audit.OK)


def _run_jobs(
    run: LayerRun,
    jobs: dict[str, Job],
    as_of: date | str | None,
    stale: Stale,
    on_error: str = "raise",
) -> None:
    for name, job in jobs.items():

        def read(job=job):
            # Inputs must stem from this run: an older version would mix two days.
            if (stale | stale_tables(run.layer, run.status)) & set(job.inputs):
                return None
            found = [run.published(layer, n) for layer, n in job.inputs]
            return None if any(df is None for df in found) else found

        def build(*inputs, job=job):
            given = ({"as_of": as_of} if job.dated else {}) | ({"on_error": on_error} if job.typed else {})
            return job.build(*inputs, **given)

        run.table(name, read, build)


def run_silver(
    spark: SparkSession,
    root: str,
    run_id: str,
    as_of: date | str | None = None,
    stale: Stale = frozenset(),
    on_error: str = "raise",
) -> dict[str, str]:
    """Cleaned tables. Tables that need a ``stale`` input are skipped.

    With ``on_error="quarantine"``, rows with values that do not convert are left out
    of a table and published as ``<table>_rejeitados``, with the columns concerned.
    """
    with LayerRun(spark, root, SILVER, run_id) as run:
        _run_jobs(run, SILVER_JOBS, as_of, stale, on_error)
    return run.status


def read_audit(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(schemas.AUDIT).parquet(f"{root}/{AUDIT_LOG}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in (missing.getCondition() or ""):
            return None
        raise


def run_gold(
    spark: SparkSession,
    root: str,
    run_id: str,
    as_of: date | str | None = None,
    stale: Stale = frozenset(),
) -> dict[str, str]:
    """Business marts, then the marts over the audit log of the runs so far."""
    with LayerRun(spark, root, GOLD, run_id) as run:
        _run_jobs(run, GOLD_JOBS, as_of, stale)
        for name, state in AUDIT_MARTS.items():

            def read(state=state):
                # Only log files that no run has read yet are read.
                audit_state.fold(spark, root, f"{root}/{AUDIT_LOG}")
                found = audit_state.state_table(spark, root, state)
                return None if found is None else [found]

            run.table(name, read, audit_state.STATES[state].answer)
    return run.status


def run_all(
    spark: SparkSession,
    drops: str,
    root: str,
    as_of: date | str | None = None,
    which: str = "latest",
    run_id: str | None = None,
    on_error: str = "raise",
) -> dict[str, dict[str, str]]:
    """All three layers under one run id; returns the status of every table."""
    name = run_id or new_run_id()
    raw = run_bronze(spark, drops, root, name, which, on_error)
    clean = run_silver(spark, root, name, as_of, stale_tables(BRONZE, raw), on_error)
    marts = run_gold(spark, root, name, as_of, stale_tables(SILVER, clean))
    return {BRONZE: raw, SILVER: clean, GOLD: marts}
