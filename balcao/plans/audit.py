"""The audit log of table jobs and the questions asked of it.

One row per run, layer, table and phase, appended once per layer. A phase that
was retried has several rows, so every per-run question aggregates first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.functions.cleaning import bucketize, percent_change
from balcao.functions.money import mean
from balcao.operators.ordered import (
    latest_n,
    latest_per_group,
    previous,
    running_max,
    with_prefix,
)
from balcao.sources import schemas
from balcao.sources.layers import append, rows_to_df

# States, phases, limits and labels of the reports.
OK = "sucesso"
FAILED = "erro"
SKIPPED = "ignorado"
WRITE_PHASE = "escrita"
STATUS_CODES = {OK: 0, FAILED: 1, SKIPPED: 2}
STATUS_LABELS = {0: "Sucesso", 1: "Erro", 2: "Ignorado"}
VOLUME_LEVELS = [(500_000, "yellow"), (2_000_000, "red")]
FAILURE_LEVELS = [(2, "yellow"), (5, "red")]
LOWEST_LEVEL = "green"
SLA_MINUTES = {"bronze": 10, "silver": 15, "gold": 10}
SLA_RUN_MINUTES = 30
WHOLE_RUN = "run"

VARIATION = "variacao_vs_run_anterior_pct"


def audit_append(spark: SparkSession, records: Iterable[tuple], path: str) -> None:
    """Append one layer's records. Failures to write are the caller's to see."""
    append(rows_to_df(spark, records, schemas.AUDIT).coalesce(1), path)


def run_summary(audit: DataFrame) -> DataFrame:
    """Per run and layer: start, end of log, total duration and outcome.

    A failed phase makes the run a failure, else a skipped one makes it skipped.
    """
    return audit.groupBy("run_id", "camada").agg(
        F.min("timestamp").alias("inicio"),
        F.max("timestamp").alias("run_ts"),
        F.sum("duracao_ms").alias("duracao_total_ms"),
        F.count(F.lit(1)).alias("qtd_fases"),
        F.when(F.bool_or(F.col("status") == FAILED), FAILED)
        .when(F.bool_or(F.col("status") == SKIPPED), SKIPPED)
        .otherwise(OK)
        .alias("status"),
    )


def run_totals(audit: DataFrame) -> DataFrame:
    """Number of runs per layer and outcome."""
    return run_summary(audit).groupBy("camada", "status").agg(F.count(F.lit(1)).alias("qtd_runs"))


def volumes(audit: DataFrame) -> DataFrame:
    """Rows written per layer and run, with a level."""
    written = audit.filter(F.col("fase") == WRITE_PHASE)
    summed = written.groupBy("camada", "run_id").agg(F.sum("row_count").alias("linhas"))
    return summed.withColumn("nivel", volume_level(F.col("linhas")))


def volume_by_layer(audit: DataFrame, keep: int = 3) -> DataFrame:
    """``volumes`` of the last ``keep`` runs, newest first.

    The last runs are a top-k of ``keep`` rows, and only their records are summed.
    """
    last_runs = (
        audit.groupBy("run_id")
        .agg(F.max("timestamp").alias("run_ts"))
        .orderBy(F.desc("run_ts"), F.desc("run_id"))
        .limit(keep)
    )
    recent = audit.join(F.broadcast(last_runs.select("run_id")), "run_id", "left_semi")
    dated = volumes(recent).join(F.broadcast(last_runs), "run_id")
    return dated.orderBy(F.desc("run_ts"), F.desc("run_id"), "camada")


def volume_level(rows: Column) -> Column:
    return bucketize(rows, VOLUME_LEVELS, LOWEST_LEVEL)


def last_status(audit: DataFrame) -> DataFrame:
    """Outcome of the last run of each layer, as a code and a label."""
    last = latest_per_group(run_summary(audit), ["camada"], [F.desc("run_ts"), F.desc("run_id")])
    return last.select("camada", "run_id", _by_status(STATUS_CODES).alias("codigo"), _by_status(
        {status: STATUS_LABELS[code] for status, code in STATUS_CODES.items()}
    ).alias("rotulo"))


def _by_status(values: Mapping[str, object]) -> Column:
    """The value of each row's status; every summary has one of the three."""
    chosen = F.lit(values[OK])
    for status in (SKIPPED, FAILED):
        chosen = F.when(F.col("status") == status, values[status]).otherwise(chosen)
    return chosen


def failed_layers(audit: DataFrame) -> DataFrame:
    """Number of layers whose last run failed, with a level."""
    failed = F.col("codigo") == STATUS_CODES[FAILED]
    failures = last_status(audit).agg(F.count_if(failed).alias("falhas"))
    return failures.withColumn("nivel", bucketize(F.col("falhas"), FAILURE_LEVELS, LOWEST_LEVEL))


def layer_series(audit: DataFrame) -> DataFrame:
    """Duration of each run, per layer and outcome, over time."""
    return run_summary(audit).select(
        "camada",
        "status",
        "run_id",
        "inicio",
        (F.col("duracao_total_ms") / 1000).alias("duracao_s"),
    )


def phase_grid(audit: DataFrame) -> DataFrame:
    """Table by phase: how often, how long on average and at most."""
    return audit.groupBy("camada", "tabela", "fase").agg(
        F.count(F.lit(1)).alias("qtd_registros"),
        mean(F.col("duracao_ms")).alias("duracao_media_ms"),
        F.max("duracao_ms").alias("duracao_max_ms"),
    )


def phase_trend(audit: DataFrame, layer: str = "bronze") -> DataFrame:
    """Durations of one layer's phases over time."""
    return audit.filter(F.col("camada") == layer).select(
        "tabela",
        "fase",
        "run_id",
        "timestamp",
        "status",
        (F.col("duracao_ms") / 1000).alias("duracao_s"),
    )


_PHASE = ["camada", "tabela", "fase"]


def successes(audit: DataFrame) -> DataFrame:
    """What ``phase_stats`` needs of each successful phase."""
    return audit.filter(F.col("status") == OK).select(*_PHASE, "timestamp", "run_id", "duracao_ms")


def recent_successes(done: DataFrame, n: int = 30) -> DataFrame:
    """The last ``n`` successes of each layer, table and phase."""
    return latest_n(done, _PHASE, [F.desc("timestamp"), F.desc("run_id"), F.desc("duracao_ms")], n)


def stats_of_recent(recent: DataFrame) -> DataFrame:
    return recent.groupBy(*_PHASE).agg(
        mean(F.col("duracao_ms")).alias("duracao_media_ms"),
        F.min("duracao_ms").alias("duracao_min_ms"),
        F.max("duracao_ms").alias("duracao_max_ms"),
        F.percentile_approx("duracao_ms", 0.95).alias("duracao_p95_ms"),
        F.count(F.lit(1)).alias("qtd_runs"),
    )


def phase_stats(audit: DataFrame, n: int = 30) -> DataFrame:
    """Durations over the last ``n`` successes of each layer, table and phase."""
    return stats_of_recent(recent_successes(successes(audit), n))


#: Size of a quantile sketch, and the error of ranks that it keeps to with a confidence of 99 %.
SKETCH_SIZE = 800
RANK_ERROR = 0.006


def duration_sketches(audit: DataFrame) -> DataFrame:
    """A quantile sketch of the durations of all successes of each phase, a few KB however many there are."""
    timed = audit.filter((F.col("status") == OK) & F.col("duracao_ms").isNotNull())
    sketch = F.kll_sketch_agg_bigint(F.col("duracao_ms").cast("bigint"), SKETCH_SIZE)
    return timed.groupBy(*_PHASE).agg(sketch.alias("esboco"))


def merged_sketches(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*_PHASE).agg(F.kll_merge_agg_bigint("esboco", SKETCH_SIZE).alias("esboco"))


def quantiles_of_sketches(sketches: DataFrame) -> DataFrame:
    """Median, p95 and p99 of each phase. Up to ``SKETCH_SIZE`` successes they are exact,
    beyond that their ranks are off by ``RANK_ERROR`` of all successes at most."""
    at = {"duracao_p50_ms": 0.5, "duracao_p95_ms": 0.95, "duracao_p99_ms": 0.99}
    quantiles = [F.kll_sketch_get_quantile_bigint("esboco", F.lit(rank)).alias(name) for name, rank in at.items()]
    return sketches.select(*_PHASE, F.kll_sketch_get_n_bigint("esboco").alias("qtd_sucessos"), *quantiles)


def phase_quantiles(audit: DataFrame) -> DataFrame:
    """Quantiles over all successes of each phase; ``phase_stats`` has the exact ones of the last few."""
    return quantiles_of_sketches(duration_sketches(audit))


_TABLE_OF_RUN = ["camada", "run_id", "tabela"]


def table_totals(audit: DataFrame) -> DataFrame:
    """Time and outcome per layer, run and table, as parts that merge."""
    return audit.groupBy(*_TABLE_OF_RUN).agg(
        F.max("timestamp").alias("ate"),
        F.sum(F.when(F.col("status") == OK, F.col("duracao_ms"))).alias("ms"),
        F.bool_or(F.col("status") == OK).alias("algum_ok"),
        F.bool_or(F.col("status") == FAILED).alias("algum_erro"),
    )


def merged_table_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*_TABLE_OF_RUN).agg(
        F.max("ate").alias("ate"),
        F.sum("ms").alias("ms"),
        F.bool_or("algum_ok").alias("algum_ok"),
        F.bool_or("algum_erro").alias("algum_erro"),
    )


def totals_of_tables(per_table: DataFrame, latest_only: bool = False) -> DataFrame:
    per_run = per_table.groupBy("camada", "run_id").agg(
        F.max("ate").alias("run_ts"),
        F.sum("ms").alias("duracao_total_ms"),
        F.count_if("algum_ok").alias("qtd_tabelas_sucesso"),
        F.count_if("algum_erro").alias("qtd_tabelas_erro"),
    )
    return _against_run_before(per_run, ["camada"], "duracao_total_ms", "duracao_anterior", latest_only)


def layer_totals(audit: DataFrame, latest_only: bool = False) -> DataFrame:
    """Time spent in successful phases per layer and run, against the run before.

    A run without a single success has no total, and is passed over as a base.
    """
    return totals_of_tables(table_totals(audit), latest_only)


_VOLUME = ["camada", "tabela", "run_id"]


def run_volumes(audit: DataFrame) -> DataFrame:
    """Rows per layer, table and run, of successful phases that had any."""
    filled = audit.filter((F.col("status") == OK) & (F.col("row_count") > 0))
    return filled.groupBy(*_VOLUME).agg(F.max("timestamp").alias("run_ts"), F.max("row_count").alias("row_count"))


def merged_run_volumes(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*_VOLUME).agg(F.max("run_ts").alias("run_ts"), F.max("row_count").alias("row_count"))


def volumes_of_runs(per_run: DataFrame, latest_only: bool = False) -> DataFrame:
    return _against_run_before(
        per_run, ["camada", "tabela"], "row_count", "row_count_anterior", latest_only
    )


def table_volumes(audit: DataFrame, latest_only: bool = False) -> DataFrame:
    """Rows per layer, table and run, against the run before."""
    return volumes_of_runs(run_volumes(audit), latest_only)


def _against_run_before(
    per_run: DataFrame, group: list[str], value: str, before: str, latest_only: bool
) -> DataFrame:
    dated = with_prefix(per_run, group, ["run_ts", "run_id"], **{before: previous(value)})
    compared = dated.withColumn(VARIATION, percent_change(F.col(value), F.col(before)))
    if latest_only:
        return latest_per_group(compared, group, [F.desc("run_ts"), F.desc("run_id")])
    return compared


def latest_mark(audit: DataFrame) -> DataFrame:
    """Newest log time known at each run of a layer, runs taken by id."""
    per_run = audit.groupBy("camada", "run_id").agg(F.max("timestamp").alias("run_ts"))
    return with_prefix(per_run, ["camada"], ["run_id"], marca=running_max("run_ts"))


def sla_breaches(
    audit: DataFrame,
    minutes: Mapping[str, int] = SLA_MINUTES,
    run_minutes: int | None = SLA_RUN_MINUTES,
) -> DataFrame:
    """Layer runs, and whole runs, that took longer than agreed."""
    agreed = dict(minutes) | ({} if run_minutes is None else {WHOLE_RUN: run_minutes})
    limits = [F.lit(part) for name, limit in agreed.items() for part in (name, limit * 60_000)]
    limit_ms = F.try_element_at(F.create_map(*limits), F.col("escopo")).cast("bigint")
    spent = audit.groupBy("run_id", "camada").agg(F.sum("duracao_ms").alias("duracao_ms"))
    # Each layer total counts once for the layer and once for the whole run.
    scopes = F.explode(F.array(F.col("camada"), F.lit(WHOLE_RUN))).alias("escopo")
    scoped = spent.select("run_id", scopes, "duracao_ms").groupBy("run_id", "escopo").agg(
        F.sum("duracao_ms").alias("duracao_ms")
    )
    return (
        scoped.withColumn("limite_ms", limit_ms)
        .withColumn("excesso_ms", F.col("duracao_ms") - F.col("limite_ms"))
        .filter(F.col("excesso_ms") > 0)
    )
