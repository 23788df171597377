"""Audit questions on a planted log with known answers."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from balcao.plans import audit
from balcao.sources import schemas
from balcao.sources.layers import rows_to_df

START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


LOG = [
    # run, time, layer, table, phase, ms, rows, status, message
    ("a", at(0), "bronze", "vendas", "leitura", 100, 0, "sucesso", None),
    ("a", at(1), "bronze", "vendas", "escrita", 200, 400_000, "sucesso", None),
    ("a", at(2), "silver", "vendas", "escrita", 50, 10, "sucesso", None),
    ("b", at(10), "bronze", "vendas", "escrita", 600, 0, "erro", "disco"),
    ("b", at(11), "bronze", "fretes", "escrita", 150, 500_000, "sucesso", None),
    ("c", at(20), "bronze", "vendas", "escrita", 99, 0, "erro", "disco"),
    ("d", at(30), "bronze", "vendas", "escrita", 700_000, 1_000_000, "sucesso", None),
    ("d", at(31), "bronze", "vendas", "escrita", 10, 1_200_000, "sucesso", None),
    ("d", at(32), "silver", "vendas", "escrita", 0, 20, "sucesso", None),
    ("e", at(40), "silver", "vendas", "escrita", 30, 5, "sucesso", None),
    ("e", at(41), "gold", "marts", "escrita", 1_200_000, 5, "erro", "memória"),
]


@pytest.fixture(scope="module")
def log(spark):
    return rows_to_df(spark, LOG, schemas.AUDIT)


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_append_keeps_successes_with_null_message(spark, folder):
    audit.audit_append(spark, LOG[:3], folder + "/log")
    audit.audit_append(spark, LOG[3:4], folder + "/log")
    back = spark.read.parquet(folder + "/log")
    assert back.count() == 4
    assert back.filter("erro_mensagem is null and status = 'sucesso'").count() == 3


def test_run_summary(log):
    runs = by(audit.run_summary(log), "run_id", "camada")
    assert runs["a", "bronze"].duracao_total_ms == 300
    assert runs["a", "bronze"].inicio == at(0)
    assert runs["b", "bronze"].status == "erro"
    assert runs["e", "silver"].status == "sucesso"


def test_run_totals(log):
    totals = by(audit.run_totals(log), "camada", "status")
    assert {k: r.qtd_runs for k, r in totals.items()} == {
        ("bronze", "sucesso"): 2, ("bronze", "erro"): 2, ("silver", "sucesso"): 3, ("gold", "erro"): 1,
    }


def test_layer_totals_compare_with_the_run_before(log):
    totals = by(audit.layer_totals(log), "camada", "run_id")
    assert totals["bronze", "a"].variacao_vs_run_anterior_pct is None
    assert totals["bronze", "b"].duracao_total_ms == 150
    assert totals["bronze", "b"].variacao_vs_run_anterior_pct == -50.0
    assert (totals["bronze", "b"].qtd_tabelas_sucesso, totals["bronze", "b"].qtd_tabelas_erro) == (1, 1)
    # run c has no success, so run d is compared with run b
    assert totals["bronze", "c"].duracao_total_ms is None
    assert totals["bronze", "d"].duracao_anterior == 150
    # a base of zero gives no percentage
    assert totals["silver", "d"].variacao_vs_run_anterior_pct == -100.0
    assert totals["silver", "e"].duracao_anterior == 0
    assert totals["silver", "e"].variacao_vs_run_anterior_pct is None
    latest = by(audit.layer_totals(log, latest_only=True), "camada")
    assert {k[0]: r.run_id for k, r in latest.items()} == {"bronze": "d", "silver": "e", "gold": "e"}


def test_table_volumes(log):
    volumes = by(audit.table_volumes(log), "camada", "tabela", "run_id")
    assert volumes["bronze", "vendas", "a"].variacao_vs_run_anterior_pct is None
    assert volumes["bronze", "vendas", "d"].row_count == 1_200_000
    assert volumes["bronze", "vendas", "d"].variacao_vs_run_anterior_pct == 200.0
    assert volumes["silver", "vendas", "e"].variacao_vs_run_anterior_pct == -75.0
    assert ("bronze", "vendas", "b") not in volumes


def test_phase_stats_use_the_last_successes(spark):
    many = [
        ("r", at(i), "bronze", "t", "leitura", i, 0, "erro" if i == 50 else "sucesso", None)
        for i in range(1, 101)
    ]
    stats = audit.phase_stats(rows_to_df(spark, many, schemas.AUDIT)).first()
    assert (stats.duracao_min_ms, stats.duracao_max_ms, stats.qtd_runs) == (71, 100, 30)
    assert stats.duracao_media_ms == 85.5
    assert stats.duracao_p95_ms == 99


def test_volumes_of_the_last_runs(log):
    found = audit.volume_by_layer(log, keep=3).collect()
    assert [(r.run_id, r.camada, r.linhas, r.nivel) for r in found] == [
        ("e", "gold", 5, "green"),
        ("e", "silver", 5, "green"),
        ("d", "bronze", 2_200_000, "red"),
        ("d", "silver", 20, "green"),
        ("c", "bronze", 0, "green"),
    ]
    assert by(audit.volumes(log), "run_id", "camada")["b", "bronze"].nivel == "yellow"


def test_last_status_and_failures(log):
    last = by(audit.last_status(log), "camada")
    assert {k[0]: (r.codigo, r.rotulo) for k, r in last.items()} == {
        "bronze": (0, "Sucesso"), "silver": (0, "Sucesso"), "gold": (1, "Erro"),
    }
    assert tuple(audit.failed_layers(log).first()) == (1, "green")


def test_sla(log):
    late = by(audit.sla_breaches(log), "run_id", "escopo")
    assert set(late) == {("d", "bronze"), ("e", "gold")}
    assert late["d", "bronze"].excesso_ms == 700_010 - 600_000
    tight = by(audit.sla_breaches(log, {"bronze": 10}, run_minutes=15), "run_id", "escopo")
    assert set(tight) == {("d", "bronze"), ("e", "run")}
    assert not [k for k in by(audit.sla_breaches(log, {}, 30), "run_id", "escopo")]


def test_views_of_the_log(log):
    grid = by(audit.phase_grid(log), "camada", "tabela", "fase")
    assert grid["silver", "vendas", "escrita"].qtd_registros == 3
    assert grid["silver", "vendas", "escrita"].duracao_media_ms == 26.67
    assert audit.phase_trend(log, "gold").first().duracao_s == 1200.0
    assert audit.layer_series(log).filter(F.col("run_id") == "a").count() == 2


def test_latest_mark_never_falls(spark):
    disordered = [
        ("r1", at(5), "gold", "t", "escrita", 1, 1, "sucesso", None),
        ("r2", at(3), "gold", "t", "escrita", 1, 1, "sucesso", None),
        ("r3", at(9), "gold", "t", "escrita", 1, 1, "sucesso", None),
    ]
    marks = by(audit.latest_mark(rows_to_df(spark, disordered, schemas.AUDIT)), "run_id")
    assert [marks[r,].marca for r in ("r1", "r2", "r3")] == [at(5), at(5), at(9)]
