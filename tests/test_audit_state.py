"""Folding the audit log into state tables."""

from bisect import bisect_left, bisect_right
from datetime import datetime, timedelta

import pytest

from balcao.plans import audit, audit_state
from balcao.sources import schemas
from balcao.sources.layers import append, publish_log, rows_to_df

START = datetime(2024, 1, 1)
WHOLE = {"fases": audit.phase_stats, "totais": audit.layer_totals, "volumes": audit.table_volumes, "quantis": audit.phase_quantiles}


def phase(minute, run, table="vendas", layer="bronze", name="escrita", took=10, rows=5, status="sucesso"):
    return (run, START + timedelta(minutes=minute), layer, table, name, took, rows, status, None)


def put(spark, root, records):
    append(rows_to_df(spark, records, schemas.AUDIT).coalesce(1), f"{root}/log")


def answers(spark, root):
    return {n: sorted(map(repr, s.answer(audit_state.state_table(spark, root, n)).collect())) for n, s in audit_state.STATES.items()}


def recomputed(spark, root):
    log = spark.read.schema(schemas.AUDIT).parquet(f"{root}/log")
    return {n: sorted(map(repr, question(log).collect())) for n, question in WHOLE.items()}


def fold(spark, root):
    return audit_state.fold(spark, root, f"{root}/log")


def test_folds_equal_the_whole_log(spark, folder):
    """Forty runs, a retry, failures, and late rows of early runs that do and do not count."""
    put(spark, folder, [phase(i, f"r{i:02d}", took=i * 7 % 50, rows=i % 4) for i in range(40)])
    assert fold(spark, folder) == 1 and answers(spark, folder) == recomputed(spark, folder)
    put(spark, folder, [phase(5, "r05", "fretes", took=99), phase(50, "r41", status="erro"), phase(39, "r39", took=500)])
    put(spark, folder, [phase(-100, "r00", took=10_000, rows=9), phase(41, "r40", "fretes", rows=0)])
    assert fold(spark, folder) == 2 and answers(spark, folder) == recomputed(spark, folder)
    put(spark, folder, [phase(60 + i, f"s{i}", layer="gold", status="ignorado") for i in range(3)])
    assert fold(spark, folder) == 1 and answers(spark, folder) == recomputed(spark, folder)
    assert audit_state.state_table(spark, folder, "fases").count() <= 2 * audit_state.RECENT


def test_quantiles_of_many_folds_keep_to_the_rank_error(spark, folder):
    """Five folds of 20,000 durations each, many equal and in rising order, against sorting all of them."""
    names = [part.split()[0] for part in schemas.AUDIT.split(", ")]
    for part in range(5):
        rows = spark.range(part * 20_000, (part + 1) * 20_000).selectExpr(
            "concat('r', id) run_id",
            "timestamp'2024-01-01' timestamp",
            "'bronze' camada",
            "'vendas' tabela",
            "'escrita' fase",
            "if(id % 3 = 0, 7, if(id % 50 = 1, null, id * id div 1000)) duracao_ms",
            "1L row_count",
            "if(id % 10 = 0, 'erro', 'sucesso') status",
            "cast(null as string) erro_mensagem",
        )
        append(rows.select(*names), f"{folder}/log")
        fold(spark, folder)
    sketches = audit_state.state_table(spark, folder, "quantis")
    found = audit.quantiles_of_sketches(sketches).first()
    log = spark.read.parquet(f"{folder}/log").filter("status = 'sucesso' and duracao_ms is not null")
    every = sorted(r.duracao_ms for r in log.select("duracao_ms").collect())
    assert found.qtd_sucessos == len(every) > 80_000
    for value, rank in ((found.duracao_p50_ms, 0.5), (found.duracao_p95_ms, 0.95), (found.duracao_p99_ms, 0.99)):
        assert bisect_left(every, value) / len(every) <= rank + audit.RANK_ERROR
        assert bisect_right(every, value) / len(every) >= rank - audit.RANK_ERROR
    assert sketches.selectExpr("max(octet_length(esboco)) most").first().most < 40_000


def test_only_new_files_are_read(spark, folder):
    for i in range(4):
        put(spark, folder, [phase(i, f"r{i}")])
    assert fold(spark, folder) == 4
    before = set(spark.read.parquet(f"{folder}/log").inputFiles())
    put(spark, folder, [phase(9, "r9")])
    new, rows = audit_state.pending(spark, folder, f"{folder}/log")
    assert set(rows.inputFiles()) == set(new) and not set(new) & before and len(new) == 1
    assert fold(spark, folder) == 1 and fold(spark, folder) == 0
    # An answer reads its state alone.
    found = audit_state.STATES["totais"].answer(audit_state.state_table(spark, folder, "totais"))
    assert all("/estado/totais/" in path for path in audit_state.state_table(spark, folder, "totais").inputFiles())
    assert found.count() == 5


def test_a_failed_fold_changes_nothing(spark, folder, monkeypatch):
    put(spark, folder, [phase(0, "r0")])
    fold(spark, folder)
    state = answers(spark, folder)
    put(spark, folder, [phase(1, "r1", took=70)])

    def broken(*args):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(audit_state, "log_versions", broken)
        with pytest.raises(OSError):
            fold(spark, folder)
    assert answers(spark, folder) == state
    # Rows logged in between are taken in with those of the failed fold, once.
    put(spark, folder, [phase(2, "r2", took=80)])
    assert fold(spark, folder) == 2 and answers(spark, folder) == recomputed(spark, folder)


def test_without_a_log(spark, folder):
    assert fold(spark, folder) == 0 and publish_log(spark, folder) is None
    assert audit_state.state_table(spark, folder, "fases") is None
