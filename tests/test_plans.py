"""Shapes of plans that matter when tables are large."""

import re

import pytest
from conftest import SMALL

from balcao.checks.queries import QUERIES
from balcao.checks.warehouse import open_warehouse


@pytest.fixture(scope="module")
def w(spark):
    return open_warehouse(spark, SMALL)


def plan(w, name):
    return QUERIES[name](w)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["gold_top_produtos", "gold_top_clientes", "gold_shared_top_produtos", "audit_volume_by_layer"]
)
def test_top_k_is_not_a_full_sort(w, name):
    assert "TakeOrderedAndProject" in plan(w, name)


@pytest.mark.parametrize("name", ["audit_phase_stats", "latest_n", "latest_per_group"])
def test_groups_are_cut_before_the_shuffle(w, name):
    text = plan(w, name)
    assert re.search(r"WindowGroupLimit .*Partial", text)


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("silver_vendas", "EqualTo(status,CONCLUIDO)"),
        ("silver_pagamentos", "EqualTo(status_pagamento,PAGO)"),
        ("silver_fretes", "Not(EqualTo(status_entrega,CANCELADO))"),
        ("silver_clientes", "IsNotNull(cliente_id)"),
        ("gold_cupons_performance", "IsNotNull(cupom_id)"),
        ("audit_phase_stats", "EqualTo(status,sucesso)"),
    ],
)
def test_filters_reach_the_scan(w, name, pushed):
    lines = [l for l in plan(w, name).splitlines() if "PushedFilters" in l]
    assert any(pushed in line for line in lines), lines


@pytest.mark.parametrize(
    "name, columns",
    [
        ("gold_vendas_turno", "struct<venda_id:bigint,turno:string,valor_total:double>"),
        ("gold_receita_mensal", "struct<cliente_id:bigint,venda_id:bigint,valor_frete:double,valor_total:double,ano_mes:string>"),
    ],
)
def test_only_needed_columns_are_read(w, name, columns):
    assert f"ReadSchema: {columns}" in plan(w, name)


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("gold_", "silver_"))])
def test_each_input_is_scanned_once(w, name):
    longest = "spark.sql.maxMetadataStringLength"  # long paths are cut in plans
    w.spark.conf.set(longest, "10000")
    try:
        places = re.findall(r"FileScan parquet .*?Location: (\S+ \S+)", plan(w, name))
    finally:
        w.spark.conf.unset(longest)
    assert len(places) == len(set(places))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_of_tables(w, name):
    text = plan(w, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
