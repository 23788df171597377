"""Whole runs over generated drops."""

import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from balcao.plans import datagen, runs
from balcao.sources import layers

VOLUMES = {"fornecedores": 10, "clientes": 100, "produtos": 30, "cupons": 20, "vendas": 1_000}
FIRST, SECOND = "20240101T000000", "20240102T000000"


@pytest.fixture(scope="module")
def drops_folder(spark):
    folder = tempfile.mkdtemp(prefix="balcao-tests-")
    datagen.export_all(datagen.gen_all(spark, VOLUMES), folder, FIRST)
    return folder


@pytest.fixture(scope="module")
def warehouse(spark, drops_folder):
    root = tempfile.mkdtemp(prefix="balcao-tests-")
    status = runs.run_all(spark, drops_folder, root, as_of="2024-06-30", run_id="r1")
    return root, status


def test_all_tables_are_published(spark, warehouse):
    root, status = warehouse
    assert {s for layer in status.values() for s in layer.values()} == {"sucesso"}
    assert len(status["silver"]) == 8
    assert len([n for n in status["gold"] if not n.startswith("_")]) == 14 + 3
    sales = layers.read_table(spark, root, "silver", "vendas")
    monthly = layers.read_table(spark, root, "gold", "receita_mensal")
    assert monthly.agg(F.sum("qtd_vendas")).first()[0] == sales.count() > 0


def test_audit_log_of_the_run(spark, warehouse):
    root, status = warehouse
    log = runs.read_audit(spark, root)
    assert {r.run_id for r in log.select("run_id").distinct().collect()} == {"r1"}
    written = log.filter("fase = 'escrita' and camada = 'bronze' and tabela = 'vendas'").first()
    assert written.row_count == 1_000 and written.erro_mensagem is None
    assert log.filter("fase = 'escrita'").count() == sum(map(len, status.values()))


def test_second_run_compares_with_the_first(spark, drops_folder, warehouse):
    root, _ = warehouse
    runs.run_all(spark, drops_folder, root, as_of="2024-06-30", run_id="r2")
    volumes = layers.read_table(spark, root, "gold", "volume_dados_por_tabela")
    second = volumes.filter("run_id = 'r2' and camada = 'bronze' and tabela = 'vendas'").first()
    assert (second.row_count, second.row_count_anterior, second.variacao_vs_run_anterior_pct) == (1_000, 1_000, 0.0)
    totals = layers.read_table(spark, root, "gold", "duracao_camada_total")
    assert totals.filter("run_id = 'r2' and camada = 'silver'").first().duracao_anterior > 0
    assert layers.table_history(spark, root, "gold", "receita_mensal").first().versao == 2


def test_missing_and_broken_inputs(spark, drops_folder, warehouse):
    """Over a warehouse that has older versions of all tables."""
    root, _ = warehouse
    folder = tempfile.mkdtemp(prefix="balcao-tests-")
    for name in ("clientes", "produtos", "vendas", "fretes", "pagamentos", "cupons"):
        shutil.copytree(f"{drops_folder}/{name}_{FIRST}.csv", f"{folder}/{name}_{FIRST}.csv")
    # a newer drop of sales with a quantity that is no number
    with open(f"{folder}/vendas_{SECOND}.csv", "w", encoding="utf-8") as f:
        f.write("venda_id,cliente_id,produto_id,quantidade,desconto_pct,cupom_id,status,canal,data_venda,hora_venda\n")
        f.write("1,1,1,muitas,0,,CONCLUIDO,app,2024-01-01,10:00:00\n")
    status = runs.run_all(spark, folder, root, as_of="2024-06-30", run_id="r3")
    raw, clean, marts = (status[layer] for layer in ("bronze", "silver", "gold"))
    assert raw["fornecedores"] == raw["avaliacoes"] == "ignorado"
    assert raw["vendas"] == "erro"
    assert {n for n, s in clean.items() if s == "sucesso"} == {"cupons", "fretes", "pagamentos"}
    assert {s for n, s in clean.items() if n not in ("cupons", "fretes", "pagamentos")} == {"ignorado"}
    assert marts["receita_mensal"] == marts["_resumo_cliente"] == "ignorado"
    assert marts["duracao_fase_tabela"] == "sucesso"
    before = layers.table_history(spark, root, "silver", "vendas").first()
    assert before.versao == 2 and layers.table_history(spark, root, "silver", "cupons").first().versao == 3
    # the same drop taken leniently
    assert runs.run_bronze(spark, folder, root, "r4", on_error="null")["vendas"] == "sucesso"


def test_failure_is_recorded_and_the_rest_goes_on(spark):
    root = tempfile.mkdtemp(prefix="balcao-tests-")
    texts = spark.createDataFrame([("1", "PAGO", "dez", "1")], "pagamento_id string, status_pagamento string, valor_pago string, parcelas string")
    suppliers = spark.createDataFrame([(1, "1-2")], "fornecedor_id bigint, cnpj string")
    layers.publish_all(spark, {"pagamentos": texts, "fornecedores": suppliers}, root, "bronze")
    status = runs.run_silver(spark, root, "r")
    assert status["pagamentos"] == "erro" and status["fornecedores"] == "sucesso"
    failed = runs.read_audit(spark, root).filter("status = 'erro'").first()
    assert failed.tabela == "pagamentos" and "CAST_INVALID_INPUT" in failed.erro_mensagem
