import pytest
from pyspark.sql import functions as F

from balcao.plans import datagen
from balcao.plans import datagen_values as V
from balcao.sources import drops, schemas
from balcao.sources.scratch import stage

VOLUMES = {"fornecedores": 20, "clientes": 500, "produtos": 80, "cupons": 40, "vendas": 4_000}


@pytest.fixture(scope="module")
def made(spark):
    return datagen.gen_all(spark, VOLUMES)


def test_volumes_and_columns(made):
    for name, df in made.items():
        assert df.columns == [part.split()[0] for part in schemas.RAW[name].split(", ")]
        assert [kind for _, kind in df.dtypes] == [part.split()[1] for part in schemas.RAW[name].split(", ")]
    for name, count in (VOLUMES | {"fretes": 4_000, "pagamentos": 4_000}).items():
        assert made[name].count() == count


def test_rules(made):
    found = datagen.invariants(*[made[n] for n in ("vendas", "fretes", "pagamentos", "avaliacoes", "cupons")])
    counts = {r.regra: r.violacoes for r in found.collect()}
    assert len(counts) == 11 and set(counts.values()) == {0}


def test_payments_broadcast_no_table(made):
    """Neither products nor the freight of every sale is built on the driver, however small the files."""
    paid = datagen.gen_pagamentos(made["vendas"], made["produtos"], made["fretes"])
    assert "Broadcast" not in paid._jdf.queryExecution().executedPlan().toString()


def test_rules_broadcast_no_table(made):
    """Neither coupons nor the sales that reviews are checked with are built on the driver."""
    stored = {name: stage(made[name], name) for name in ("pagamentos", "avaliacoes")} | {
        name: made[name] for name in ("vendas", "fretes", "cupons")
    }
    found = datagen.invariants(*[stored[n] for n in ("vendas", "fretes", "pagamentos", "avaliacoes", "cupons")])
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_rules_notice_violations(made):
    spoiled = made["fretes"].filter("venda_id > 10").withColumn("valor_frete", F.lit(500.0))
    args = [made["vendas"], spoiled, made["pagamentos"], made["avaliacoes"].limit(50), made["cupons"]]
    counts = {r.regra: r.violacoes for r in datagen.invariants(*args).collect()}
    assert counts["um_frete"] == 10
    assert counts["faixa_frete"] == 4_000
    assert counts["amostra_exata"] != 0


def test_same_rows_however_partitioned(spark):
    keys = [spark.range(1, 2_001, 1, parts) for parts in (1, 8)]
    one, many = (sorted(map(repr, datagen.gen_clientes(k).collect())) for k in keys)
    assert one == many


def test_seasons(made):
    months = made["vendas"].groupBy(F.month("data_venda").alias("m"), F.year("data_venda").alias("y")).count()
    counts = {(r.y, r.m): r["count"] for r in months.collect()}
    assert counts[2022, 11] > 2 * counts[2022, 1]
    assert min(counts) >= (2022, 1) and max(counts) <= (2024, 6)
    span = datagen._day_slots(made["vendas"].sparkSession).agg(F.count("*"), F.max("casa"), F.min("dia"), F.max("dia"))
    n, last, first_day, last_day = span.first()
    assert n == last + 1 == datagen.total_day_weight()
    assert first_day == V.FIRST_DAY and (last_day - first_day).days == V.DAYS - 1


def test_dependent_values(made):
    assert made["clientes"].filter(~F.col("documento").rlike(
        r"^(\d{3}\.\d{3}\.\d{3}-\d{2}|\d{2}\.\d{3}\.\d{3}/0001-\d{2})$")).count() == 0
    pairs = {(r.regiao, r.cidade) for r in made["clientes"].select("regiao", "cidade").distinct().collect()}
    assert pairs == {(r, c) for r, cities in V.CITIES.items() for c in cities}
    for r in made["produtos"].collect():
        low, high = V.PRICE_RANGES[r.categoria]
        assert low <= r.preco <= high
        assert any(r.nome.startswith(p + " ") for p in V.NAME_PREFIXES[r.categoria])
    share = made["vendas"].filter("cupom_id is not null").count() / 4_000
    assert 0.12 < share < 0.25
    far = made["fretes"].join(made["vendas"], "venda_id").join(made["clientes"], "cliente_id")
    mean = {r.regiao: r.v for r in far.groupBy("regiao").agg(F.avg("valor_frete").alias("v")).collect()}
    assert mean["Norte"] > 1.3 * mean["Sul"] and mean["Centro-Oeste"] > 1.1 * mean["Sul"]


def test_reviews_fit_their_rating(made):
    mood = {5: "positivo", 4: "positivo", 3: "neutro", 2: "negativo", 1: "negativo"}
    for r in made["avaliacoes"].select("nota", "comentario").distinct().collect():
        assert r.comentario in V.COMMENTS[mood[r.nota]]


def test_export_and_report(spark, made, folder):
    datagen.export_all(made, folder, "20240101T000000")
    report = drops.drop_report(spark, folder)
    assert {r.tabela for r in report.collect()} == set(schemas.RAW)
    assert report.filter("bytes <= 0 or arquivos <= 0").count() == 0
    back = drops.pick_drop(spark, folder, "vendas", schemas.RAW["vendas"])
    assert sorted(map(repr, back.collect())) == sorted(map(repr, made["vendas"].collect()))
