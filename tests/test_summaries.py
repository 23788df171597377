"""Marts from shared summaries, and sums that must agree between marts."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from balcao.checks.warehouse import AS_OF, open_warehouse
from balcao.operators.summaries import amount, distinct, fine_summary, known, roll_up, summarize
from balcao.plans import gold
from balcao.sources.scratch import stage


@pytest.fixture(scope="module")
def w(spark):
    return open_warehouse(spark, SMALL)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", sorted(gold.SERVED_BY))
def test_shared_summary_gives_the_same_mart(w, name):
    mart = gold.SALES_MARTS[name]
    assert rows(mart.of(w.clean("vendas"))) == rows(mart.of_summary(w.summary(gold.SERVED_BY[name])))


def test_shared_summary_gives_the_same_customers(w):
    fine, sales, who = w.summary(gold.BY_CUSTOMER), w.clean("vendas"), w.clean("clientes")
    assert rows(gold.top_clientes(sales, who)) == rows(gold.top_clientes_of_summary(fine, who))
    assert rows(gold.clientes_rfm(sales, who, AS_OF)) == rows(
        gold.clientes_rfm_of_summary(fine, who, AS_OF)
    )


def test_totals_agree_between_marts(w):
    sales = w.clean("vendas")
    whole = sales.agg(
        F.sum(F.col("valor_total").cast("decimal(20,4)")).cast("double").alias("receita"),
        F.count("venda_id").alias("vendas"),
    ).first()
    for name in ("receita_mensal", "receita_categoria", "receita_regiao", "receita_canal"):
        mart = gold.SALES_MARTS[name].of(sales).agg(
            F.sum(F.col("receita_total").cast("decimal(20,2)")).cast("double"), F.sum("qtd_vendas")
        )
        assert tuple(mart.first()) == (whole.receita, whole.vendas), name
    rfm = gold.clientes_rfm(sales, w.clean("clientes"), AS_OF).agg(
        F.sum(F.col("monetario").cast("decimal(20,2)")).cast("double"), F.sum("frequencia")
    )
    assert tuple(rfm.first()) == (whole.receita, whole.vendas)


def test_ties_in_a_ranking_are_broken_by_key(spark):
    sales = spark.range(40).select(
        F.col("id").alias("venda_id"),
        (39 - F.col("id")).alias("produto_id"),
        F.lit("n").alias("nome"),
        F.lit("c").alias("categoria"),
        F.lit(1).alias("quantidade"),
        F.lit(5.0).alias("valor_total"),
    )
    top = gold.SALES_MARTS["top_produtos"].of(sales).collect()
    assert [r.produto_id for r in top] == list(range(20))


def test_nulls_in_measures(spark):
    sales = spark.createDataFrame(
        [(1, "pix", None, None), (2, "pix", 10.0, 3), (None, "pix", 5.0, 1), (4, "boleto", None, None)],
        "venda_id bigint, metodo string, valor_total double, parcelas int",
    )
    mart = gold.SALES_MARTS["metodos_pagamento"]
    found = {r.metodo: tuple(r) for r in mart.of(sales).collect()}
    assert found["pix"] == ("pix", 2, 15.0, 2.0, 50.0)
    assert found["boleto"] == ("boleto", 1, None, None, 0.0)
    fine = fine_summary(sales, ["metodo", "venda_id"], mart.measures.values())
    assert rows(mart.of_summary(fine)) == rows(mart.of(sales))


def test_reviews_without_sale_form_the_null_category(spark):
    reviews = spark.createDataFrame(
        [(1, None, 2), (2, "Casa", 5), (3, "Casa", 4)], "avaliacao_id bigint, categoria string, nota int"
    )
    found = {r.categoria: (r.qtd_avaliacoes, r.nota_media) for r in gold.satisfacao_categoria(reviews).collect()}
    assert found == {None: (1, 2.0), "Casa": (2, 4.5)}


BITS = {"n": known("venda_id"), "distintos": distinct("cliente_id"), "total": amount("valor_total")}


def test_distinct_ids_roll_up_exactly(spark):
    """Ids at the borders of buckets, below zero, null, repeated across keys, and one very frequent."""
    border = [0, 1, -1, 32_767, 32_768, 32_769, -32_767, -32_768, -32_769, 1 << 40, -(1 << 40), None]
    ids = F.element_at(F.array(*[F.lit(i).cast("bigint") for i in border]), (F.col("id") % 12 + 1).cast("int"))
    sales = spark.range(6000).select(
        F.col("id").alias("venda_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, ids).otherwise(F.col("id") * 6151 % 200_000).alias("cliente_id"),
        (F.col("id") % 7).alias("mes"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 4).alias("canal"),
        F.when(F.col("id") % 13 > 0, F.col("id") / 100).alias("valor_total"),
    )
    fine = stage(fine_summary(sales, ["mes", "canal"], BITS.values()), "resumo")
    assert fine.agg(F.max(F.length("distintos_cliente_id"))).first()[0] == 4096
    for keys in (["mes"], ["canal"], ["mes", "canal"], []):
        assert rows(roll_up(fine, keys, BITS)) == rows(summarize(sales, keys, BITS))
    # Summaries of parts of the rows add up to the summary of all, as a later run would add to an earlier one.
    halves = [fine_summary(sales.filter(F.col("venda_id") % 2 == i), ["mes", "canal"], BITS.values()) for i in (0, 1)]
    assert rows(roll_up(halves[0].unionByName(halves[1]), ["mes"], BITS)) == rows(summarize(sales, ["mes"], BITS))
    assert rows(roll_up(fine_summary(sales.limit(0), ["mes"], BITS.values()), ["mes"], BITS)) == []


def test_a_summary_that_keeps_the_id_needs_no_bitmaps(spark):
    sales = spark.createDataFrame([(1, 5, 2.0), (2, 5, 1.0), (3, None, 1.0)], "venda_id int, cliente_id bigint, valor_total double")
    fine = fine_summary(sales, ["cliente_id"], BITS.values())
    assert "distintos_cliente_id" not in fine.columns
    assert rows(roll_up(fine, [], BITS)) == rows(roll_up(fine, [], BITS))
    assert roll_up(fine, [], {"d": distinct("cliente_id")}).first().d == 1


def test_two_kinds_of_ids_do_not_fit_one_summary(spark):
    with pytest.raises(ValueError, match="one kind of ids"):
        fine_summary(spark.range(3), [], [distinct("id"), distinct("other")])


@pytest.mark.parametrize("name", ["receita_mensal", "receita_canal"])
def test_distinct_counts_do_not_read_the_sales(w, name):
    mart = gold.SALES_MARTS[name].of_summary(w.summary(gold.BY_MONTH))
    assert set(mart.inputFiles()) == set(w.summary(gold.BY_MONTH).inputFiles())
    assert "cliente_id:" not in mart._jdf.queryExecution().executedPlan().toString().replace("distintos_cliente_id:", "")
