from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from balcao.operators import lookups
from balcao.plans import silver

DAY = date(2024, 1, 1)


@pytest.fixture
def shuffled(spark):
    """Joins as between tables too large to broadcast, with low limits for skew."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    }
    for key, value in low.items():
        spark.conf.set(key, value)
    yield
    for key in low:
        spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_lookup_with_mostly_null_keys(spark, shuffled):
    facts = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, F.col("id") % 50).alias("k")
    )
    dim = spark.range(0, 50, 20).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("nome"))
    found = lookups.left_lookup(facts, dim, "k", row_key="id")
    assert found.columns == ["k", "id", "nome"]
    assert found.count() == 20_000
    # 0, 20 and 40 are known, out of the five keys 0, 10, .. 40
    assert found.filter(F.col("nome").isNotNull()).count() == 20_000 / 10 * 3 / 5


def test_null_keys_are_spread(spark, shuffled):
    facts = spark.range(8_000).select("id", F.lit(None).cast("bigint").alias("k"))
    dim = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookups.left_lookup(facts, dim, "k", row_key="id")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(sizes) < 1_500


def test_default_on_miss(spark):
    facts = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "i bigint, k bigint")
    dim = spark.createDataFrame([(7, "sete")], "k bigint, nome string")
    found = lookups.lookup_default(facts, dim, "k", "nome", "nenhum", row_key="i").orderBy("i")
    assert [r.nome for r in found.collect()] == ["sete", "nenhum", "nenhum"]


def test_hot_customer_is_split(spark, shuffled, folder):
    """A customer with most of the sales does not end up in one task of the join."""
    wide = F.sha2(F.col("id").cast("string"), 256)
    sales = spark.range(0, 60_000, 1, 16).select(
        F.col("id").alias("venda_id"),
        F.when(F.col("id") % 3 != 0, F.lit(5)).otherwise(F.col("id") % 1000).alias("cliente_id"),
        (F.col("id") % 20).alias("produto_id"),
        wide.alias("texto"),
    )
    customers = spark.range(1000).select(
        F.col("id").alias("cliente_id"), F.lit("Sul").alias("regiao"), F.lit("bom").alias("faixa_score")
    )
    products = spark.range(20).select(
        F.col("id").alias("produto_id"), F.lit(1.0).alias("preco"), F.lit("n").alias("nome"),
        F.lit("c").alias("categoria"),
    )
    shipping = sales.select(
        "venda_id", F.lit(1.0).alias("valor_frete"), F.lit(2).alias("prazo_dias"),
        F.lit("t").alias("transportadora"), F.lit("ENTREGUE").alias("status_entrega"),
    )
    payments = sales.select("venda_id", F.lit("pix").alias("metodo"), F.lit(1).alias("parcelas"))
    joined = silver.star_join(sales, products, customers, shipping, payments)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000


@pytest.fixture
def coupons(spark):
    rows = [
        (i, DAY + timedelta(days=(i * 13) % 60), DAY + timedelta(days=(i * 13) % 60 + i % 20))
        for i in range(1, 60)
    ]
    rows += [
        (100, DAY, date(9999, 12, 31)),
        (101, date(1, 1, 1), DAY + timedelta(days=3)),
        (102, DAY + timedelta(days=5), DAY),
        (103, None, DAY),
        (104, DAY, None),
    ]
    return rows


@pytest.fixture
def sales():
    return [(i, DAY + timedelta(days=0 if i % 3 else i % 90)) for i in range(600)] + [(600, None)]


def frames(spark, sales, coupons):
    return (
        spark.createDataFrame(sales, "venda_id bigint, data_venda date"),
        spark.createDataFrame(coupons, "cupom_id bigint, validade_inicio date, validade_fim date"),
    )


def valid_on(coupons, day):
    if day is None:
        return []
    return sorted(i for i, a, b in coupons if a is not None and b is not None and a <= day <= b)


def test_coupon_pairs_and_smallest(spark, sales, coupons):
    sold, valid = frames(spark, sales, coupons)
    pairs = {r.data_venda: r for r in lookups.valid_pairs_per_day(sold, valid).collect()}
    for day in {d for _, d in sales if d}:
        options = valid_on(coupons, day)
        count = sum(d == day for _, d in sales)
        assert pairs[day].pares == count * len(options)
        assert pairs[day].menor_cupom == options[0]
    smallest = {r.venda_id: r.cupom_id for r in lookups.smallest_valid_coupon(sold, valid).collect()}
    assert smallest == {i: (valid_on(coupons, d) or [None])[0] for i, d in sales}


def test_coupon_assignment(spark, sales, coupons):
    sold, valid = frames(spark, sales, coupons)
    found = lookups.assign_valid_coupon(
        sold, valid, F.col("venda_id") % 2 == 0, F.col("venda_id") * 7, row_key="venda_id"
    )
    got = {r.venda_id: r.cupom_id for r in found.collect()}
    for i, day in sales:
        options = valid_on(coupons, day) if i % 2 == 0 else []
        assert got[i] == (options[i * 7 % len(options)] if options else None)


def test_reviews_keep_missing_sales(spark):
    reviews = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "avaliacao_id bigint, venda_id bigint")
    sales = spark.createDataFrame(
        [(10, 1, 5, 9.5, "2024-01")],
        "venda_id bigint, cliente_id bigint, produto_id bigint, valor_total double, ano_mes string",
    )
    products = spark.createDataFrame([(5, "copo", "Casa")], "produto_id bigint, nome string, categoria string")
    found = silver.review_chain(reviews, sales, products).orderBy("avaliacao_id").collect()
    assert [(r.venda_id, r.produto_nome, r.categoria) for r in found] == [
        (10, "copo", "Casa"), (11, None, None), (None, None, None)
    ]


def test_default_lookup_is_shuffled_at_every_size(spark):
    """A small file holds rows many times its size, which the driver would build to broadcast them."""
    facts = spark.createDataFrame([(1, 7), (2, None)], "i bigint, k bigint")
    dim = spark.createDataFrame([(7, "sete")], "k bigint, nome string")
    found = lookups.lookup_default(facts, dim, "k", "nome", "nenhum", row_key="i")
    plan = final_plan(found)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((r.i, r.nome) for r in found.collect()) == [(1, "sete"), (2, "nenhum")]
