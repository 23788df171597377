from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from balcao.functions import cleaning, money
from balcao.operators.typing import REJECTED, cast_columns, require_key
from balcao.plans import silver


def values(df, column="out"):
    return [row[column] for row in df.collect()]


def one_column(spark, kind, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}").orderBy("i")


@pytest.mark.parametrize(
    "score, band",
    [(None, "ruim"), (499.9, "ruim"), (500.0, "regular"), (699.9, "regular"), (700.0, "bom")],
)
def test_score_band_edges(spark, score, band):
    df = one_column(spark, "double", [score]).select(cleaning.score_band(F.col("v")).alias("out"))
    assert values(df) == [band]


def test_part_of_day_edges(spark):
    clocks = ["11:59:59", "12:00:00", "17:59:59", "18:00:00", "06:00:00", None, "sem hora"]
    df = one_column(spark, "string", clocks).select(cleaning.part_of_day(F.col("v")).alias("out"))
    assert values(df) == ["manhã", "tarde", "tarde", "noite", "manhã", "noite", "noite"]


def test_part_of_day_of_a_timestamp(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 13:00:00' AS v")
    assert values(df.select(cleaning.part_of_day(F.col("v")).alias("out"))) == ["tarde"]


def test_digits_only(spark):
    df = one_column(spark, "string", ["12.345.678/0001-90", "", None])
    df = df.select(cleaning.digits_only(F.col("v")).alias("out"))
    assert values(df) == ["12345678000190", "", None]


def test_validity_includes_both_ends(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 10), date(2024, 1, 20)), (2, date(2024, 1, 10), None)],
        "i int, a date, b date",
    ).orderBy("i")
    for day, expected in {
        "2024-01-09": [False, False],
        "2024-01-10": [True, None],
        "2024-01-20": [True, None],
        "2024-01-21": [False, None],
    }.items():
        found = values(df.select(cleaning.active_on(F.col("a"), F.col("b"), day).alias("out")))
        assert found == expected, day


def test_active_today(spark):
    df = spark.range(1).select(
        cleaning.active_on(F.current_date(), F.current_date()).alias("out")
    )
    assert values(df) == [True]


def test_line_value_rounds_half_cents_up_and_keeps_fractional_discounts(spark):
    rows = [(1.005, 1, 0.0), (10.0, 3, 7.5), (19.99, 2, 15.0), (None, 1, 0.0), (0.29, 100, 0.0)]
    df = spark.createDataFrame(rows, "p double, q int, d double")
    df = df.select(money.line_value(F.col("p"), F.col("q"), F.col("d")).alias("out"))
    assert values(df) == [1.01, 27.75, 33.98, None, 29.0]


def test_totals_do_not_depend_on_order(spark):
    df = spark.range(100_000).select((F.col("id") % 7 / 10 + 0.01).alias("v"))
    totals = {
        df.repartition(n).agg(money.total(F.col("v")).alias("out")).first()["out"] for n in (1, 3, 8)
    }
    assert len(totals) == 1


def test_mean_of_nothing_is_null(spark):
    df = one_column(spark, "double", [None]).agg(money.mean(F.col("v")).alias("out"))
    assert values(df) == [None]


def test_percent_change(spark):
    df = spark.createDataFrame([(10, 4), (10, 0), (10, None), (0, 8)], "a bigint, b bigint")
    df = df.select(cleaning.percent_change(F.col("a"), F.col("b")).alias("out"))
    assert values(df) == [150.0, None, None, -100.0]


def test_bad_values(spark):
    df = spark.createDataFrame(
        [(1, "5", "2024-02-29"), (2, "x", "2024-02-30"), (3, None, None)], "i int, n string, d string"
    )
    types = {"n": "int", "d": "date"}
    with pytest.raises(PySparkException):
        cast_columns(df, types).collect()
    blank = cast_columns(df, types, "null").orderBy("i")
    assert values(blank, "n") == [5, None, None]
    marked = cast_columns(df, types, "quarantine").orderBy("i")
    assert values(marked, REJECTED) == [[], ["n", "d"], []]
    with pytest.raises(ValueError):
        cast_columns(df, types, "ignore")


def test_require_key(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert require_key(df, "a").count() == 2
    assert require_key(df, "a", "b").count() == 1


def test_unknown_status_is_dropped(spark):
    rows = [(1, 1, 1.0, 2, "x", "ENTREGUE"), (2, 2, 1.0, 2, "x", None), (3, 3, 1.0, 2, "x", "CANCELADO")]
    df = spark.createDataFrame(
        rows,
        "frete_id bigint, venda_id bigint, valor_frete double, prazo_dias int, "
        "transportadora string, status_entrega string",
    )
    assert values(silver.fretes(df), "frete_id") == [1]


def test_customers_without_sales_keep_null_counters(spark):
    who = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "cliente_id bigint, nome string")
    sales = spark.createDataFrame(
        [(10, 1, 2, "CONCLUIDO"), (11, 1, 3, "CONCLUIDO"), (12, 2, 9, "PENDENTE")],
        "venda_id bigint, cliente_id bigint, quantidade int, status string",
    )
    found = silver.with_purchase_stats(who, sales).orderBy("cliente_id").collect()
    assert [(r.qtd_compras, r.qtd_itens) for r in found] == [(2, 5), (None, None), (None, None)]
