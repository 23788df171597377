"""The stand-in tables keep everything that the given tables hold."""

import gzip
import pathlib

import pytest
from pyspark.sql import functions as F

from balcao.checks import queries, warehouse
from balcao.checks.standins import STANDINS
from balcao.checks.warehouse import open_warehouse

SMALL = "/root/testdata/sf0.001"


def test_sales_keep_every_line_item(spark):
    warehouse = open_warehouse(spark, SMALL)
    lines, sales = warehouse.given("lineitem"), warehouse.raw("vendas")
    given = lines.agg(F.count("*"), F.sum("l_quantity").cast("bigint")).first()
    kept = sales.agg(F.count("*"), F.sum("quantidade")).first()
    assert tuple(kept) == tuple(given)
    assert sales.select("venda_id").distinct().count() == given[0]


def test_numbers_longer_than_their_padding_stay_whole(spark):
    text = STANDINS["cupons"].columns["codigo"]
    codes = spark.range(9_990, 10_020).select(F.expr(text.replace("p_partkey", "id")).alias("c"))
    assert codes.distinct().count() == 30
    assert codes.filter("c = 'CUP10000'").count() == 1


ITEM = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, " \
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


def given_items(spark, folder, keys):
    """Tables whose line items and orders repeat, with null keys, and lines that differ in one column only."""
    rows = [(order, line, 90 - i % 2, i % 3, 1.0 + i % 2, 9.5 - i % 4, 0.05 * (i % 5), 0.0, "R", "F", None) for i, (order, line) in enumerate(keys)]
    spark.createDataFrame(rows, ITEM).write.parquet(f"{folder}/lineitem.parquet")
    sold = [(i % 5 or None, i, "FPO"[i % 3], "345"[i % 3] + "-x", "1997-01-01") for i in range(9)]
    orders = spark.createDataFrame(sold, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, d string")
    orders.withColumn("o_orderdate", F.col("d").cast("timestamp")).write.parquet(f"{folder}/orders.parquet")
    return open_warehouse(spark, folder)


@pytest.mark.parametrize("name", ["v_linha", "vendas", "pagamentos"])
def test_tables_built_in_fewer_shuffles_are_those_of_the_stand_ins(spark, folder, name):
    keys = [(1, 1), (1, 2), (2, 1), (None, 1), (3, None), (None, None), (4, 1)] * 6
    opened = given_items(spark, folder, keys)
    found, want = opened.raw(name), opened.derived(name)
    assert found.schema.simpleString() == want.schema.simpleString()
    assert found.count() and sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))


def test_line_items_are_shuffled_once_and_narrow(spark, folder, monkeypatch):
    plans = []
    monkeypatch.setattr(warehouse, "stage", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    opened = given_items(spark, folder, [(1, 1), (1, 2)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        opened.raw("vendas")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 2  # of line items and of orders
    assert "l_shipdate" not in plans[0]


def test_only_the_older_drop_is_written_as_plain_text(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: f"{folder}/{label}")
    opened = open_warehouse(spark, SMALL)
    found = queries.pick_drop_strict(opened)
    every, settled = opened.raw("vendas").count(), opened.raw("vendas").filter("status <> 'PENDENTE'").count()
    assert {r.escolha: r["count"] for r in found.groupBy("escolha").count().collect()} == {"latest": every, "first": settled, "all": every + settled}
    written = list(pathlib.Path(folder, "drops").glob("*/part-*"))
    assert len({path.parent for path in written}) == 5
    assert {path.parent.name for path in written if path.suffix != ".gz"} == {f"vendas_{queries.OLD_STAMP}.csv"}
    for stray in {path.parent for path in written if not path.parent.name.endswith((".csv.gz", f"{queries.OLD_STAMP}.csv"))}:
        # Each stray holds all sales, though none is picked.
        lines = sum(gzip.open(path, "rt").read().count("\n") - 1 for path in stray.glob("part-*"))
        assert lines == every
