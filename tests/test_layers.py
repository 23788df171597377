import pytest

from balcao.sources import drops, layers, schemas, scratch


def test_publish_read_and_history(spark, folder):
    df = spark.range(10)
    assert layers.publish_all(spark, {"a": df, "b": df.limit(3)}, folder, "bronze") == {"a": 10, "b": 3}
    assert layers.publish(layers.read_table(spark, folder, "bronze", "a").filter("id < 4"), folder, "bronze", "a") == 4
    assert layers.read_table(spark, folder, "bronze", "a").count() == 4
    newest = layers.table_history(spark, folder, "bronze", "a").collect()
    assert [(r.versao, r.operacao, r.linhas) for r in newest] == [(2, "OVERWRITE", 4)]
    every = layers.table_history(spark, folder, "bronze", "a", n=None).collect()
    assert [r.versao for r in every] == [2, 1]
    assert layers.table_history(spark, folder, "silver", "a").count() == 0


def test_never_published(spark, folder):
    assert layers.read_table(spark, folder, "bronze", "a") is None
    assert layers.table_history(spark, folder, "bronze", "a") is None
    layers.publish(spark.range(1), folder, "bronze", "a")
    assert layers.read_table(spark, folder, "bronze", "b") is None


def test_empty_tables_are_counted(spark, folder):
    assert layers.publish(spark.range(10).filter("id > 50"), folder, "bronze", "a") == 0
    assert layers.publish(spark.createDataFrame([], "x int"), folder, "bronze", "b") == 0
    assert layers.read_table(spark, folder, "bronze", "b").columns == ["x"]


def test_failed_write_leaves_the_table(spark, folder):
    layers.publish(spark.range(10), folder, "bronze", "a")
    broken = spark.range(10).selectExpr("cast(concat('x', id) as int) as id")
    with pytest.raises(Exception):
        layers.publish(broken, folder, "bronze", "a")
    assert layers.read_table(spark, folder, "bronze", "a").count() == 10
    assert layers.publish(spark.range(3), folder, "bronze", "a") == 3
    assert layers.read_table(spark, folder, "bronze", "a").count() == 3


def test_publish_runs_the_plan_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)
    counted = spark.range(100).rdd.map(lambda r: (seen.add(1), r)[1]).toDF("id bigint")
    assert layers.publish(counted, folder, "bronze", "a") == 100
    assert seen.value == 100


@pytest.fixture
def dropped(spark, folder):
    for stamp, n in {"20240101T000000": 1, "20240301T000000": 3, "20240201T000000": 2}.items():
        drops.export_csv(spark.range(n), folder, "vendas", stamp)
    drops.export_csv(spark.range(50), folder, "vendas_extra", "20250101T000000")
    return folder


def test_pick_drop(spark, dropped):
    for which, count in {"latest": 3, "first": 1, "all": 6}.items():
        assert drops.pick_drop(spark, dropped, "vendas", "id bigint", which).count() == count
    assert drops.pick_drop(spark, dropped, "fretes", "id bigint") is None
    assert drops.pick_drop(spark, dropped + "/nada", "vendas", "id bigint") is None
    with pytest.raises(ValueError):
        drops.pick_drop(spark, dropped, "vendas", which="newest")


def test_single_file_drops(spark, folder):
    for stamp, rows in {"20240101T000000": "1,a\n", "20240102T000000": "2,b\n3,ção\n"}.items():
        with open(f"{folder}/t_{stamp}.csv", "w", encoding="utf-8") as f:
            f.write("id,nome\n" + rows)
    found = drops.pick_drop(spark, folder, "t", "id bigint, nome string")
    assert sorted(map(tuple, found.collect())) == [(2, "b"), (3, "ção")]
    inferred = drops.pick_drop(spark, folder, "t", which="first")
    assert inferred.dtypes == [("id", "int"), ("nome", "string")]


def test_values_that_do_not_fit(spark, folder):
    with open(f"{folder}/t_20240101T000000.csv", "w", encoding="utf-8") as f:
        f.write("id,dia\n1,2024-01-31\nx,2024-01-31\n3,\n")
    pick = lambda how: drops.pick_drop(spark, folder, "t", "id bigint, dia date", on_error=how)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        pick("raise").collect()
    assert sorted(str(r.id) for r in pick("null").collect()) == ["1", "3", "None"]
    rejected = pick("quarantine").cache().filter("registro_invalido is not null").collect()
    assert [r.registro_invalido for r in rejected] == ["x,2024-01-31"]
    with pytest.raises(ValueError):
        pick("skip")


def test_listing_reads_no_content(spark, dropped):
    plan = drops.drop_files(spark, dropped, "vendas")._jdf.queryExecution().executedPlan().toString()
    assert "path" in plan and "content" not in plan


def test_clock_stays_text(spark, folder):
    with open(f"{folder}/vendas_20240101T000000.csv", "w", encoding="utf-8") as f:
        f.write("venda_id,cliente_id,produto_id,quantidade,desconto_pct,cupom_id,status,canal,data_venda,hora_venda\n")
        f.write("1,2,3,4,5,,CONCLUIDO,app,2024-02-29,06:07:08\n")
    row = drops.pick_drop(spark, folder, "vendas", schemas.RAW["vendas"]).first()
    assert (row.cupom_id, row.hora_venda, str(row.data_venda)) == (None, "06:07:08", "2024-02-29")


def test_describe_and_count(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    described = layers.describe_tables({"t": df, "u": df.limit(1)}).collect()
    assert sorted(map(tuple, described)) == [
        ("t", 1, "a", "bigint", 2), ("t", 2, "b", "string", 1),
        ("u", 1, "a", "bigint", 1), ("u", 2, "b", "string", 0),
    ]
    assert sorted(map(tuple, layers.row_counts({"t": df, "u": df.limit(1)}).collect())) == [("t", 2), ("u", 1)]


def test_sample_rows(spark):
    found = layers.sample_rows({"t": spark.range(50), "u": spark.range(1)}, 3).collect()
    assert [r.tabela for r in found].count("t") == 3
    assert ("u", '{"id":0}') in [tuple(r) for r in found]


def test_scratch_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_folder(spark).startswith(named)
    staged = scratch.stage(spark.range(5), "prova")
    assert staged.count() == 5 and staged.inputFiles()[0].split("://")[-1].startswith(named)


def test_samples_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).selectExpr("id", "id % 7 as k", "cast(id as string) as texto")
    rows = rows.unionByName(rows.limit(10))
    frames = lambda n: {"a": rows.repartition(n), "b": rows.limit(0), "c": rows.filter("id < 2")}
    for keys in (None, {"a": "id"}):
        found = [sorted(map(tuple, layers.sample_rows(frames(n), 6, 3, keys).collect())) for n in (1, 13)]
        assert found[0] == found[1] and [t for t, _ in found[0]].count("a") == 6
        assert {t for t, _ in found[0]} == {"a", "c"}
        other = sorted(map(tuple, layers.sample_rows(frames(1), 6, 4, keys).collect()))
        assert other != found[0]
    plan = layers.sample_rows({"a": rows}, 6)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
