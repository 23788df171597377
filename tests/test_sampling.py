import pytest
from pyspark.sql import functions as F

from balcao.functions.draws import BITS, Draws, slots
from balcao.operators.sampling import sample_exact


@pytest.mark.parametrize("portable", [False, True])
@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.3, 0.7, 1.0])
def test_sample_is_exact_and_by_smallest_draw(spark, fraction, portable):
    df = spark.range(3_000).withColumnRenamed("id", "k")
    draw = Draws("k", 5, portable).bits("amostra")
    by_draw = [r.k for r in df.orderBy(draw, "k").collect()]
    found = {r.k for r in sample_exact(df, "k", fraction, 5, portable).collect()}
    assert found == set(by_draw[: int(3_000 * fraction)])


def test_sample_of_nothing(spark):
    assert sample_exact(spark.range(0), "id", 0.5).count() == 0


@pytest.mark.parametrize("portable", [False, True])
def test_draws_do_not_depend_on_partitions(spark, portable):
    d = Draws("id", 42, portable)
    columns = [
        "id",
        d.uniform("a", 10.0, 20.0).alias("u"),
        d.integer("b", 3, 9).alias("i"),
        d.choice("c", ["x", "y", "z"]).alias("c"),
        d.weighted("d", {"m": 3, "n": 1}).alias("w"),
    ]
    seen = [
        sorted(map(tuple, spark.range(0, 2_000, 1, parts).select(*columns).collect()))
        for parts in (1, 8)
    ]
    assert seen[0] == seen[1]


@pytest.mark.parametrize("portable", [False, True])
def test_draws_are_spread(spark, portable):
    d = Draws("id", 42, portable)
    stats = (
        spark.range(20_000)
        .select(
            d.unit("a").alias("u"), d.unit("b").alias("v"), d.bits("a").alias("bits"),
            d.integer("i", 3, 9).alias("i"), d.weighted("w", {"m": 3, "n": 1}).alias("w"),
        )
        .agg(
            F.avg("u"), F.corr("u", "v"), F.max("bits"), F.min("i"), F.max("i"),
            F.avg((F.col("w") == "m").cast("int")),
        )
        .first()
    )
    assert abs(stats[0] - 0.5) < 0.01
    assert abs(stats[1]) < 0.03
    assert 2 ** (BITS - 1) < stats[2] < 2**BITS
    assert (stats[3], stats[4]) == (3, 9)
    assert abs(stats[5] - 0.75) < 0.01


def test_slots():
    assert slots({"a": 85, "b": 15}) == ["a"] * 17 + ["b"] * 3
    assert slots({1: 1.5, 2: 0.5}) == [1, 1, 1, 2]


@pytest.mark.parametrize("fraction", [0.1, 0.35, 0.5, 0.65, 0.9])
def test_sample_cuts_through_copies_of_one_key(spark, fraction):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    found = sample_exact(rows, "k", fraction, 3)
    assert found.count() == int(3_000 * fraction)
    assert found.select("v").distinct().count() == int(3_000 * fraction)
    draw = Draws("k", 3).bits("amostra")
    highest = found.agg(F.max(draw)).first()[0]
    assert rows.filter(draw < highest).count() <= int(3_000 * fraction)
