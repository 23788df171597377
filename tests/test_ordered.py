"""Ordered operators against plain Python, with one group holding most rows."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from balcao.operators.ordered import (
    latest_n,
    latest_per_group,
    position,
    previous,
    running_max,
    with_prefix,
)


@pytest.fixture(scope="module")
def rows():
    made = []
    for i in range(3000):
        group = "quente" if i % 3 else (None if i % 5 == 0 else f"g{i % 40}")
        value = None if i % 7 == 0 else (i * 7919) % 1009
        made.append((group, (i * 31) % 3001, value))
    return made


def expected(rows):
    groups = defaultdict(list)
    for group, at, value in rows:
        groups[group].append((at, value))
    out = set()
    for group, items in groups.items():
        before, top = None, None
        for place, (at, value) in enumerate(sorted(items), 1):
            top = value if top is None else (top if value is None else max(top, value))
            out.add((group, at, value, before, top, place))
            before = before if value is None else value
    return out


@pytest.fixture
def small_blocks(spark):
    """Keep the partitions that a small table would have merged."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_prefixes_in_merged_blocks(spark, rows):
    df = spark.createDataFrame(rows, "g string, at int, v int").repartition(5)
    check_prefixes(df, rows)


@pytest.mark.parametrize("tasks", [1, 8, 64])
def test_prefixes(spark, rows, tasks, small_blocks):
    df = spark.createDataFrame(rows, "g string, at int, v int").repartition(5)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        check_prefixes(df, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def check_prefixes(df, rows):
    found = with_prefix(
        df, ["g"], ["at"], antes=previous("v"), topo=running_max("v"), lugar=position()
    )
    got = [tuple(r) for r in found.select("g", "at", "v", "antes", "topo", "lugar").collect()]
    assert len(got) == len(rows)
    assert set(got) == expected(rows)


def test_hot_group_is_spread(spark, rows, small_blocks):
    """No block of the ordering holds much more than its share of the hot group."""
    from balcao.operators.ordered import BLOCK, _in_blocks

    df = spark.createDataFrame(rows, "g string, at int, v int")
    sizes = [r["count"] for r in _in_blocks(df, ["g"], ["at"]).groupBy(BLOCK).count().collect()]
    assert max(sizes) < 2 * len(rows) / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_without_group(spark, small_blocks):
    df = spark.range(500).select((F.col("id") * 17 % 500).alias("k"))
    found = with_prefix(df, [], ["k"], lugar=position())
    assert all(r.lugar == r.k + 1 for r in found.collect())


def test_blocks_follow_the_order_when_merged(spark):
    """Merging takes neighbours only, so block numbers still rise with the order."""
    from balcao.operators.ordered import BLOCK, _in_blocks

    spark.conf.set("spark.sql.shuffle.partitions", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "10KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    try:
        df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("k"))
        blocked = _in_blocks(df, [], ["k"])
        ends = blocked.groupBy(BLOCK).agg(F.min("k").alias("a"), F.max("k").alias("b"))
        ends = ends.orderBy(BLOCK).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert 1 < len(ends) < 50
    assert all(before.b < after.a for before, after in zip(ends, ends[1:]))


def test_empty(spark):
    df = spark.createDataFrame([], "g string, at int, v int")
    assert with_prefix(df, ["g"], ["at"], antes=previous("v")).count() == 0


def test_latest(spark, rows):
    df = spark.createDataFrame(rows, "g string, at int, v int")
    groups = defaultdict(list)
    for group, at, value in rows:
        groups[group].append((at, value))
    for n in (1, 30):
        found = latest_n(df, ["g"], [F.desc("at")], n)
        want = {(g, *item) for g, items in groups.items() for item in sorted(items, key=lambda x: -x[0])[:n]}
        assert {tuple(r) for r in found.collect()} == want
    assert latest_per_group(df, ["g"], [F.desc("at")]).count() == len(groups)
