"""Open intervals on a day against a plain search."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from balcao.operators import intervals as spans

DAY = date(2023, 1, 1)


def made(rng, n):
    rows = []
    for i in range(n):
        first = DAY + timedelta(days=rng.randrange(400))
        rows.append((rng.randrange(-50, 10 * n) * 3 + i % 3, first, first + timedelta(days=rng.choice([0, 1, 7, 90]))))
    rows += [(7_000_000, date(1, 1, 1), date(9999, 12, 31)), (7_000_001, DAY, DAY - timedelta(days=1))]
    return rows + [(7_000_002, None, DAY), (7_000_003, DAY, None), (7_000_004, date(9999, 12, 31), date(9999, 12, 31))]


def open_on(rows, day):
    return sorted(i for i, a, b in rows if a and b and day and a <= day <= b)


@pytest.mark.parametrize("n", [0, 3, 14, 40, 700])
def test_counts_and_places(spark, n):
    rng = random.Random(n)
    rows = made(rng, n)
    days = [DAY + timedelta(days=i) for i in range(-3, 500, 7)] + [date(1, 1, 1), date(9999, 12, 31), None]
    intervals = spark.createDataFrame(rows, "id bigint, first date, last date")
    asked = spark.createDataFrame([(d,) for d in days], "day date")
    counts = {r.day: (r.n, r.least) for r in spans.open_on(asked, intervals).collect()}
    assert counts == {d: (len(open_on(rows, d)), open_on(rows, d)[0]) for d in days if d and open_on(rows, d)}
    places = sorted({(d, k) for d in days if d for k in [0, 1, 5, rng.randrange(n + 1), len(open_on(rows, d)) - 1, 10**6]})
    questions = spark.createDataFrame([*places, (None, 0), (DAY, None)], "day date, nth int")
    found = {(r.day, r.nth): r.id for r in spans.nth_open(questions, intervals).collect()}
    want = {(d, k): open_on(rows, d)[k] for d, k in places if 0 <= k < len(open_on(rows, d))}
    assert found == want


@pytest.mark.parametrize("n", [0, 3, 40, 700])
def test_picks(spark, n):
    rng = random.Random(n)
    rows = made(rng, n)
    asked = [(i, DAY + timedelta(days=rng.randrange(-3, 500)), rng.randrange(-1000, 10**6)) for i in range(300)]
    asked += [(1000, None, 5), (1001, DAY, None), (1002, date(1, 1, 1), 3)]
    intervals = spark.createDataFrame(rows, "id bigint, first date, last date")
    frame = spark.createDataFrame([(*a, 1, 2) for a in asked], "row bigint, on date, draw bigint, id int, before int")
    picked = spans.pick_open(frame, "on", "draw", intervals, "row", "chosen")
    assert set(picked.columns) == {*frame.columns, "chosen"}
    found = {r.row: r.chosen for r in picked.collect()}
    options = {i: open_on(rows, day) for i, day, _ in asked}
    assert found == {i: options[i][k % len(options[i])] if options[i] and k is not None else None for i, _, k in asked}


def test_without_intervals_or_questions(spark):
    none = spark.createDataFrame([], "id bigint, first date, last date")
    asked = spark.createDataFrame([(DAY, 0)], "day date, nth int")
    assert spans.open_on(asked, none).collect() == []
    assert spans.nth_open(asked, none).collect() == []
    one = spark.createDataFrame([(1, DAY, DAY)], "id bigint, first date, last date")
    assert spans.nth_open(asked.limit(0), one).collect() == []
    assert spans.open_on(asked.limit(0), one).collect() == []


@pytest.mark.parametrize("length, most", [(0, 1), (6, 5), (100, 12), (1_000_000, 40)])
def test_rows_formed_do_not_grow_with_days(spark, length, most):
    """Spans that make up an interval: about twice the logarithm of its days."""
    first = [F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("first")]
    made = spark.range(300).select("id", *first).withColumn("last", F.date_add("first", length))
    per_interval = spans.spans_of(made, "id").groupBy("id").count()
    assert per_interval.agg(F.max("count"), F.count("count")).first()[0] <= most
    assert per_interval.count() == 300


def test_nothing_built_for_spans_is_broadcast(spark):
    """Files of a few MB hold answers of hundreds of MB, so their size must not choose the join."""
    intervals = spark.createDataFrame([(i, DAY, DAY + timedelta(days=i)) for i in range(40)], "id bigint, first date, last date")
    asked = spark.createDataFrame([(DAY, k) for k in range(40)], "day date, nth int")
    rows = spark.createDataFrame([(i, DAY, i) for i in range(9)], "row bigint, day date, pick bigint")
    named = spans.pick_open(rows, "day", "pick", intervals, "row", "found")
    for found, joins in ((spans.open_on(asked.select("day").distinct(), intervals), 1), (spans.nth_open(asked, intervals), 3), (named, 4)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        # Only what is found for whole days, a row per day, may be broadcast.
        assert plan.count("BroadcastHashJoin") <= (found is named)
        assert plan.count("SortMergeJoin") >= joins
