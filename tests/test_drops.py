"""Reading drops by their headers: order, missing and added columns, damaged parts."""

import pathlib

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from balcao.sources import drops

SCHEMA = "a int, b int, c string"


def put(folder, name, text):
    path = pathlib.Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def swapped(folder):
    return put(folder, "t_20240101T000000.csv", "b,a,c\n2,1,x\n4,3,\n")


@pytest.mark.parametrize("on_error", ["raise", "null", "quarantine"])
def test_columns_go_by_name(spark, swapped, on_error):
    df = drops.read_csv(spark, swapped, SCHEMA, on_error)
    assert df.columns[:3] == ["a", "b", "c"]
    assert rows(df.select("a", "b", "c")) == [(1, 2, "x"), (3, 4, None)]
    if on_error == "quarantine":
        assert {r[drops.REJECTED] for r in df.collect()} == {None}


def test_missing_columns(spark, folder):
    path = put(folder, "t_20240101T000000.csv", 'b,a\n2,1\n"4",3\nx,5\n')
    with pytest.raises(drops.DropHeaderError, match="'c'"):
        drops.read_csv(spark, path, SCHEMA)
    assert rows(drops.read_csv(spark, path, SCHEMA, "null")) == [(1, 2, None), (3, 4, None), (5, None, None)]
    kept = rows(drops.read_csv(spark, path, SCHEMA, "quarantine"))
    assert kept == [(1, 2, None, "2,1"), (3, 4, None, "4,3"), (5, None, None, "x,5")]


def test_added_columns(spark, folder):
    path = put(folder, "t_20240101T000000.csv", 'a,new,b,"with, comma",c\n1,?,2,"y,z",x\n3,?,four,,\n')
    with pytest.raises(drops.DropHeaderError, match="new"):
        drops.read_csv(spark, path, SCHEMA)
    assert rows(drops.read_csv(spark, path, SCHEMA, "null")) == [(1, 2, "x"), (3, None, None)]
    kept = rows(drops.read_csv(spark, path, SCHEMA, "quarantine"))
    assert kept == [(1, 2, "x", None), (3, None, None, "3,?,four,,")]


@pytest.mark.parametrize("on_error", ["null", "quarantine"])
def test_drops_that_differ_are_merged(spark, folder, on_error):
    put(folder, "t_20240101T000000.csv", "a,b,c\n1,2,x\n")
    put(folder, "t_20240102T000000.csv", "C,A,B\ny,3,4\n")
    put(folder, "t_20240103T000000.csv", "c,a\nz,5\n")
    put(folder, "t_20240104T000000.csv", "a,b,c\n7,8,w\n")
    put(folder, "t_20240105T000000.csv", "")
    df = drops.pick_drop(spark, folder, "t", SCHEMA, "all", on_error)
    assert rows(df.select("a", "b", "c")) == [(1, 2, "x"), (3, 4, "y"), (5, None, "z"), (7, 8, "w")]
    # The two drops of the same header share a scan.
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3
    assert rows(drops.pick_drop(spark, folder, "t", SCHEMA, "first", on_error).select("a", "b", "c")) == [(1, 2, "x")]
    # A file without a byte is no drop: Spark does not list it.
    assert rows(drops.pick_drop(spark, folder, "t", SCHEMA, "latest", on_error).select("a", "b", "c")) == [(7, 8, "w")]


def test_sizes_and_parts_of_drops(spark, folder):
    """Bytes as written, whatever the writer."""
    put(folder, "t_20240101T000000.csv", "a,b\n" + "x" * (3 << 20))
    put(folder, "t_20240102T000000.csv/part-0.csv", "12345")
    put(folder, "t_20240102T000000.csv/part-1.csv", "123")
    put(folder, "u_20240102T000000.csv", "12")
    assert rows(drops.drop_report(spark, folder)) == [
        ("t", "20240101T000000", 1, (3 << 20) + 4, 3.0),
        ("t", "20240102T000000", 2, 8, 0.0),
        ("u", "20240102T000000", 1, 2, 0.0),
    ]


def test_a_drop_of_nothing_but_its_name(spark, folder):
    path = put(folder, "t_20240101T000000.csv", "")
    assert rows(drops.read_csv(spark, path, SCHEMA)) == []


def test_report_of_headers(spark, folder):
    put(folder, "t_20240101T000000.csv", "a,b,c\n1,2,x\n")
    put(folder, "t_20240102T000000.csv", "﻿b, a ,d\n1,2,x\n")
    put(folder, "t_20240103T000000.csv", "")
    found = rows(drops.header_report(spark, folder, "t", SCHEMA))
    one, two = "20240101T000000", "20240102T000000"
    assert found == sorted(
        [("t", one, "a", 1, "ok"), ("t", one, "b", 2, "ok"), ("t", one, "c", 3, "ok"),
         ("t", two, "a", 2, "deslocada"), ("t", two, "b", 1, "deslocada"), ("t", two, "c", None, "ausente"),
         ("t", two, "d", 3, "desconhecida")], key=repr)
    assert drops.header_report(spark, folder, "other", SCHEMA).count() == 0


@pytest.mark.parametrize("on_error", ["raise", "null", "quarantine"])
def test_a_part_unlike_its_drop_fails(spark, folder, on_error):
    """Its values would land in other columns."""
    put(folder, "t_20240101T000000.csv/part-0.csv", "a,b,c\n" + "1,2,x\n" * 50)
    put(folder, "t_20240101T000000.csv/part-1.csv", "b,a,c\n1,2,x\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)header"):
        drops.pick_drop(spark, folder, "t", SCHEMA, "all", on_error).collect()


@pytest.mark.parametrize("on_error", ["raise", "null", "quarantine"])
def test_a_column_named_twice_fails(spark, folder, on_error):
    path = put(folder, "t_20240101T000000.csv", "a,b,A,c\n1,2,3,x\n")
    with pytest.raises(drops.DropHeaderError, match="more than once"):
        drops.read_csv(spark, path, SCHEMA, on_error)


def test_without_a_schema(spark, folder):
    put(folder, "t_20240101T000000.csv", "a,b\n1,x\n")
    put(folder, "t_20240102T000000.csv", "b,c,a\ny,2.5,3\n")
    df = drops.pick_drop(spark, folder, "t", which="all")
    assert dict(df.dtypes) == {"a": "int", "b": "string", "c": "double"}
    assert rows(df.select("a", "b", "c")) == [(1, "x", None), (3, "y", 2.5)]


def test_bad_values_still_fail_or_vanish(spark, folder):
    path = put(folder, "t_20240101T000000.csv", "c,b,a\nx,2,1\ny,?,3\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        drops.read_csv(spark, path, SCHEMA).collect()
    assert rows(drops.read_csv(spark, path, SCHEMA, "null")) == [(1, 2, "x"), (3, None, "y")]
    assert rows(drops.read_csv(spark, path, SCHEMA, "quarantine")) == [(1, 2, "x", None), (3, None, "y", "y,?,3")]
