"""Projections: rename, fill, cast, project, conform, audit, evolution."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from strata.mapping import ColumnMapping, mapping_frame
from strata.operators import (add_column_at, cast_by_mapping, conform_to_schema, fill_nulls,
                              project_to_target, rename_by_mapping, with_audit)
from tests.conftest import rows


def test_rename_swap_and_unknown(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = rename_by_mapping(df, {"a": "b", "B": "a", "zzz": "q"})
    assert out.columns == ["b", "a", "c"]
    assert tuple(out.first()) == (1, 2, 3)


def test_rename_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        rename_by_mapping(df, {"a": "b"})


def test_fill_nulls_rules(spark):
    df = spark.createDataFrame([(None, None, None), ("x", 1, None)],
                               "a string, b int, c timestamp")
    out = fill_nulls(df, {"a": "dflt", "b": "7"})
    assert rows(out, "a", "b") == [("dflt", 7), ("x", 1)]
    with pytest.raises(ValueError):
        fill_nulls(df, {"nope": "1"})
    with pytest.raises(PySparkException):
        fill_nulls(df, {"b": "N/A"}).collect()


def test_cast_by_mapping_skips_absent(spark):
    df = spark.createDataFrame([("1/2/2024", "12", "x")], "D string, N string, S string")
    out = cast_by_mapping(df, {"d": "date", "n": "int", "missing": "int"})
    r = out.first()
    assert r.D == dt.date(2024, 1, 2) and r.N == 12 and r.S == "x"


def test_mapping_from_frame_one_object(spark):
    m = mapping_frame(spark, [("s", "OBJ", "a", "A", "int", "0"),
                              ("s", "OBJ", "b", "B", "date", None),
                              ("s", "OTHER", "c", "C", "int", "1")])
    cm = ColumnMapping.from_frame(m, "OBJ")
    assert cm.renames == {"a": "A", "b": "B"}
    assert cm.defaults == {"A": "0"} and cm.types == {"A": "int", "B": "date"}
    with pytest.raises(ValueError):
        ColumnMapping.from_frame(m, "MISSING")


def test_project_to_target_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, B int, c int")
    assert project_to_target(df, ["C", "b", "zz"]).columns == ["B", "c"]


def test_conform_strict_and_lenient(spark):
    df = spark.createDataFrame([("1", "x", "extra"), ("bad", "y", "e")], "K string, v string, z string")
    schema = StructType([StructField("v", StringType()), StructField("k", IntegerType())])
    out = conform_to_schema(df, schema, on_error="null")
    assert out.columns == ["v", "k"]
    assert rows(out) == [("x", 1), ("y", None)]
    with pytest.raises(PySparkException):
        conform_to_schema(df, schema).collect()          # ANSI cast raises on "bad"
    with pytest.raises(ValueError):
        conform_to_schema(df.drop("v"), schema)
    filled = conform_to_schema(df.drop("v"), schema, on_error="null", missing="null")
    assert rows(filled) == [(None, None), (None, 1)]


def test_with_audit_and_add_column(spark):
    df = spark.createDataFrame([(1, "old")], "a int, ADDED_BY string")
    ts = dt.datetime(2024, 1, 1)
    out = with_audit(df, "r1", ts)
    assert out.columns == ["a", "ADDED_BY", "ADDED_ON", "MODIFIED_BY", "MODIFIED_ON"]
    assert tuple(out.first()) == (1, "r1", ts, "r1", ts)
    with pytest.raises(ValueError):
        with_audit(df, "")
    ev = add_column_at(out, "YARD_KEY", "int", after="a")
    assert ev.columns[:3] == ["a", "YARD_KEY", "ADDED_BY"]
    assert ev.schema["YARD_KEY"].dataType == IntegerType()


def test_conform_case_sensitive_option(spark):
    df = spark.createDataFrame([("1",)], "K string")
    schema = StructType([StructField("k", IntegerType())])
    assert conform_to_schema(df, schema).first().k == 1
    with pytest.raises(ValueError):
        conform_to_schema(df, schema, case_insensitive=False)
