"""Scalar rules: date ladder, zoned timestamps, casts, header names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import (cast_by_type_name, normalize_headers, normalize_name,
                              parse_date_ladder, parse_zoned_timestamp, try_cast_by_type)

PARSES = {
    "1/2/2024": dt.date(2024, 1, 2), "01/02/2024": dt.date(2024, 1, 2),
    "12-31-2023": dt.date(2023, 12, 31), "2024-03-04": dt.date(2024, 3, 4),
    "2024-03-04T10:00:00Z": dt.date(2024, 3, 4),
}
NULLS = ["2024-03-04 10:00:00", "1/2/24", "1-2-2023", "2024-3-4", "2024/03/04", "31/12/2024",
         "02/30/2024", " 1/2/2024", "1/2/2024 ", "", "13/40/2024", None, "2024-03-04t10:00:00Z"]


def _plain_ladder(c):
    c = F.col(c)
    return F.coalesce(F.try_to_date(c, "M/d/yyyy"), F.try_to_date(c, "MM-dd-yyyy"),
                      F.try_to_date(c, "yyyy-MM-dd"),
                      F.try_to_date(F.regexp_replace(c, "T.*", ""), "yyyy-MM-dd"))


def test_date_ladder_fixture(spark):
    vals = list(PARSES) + NULLS
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.v: (r.d, r.p) for r in df.select(
        "v", parse_date_ladder("v").alias("d"), _plain_ladder("v").alias("p")).collect()}
    for v, want in PARSES.items():
        assert got[v][0] == want, v
    for v in NULLS:
        assert got[v][0] is None, v
    # the guards never change a result of the plain ladder
    assert all(d == p for d, p in got.values())


def test_zoned_timestamp_fixture(spark):
    cases = {
        "2024-03-04T10:00:00.00-05:00": dt.datetime(2024, 3, 4, 15, 0),
        "2024-03-04T10:00:00.00-05:00[America/New_York]": dt.datetime(2024, 3, 4, 15, 0),
        "2024-03-04T10:00:00.00Z[UTC]": dt.datetime(2024, 3, 4, 10, 0),
        "2024-03-04T10:00:00.123-05:00": None, "2024-03-04T10:00:00-05:00": None,
        "bad": None, "": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.t for r in df.select("v", parse_zoned_timestamp("v", ntz=True).alias("t")).collect()}
    assert got == cases


def test_try_cast_fixture(spark):
    cases = [("1,200", "float", None), (" 12 ", "int", 12), ("12.7", "int", None),
             ("$5", "decimal(10,2)", None), ("99999999999", "int", None), ("yes", "boolean", True)]
    df = spark.createDataFrame([(v, t) for v, t, _ in cases], "v string, t string")
    for v, t, want in cases:
        got = df.filter(F.col("v") == v).select(try_cast_by_type("v", t).alias("x")).first().x
        assert got == want, (v, t)
    dec = df.filter(F.col("v") == "$5").select(
        try_cast_by_type(F.lit("12.345"), "decimal(10,2)").alias("x")).first().x
    assert str(dec) == "12.35"


def test_cast_by_type_name_rules(spark):
    df = spark.createDataFrame([("1/2/2024", "2024-03-04T10:00:00.00Z", "7")], "d string, t string, i string")
    r = df.select(cast_by_type_name("d", "DATE").alias("d"),
                  cast_by_type_name("t", "timestamp_ntz").alias("t"),
                  cast_by_type_name("i", "bigint").alias("i")).first()
    assert r.d == dt.date(2024, 1, 2) and r.t == dt.datetime(2024, 3, 4, 10) and r.i == 7


@pytest.mark.parametrize("raw,want", [("Order Key ($)", "ORDER_KEY"), ("Yard ID", "YARD_ID"),
                                      ("Price ($)", "PRICE"),
                                      ("Margin - Percentage", "MARGIN_PERCENTAGE"),
                                      ("__a__b__", "A_B"), ("x", "X")])
def test_normalize_name(raw, want):
    assert normalize_name(raw) == want


def test_normalize_headers_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` int, `A-B` int")
    with pytest.raises(ValueError, match="A B"):
        normalize_headers(df)


def test_guarded_try_cast_equals_plain(spark):
    vals = ["12", " 12 ", "+12", "-12", "12.0", "12.", ".5", "12.7", "1e2", "0x10", "\t12\n",
            "\x0b12", "\x1f12", "\x7f12", "1_000", "1,000", "", " ", "-", "+", "12 3", "0012",
            "9223372036854775807", "2147483648", "-2147483648", "$5", "N/A", None, "1E+2",
            "+.5", "-5.e1", "12.345", " 1.5 ", "NaN", "\u008512", " 12"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    for t in ("int", "bigint", "smallint", "tinyint", "decimal(10,2)", "decimal(38,0)", "boolean"):
        got = df.select(try_cast_by_type("v", t).eqNullSafe(F.col("v").try_cast(t)).alias("ok"))
        assert all(r.ok for r in got.collect()), t


def test_zoned_timestamp_ntz_is_utc_whatever_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-04T10:00:00.00-05:00[America/New_York]",)], "v string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = df.select(parse_zoned_timestamp("v", ntz=True).alias("t")).first().t
            assert got == dt.datetime(2024, 3, 4, 15, 0), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
