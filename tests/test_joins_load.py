"""Joins and loads: MERGE semantics, both upsert strategies, properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import (append, full_reload, left_join_fanout, left_join_unique, upsert,
                              upsert_actions, upsert_counts, write_table)
from tests.conftest import rows

R0, R1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def _fixture(spark):
    target = spark.createDataFrame([(1, "a", "r0", R0), (2, "b", "r0", R0), (None, "n", "r0", R0)],
                                   "k int, v string, ADDED_BY string, ADDED_ON timestamp")
    source = spark.createDataFrame([(2, "B"), (3, None), (None, "N")], "k int, v string")
    return target, source


@pytest.mark.parametrize("method", ["broadcast", "shuffle", "auto"])
def test_upsert_fixture(spark, method):
    target, source = _fixture(spark)
    out = upsert(target, source, "k", "r1", R1, method=method)
    assert out.columns == target.columns
    assert rows(out, "k", "v", "ADDED_BY") == [
        (None, "N", "r1"), (None, "n", "r0"), (1, "a", "r0"), (2, "B", "r0"), (3, None, "r1")]


def test_upsert_modified_audit_and_counts(spark):
    target = spark.createDataFrame(
        [(1, 1, "a", "r0", R0, "r0", R0), (1, 2, "b", "r0", R0, "r0", R0)],
        "k1 int, k2 int, v string, ADDED_BY string, ADDED_ON timestamp, MODIFIED_BY string, "
        "MODIFIED_ON timestamp")
    source = spark.createDataFrame([(1, 2, "B", "x"), (2, 1, "C", "y")],
                                   "k1 int, k2 int, v string, extra string")
    for method in ("broadcast", "shuffle"):
        out = upsert(target, source, "k1, k2", "r1", R1, method=method, with_action=True)
        assert rows(out, "k1", "k2", "v", "ADDED_BY", "MODIFIED_BY", "MODIFIED_ON", "__action") == [
            (1, 1, "a", "r0", "r0", R0, "kept"), (1, 2, "B", "r0", "r1", R1, "updated"),
            (2, 1, "C", "r1", "r1", R1, "inserted")]
        counts = {r.action: r.row_count for r in upsert_counts(out).collect()}
        assert counts == {"kept": 1, "updated": 1, "inserted": 1}
        # rows in = inserted + updated for unique keys
        assert counts["inserted"] + counts["updated"] == source.count()


def test_upsert_twice_equals_once_except_null_keys(spark):
    target, source = _fixture(spark)
    once = upsert(target, source, "k", "r1", R1)
    twice = upsert(once, source, "k", "r1", R1)
    nn = "k IS NOT NULL"
    assert rows(once.filter(nn), "k", "v") == rows(twice.filter(nn), "k", "v")
    assert twice.filter("k IS NULL").count() == once.filter("k IS NULL").count() + 1


def test_upsert_checks_source(spark):
    target, _ = _fixture(spark)
    dup = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="not unique"):
        upsert(target, dup, "k", "r1", R1)
    nulls = spark.createDataFrame([(None, "x")], "k int, v string")
    with pytest.raises(ValueError, match="NULL"):
        upsert(target, nulls, "k", "r1", R1, null_keys="reject")


def test_upsert_actions(spark):
    target, source = _fixture(spark)
    got = rows(upsert_actions(target, source, "k"))
    assert got == [(None, "inserted"), (None, "kept"), (1, "kept"), (2, "updated"),
                   (3, "inserted")]


def test_full_reload_and_append(spark, workdir):
    _, source = _fixture(spark)
    out = full_reload(source, "r1", R1)
    assert rows(out, "k", "ADDED_BY", "MODIFIED_ON") == [(None, "r1", R1), (2, "r1", R1),
                                                          (3, "r1", R1)]
    assert append(source, source).count() == 6
    path = f"{workdir}/t"
    assert write_table(source, path, mode="append") == 3
    assert write_table(source, path, mode="append") == 3
    assert spark.read.parquet(path).count() == 6


def test_left_join_null_key_both_sides(spark):
    left = spark.createDataFrame([(None, 1)], "k string, x int")
    right = spark.createDataFrame([(None, 9)], "k string, y int")
    for fn in (left_join_fanout, left_join_unique):
        assert rows(fn(left, right, ["k"], ["k"], ["y"])) == [(None, 1, None)]


def test_left_join_fanout_equals_plain_left_join_on_hot_key(spark):
    left = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    right = spark.range(0, 5000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 150).alias("rk"),
        F.col("id").alias("y"))
    got = left_join_fanout(left, right, ["k"], ["rk"], ["y"])
    want = left.join(right, left.k == right.rk, "left").select("k", "x", "y")
    assert rows(got) == rows(want)


def test_left_join_unique_never_multiplies(spark):
    left = spark.range(0, 300).select(F.col("id").alias("k"))
    right = spark.range(0, 3000).select((F.col("id") % 100).alias("k2"), F.col("id").alias("v"))
    out = left_join_unique(left, right, ["k"], ["k2"], ["v"])
    assert out.count() == 300
    assert rows(out.filter("k = 5")) == [(5, 5)]
    assert out.filter("k >= 100 AND v IS NOT NULL").count() == 0


def test_config_rows_drive_silver(spark):
    from strata.mapping import mapping_frame
    from strata.plans import active_objects, silver_job
    from strata.schemas import OBJECT_CONFIG
    cfg = spark.createDataFrame([
        ("ORD", "erp", "b.ord", "s.ord", "UPSERT", "ORDER_ID, LINE", 1, 1, "in/ord", "ord", "in/arch"),
        ("OFF", "erp", "b.off", "s.off", "UPSERT", "X", 0, 0, None, None, None)], OBJECT_CONFIG)
    objs = active_objects(cfg)
    assert [o.object_name for o in objs] == ["ORD"] and objs[0].keys == ("ORDER_ID", "LINE")
    bronze = spark.createDataFrame([("1", "1", "a", "r0", R0), ("1", "1", "b", "r0", R1)],
                                   "OID string, LN string, V string, ADDED_BY string, ADDED_ON timestamp")
    mapping = mapping_frame(spark, [("erp", "ORD", "OID", "ORDER_ID", "int", None),
                                    ("erp", "ORD", "LN", "LINE", "int", None),
                                    ("erp", "ORD", "V", "VAL", "string", None)])
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType
    schema = StructType([StructField("ORDER_ID", IntegerType()), StructField("LINE", IntegerType()),
                         StructField("VAL", StringType()), StructField("ADDED_BY", StringType()),
                         StructField("ADDED_ON", TimestampType()),
                         StructField("MODIFIED_BY", StringType()),
                         StructField("MODIFIED_ON", TimestampType())])
    out = silver_job(objs[0], bronze, mapping, "r1", R1, target_schema=schema)
    assert rows(out, "ORDER_ID", "LINE", "VAL", "ADDED_BY") == [(1, 1, "b", "r1")]
    bad = spark.createDataFrame([("X", "s", None, None, "DELETE", "K", 0, 1, None, None, None)],
                                OBJECT_CONFIG)
    with pytest.raises(ValueError, match="unsupported"):
        active_objects(bad)


def test_broadcast_budget_measures_string_bytes(spark):
    from strata.operators._util import fits_budget
    narrow = spark.range(0, 1000).select(F.col("id").cast("string").alias("s"))
    wide = spark.range(0, 1000).select(F.repeat(F.lit("x"), 5000).alias("s"))
    assert fits_budget(narrow, 1 << 20)
    assert not fits_budget(wide, 1 << 20)          # 5 MB of text: over a 1 MB budget


def test_empty_inputs(spark):
    from strata.operators import surrogate_key
    target, source = _fixture(spark)
    empty_src = source.limit(0)
    for method in ("broadcast", "shuffle"):
        assert rows(upsert(target, empty_src, "k", "r1", R1, method=method), "k", "v") == \
            rows(target, "k", "v")
        out = upsert(target.limit(0), source, "k", "r1", R1, method=method)
        assert rows(out, "k", "v", "ADDED_BY") == [(None, "N", "r1"), (2, "B", "r1"),
                                                   (3, None, "r1")]
    assert surrogate_key(source.limit(0), ["k"], "key").count() == 0


def test_left_join_unique_single_column_matches_struct_pick(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    right = spark.createDataFrame([(1, 5), (1, 3), (2, None), (2, 7), (3, 9)], "k2 int, v int")
    got = rows(left_join_unique(left, right, ["k"], ["k2"], ["v"]))
    # NULL orders first, as for a multi-column struct pick
    assert got == [(1, 3), (2, None), (3, 9), (4, None)]
    got_max = rows(left_join_unique(left, right, ["k"], ["k2"], ["v"], pick="max"))
    assert got_max == [(1, 5), (2, 7), (3, 9), (4, None)]
