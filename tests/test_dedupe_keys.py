"""Dedupe and surrogate keys, including NULL groups and a hot key."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import (dedupe_any, dedupe_latest, stable_keys, surrogate_key)
from tests.reference import surrogate_key_window
from tests.conftest import rows


def test_dedupe_any_null_is_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, x int")
    assert dedupe_any(df, ["k"]).count() == 2


def test_dedupe_latest_picks_newest(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    df = spark.createDataFrame(
        [("a", 1, t1), ("a", 2, t2), ("a", 3, None), ("b", 4, None), (None, 5, t1), (None, 6, t2)],
        "k string, x int, ADDED_ON timestamp")
    out = dedupe_latest(df, "k")
    assert out.columns == df.columns
    assert rows(out) == [(None, 6, t2), ("a", 2, t2), ("b", 4, None)]


def test_dedupe_latest_equals_window_on_hot_key(spark):
    # one key holds most rows, spread over many input partitions
    df = spark.range(0, 20000, numPartitions=16).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") % 13).alias("t"), F.col("id").alias("v"))
    got = dedupe_latest(df, ["k"], order_by=["t"])
    w = Window.partitionBy("k").orderBy(F.col("t").desc(), F.col("v").desc())
    want = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert rows(got) == rows(want)


def _numbering_equal(spark, df, order):
    a = surrogate_key(df, order, "key", num_partitions=7)
    b = surrogate_key_window(df, order, "key")
    return rows(a) == rows(b), a


def test_surrogate_key_equals_row_number_with_null_group(spark):
    df = spark.range(0, 1500, numPartitions=5).select(
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("yard"), (F.col("id") % 25).cast("string"))).alias("YARD_NAME"),
        F.col("id").cast("string").alias("ORDER_ID"))
    ok, keyed = _numbering_equal(spark, df, ["YARD_NAME"])
    assert ok
    ks = [r.key for r in keyed.select("key").collect()]
    assert sorted(ks) == list(range(1, 1501))


def test_surrogate_key_hot_leading_value_is_spread(spark):
    df = spark.range(0, 6000, numPartitions=6).select(
        F.when(F.col("id") % 3 != 0, F.lit("HOT")).otherwise(
            (F.col("id") % 50).cast("string")).alias("lead"), F.col("id").alias("rest"))
    ok, keyed = _numbering_equal(spark, df, ["lead"])
    assert ok
    # the range partitioning splits the hot leading value over several tasks
    parts = df.repartitionByRange(7, F.col("lead").asc_nulls_first(), F.col("rest").asc_nulls_first()) \
        .filter(F.col("lead") == "HOT").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_surrogate_key_plan_has_no_single_partition(spark):
    df = spark.range(0, 100).select(F.col("id").alias("a"))
    lines = surrogate_key(df, ["a"], "key")._jdf.queryExecution().executedPlan() \
        .toString().splitlines()
    singles = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    # the only unpartitioned step works on the per-partition counts
    assert all("__sk_part" in lines[i + 1] for i in singles)


def test_stable_keys_keep_existing_and_extend(spark):
    cust = spark.range(0, 500, numPartitions=4).select(
        F.col("id").alias("ck"), F.concat(F.lit("n"), (999 - F.col("id")).cast("string")).alias("name"),
        F.when(F.col("id") % 5 == 0, "NEW").otherwise("OLD").alias("seg"))
    prev = surrogate_key(cust.filter("seg = 'OLD'"), ["name"], "K")
    out = stable_keys(cust, prev, ["ck"], "K", ["name"])
    got = {r.ck: r.K for r in out.collect()}
    old = {r.ck: r.K for r in prev.collect()}
    assert all(got[k] == v for k, v in old.items())                  # no key changed
    assert sorted(got.values()) == list(range(1, 501))               # dense, no gap
    assert min(got[k] for k in got if k % 5 == 0) == max(old.values()) + 1


def test_dim_appointment_stable_keys_across_runs(spark):
    from strata.plans import dim_appointment
    appts = spark.range(0, 300, numPartitions=3).select(
        F.concat(F.lit("Y"), (F.col("id") % 7).cast("string")).alias("YARD_NAME"),
        F.col("id").cast("string").alias("SALES_ORDER_TICKET_ID"),
        F.lit("carrier").alias("CARRIER_NAME"))
    first = dim_appointment(appts.filter("id < 200"), "r1", dt.datetime(2024, 1, 1))
    second = dim_appointment(appts, "r2", dt.datetime(2024, 2, 1), existing=first)
    k1 = {r.SALES_ORDER_ID: r.APPOINTMENT_DATA_KEY for r in first.collect()}
    k2 = {r.SALES_ORDER_ID: r.APPOINTMENT_DATA_KEY for r in second.collect()}
    assert all(k2[s] == k for s, k in k1.items())
    assert sorted(k2.values()) == list(range(1, 301))


def test_surrogate_key_spreads_a_large_group_of_copies(spark, monkeypatch):
    from strata.operators import keys as K
    monkeypatch.setattr(K, "COPY_CHUNK", 50)
    copies = spark.range(0, 1000, numPartitions=4).select(F.lit("same").alias("a"), F.lit(1).alias("b"))
    others = spark.range(0, 300, numPartitions=2).select(
        (F.col("id") % 7).cast("string").alias("a"), (F.col("id") % 3).cast("int").alias("b"))
    df = copies.unionByName(others)
    got = K.surrogate_key(df, ["a"], "key", num_partitions=8)
    want = surrogate_key_window(df, ["a"], "key")
    assert rows(got) == rows(want)
    assert got.columns == ["a", "b", "key"]
    # the copies are spread over several range partitions, not one
    spread = K.spread_copies(df)
    assert spread.filter("a = 'same'").count() == 1000
    order = K.total_order(spread, ["a"])
    parts = spread.repartitionByRange(8, *order).filter("a = 'same'") \
        .select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_stable_keys_match_null_natural_keys(spark):
    prev = spark.createDataFrame([(None, 1), ("a", 2)], "n string, K int")
    rows_now = spark.createDataFrame([(None,), ("a",), ("b",)], "n string")
    got = rows(stable_keys(rows_now, prev, ["n"], "K", ["n"]))
    assert got == [(None, 1), ("a", 2), ("b", 3)]
