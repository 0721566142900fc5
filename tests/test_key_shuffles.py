"""Keys are found and numbered with one shuffle of the rows, and mean what they meant."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import keys as K
from strata.operators import stable_keys, surrogate_key, write_table
from strata.plans import dim_appointment, fact_sales, fact_sales_delta
from tests.conftest import rows
from tests.test_incremental import _shuffled

TS = datetime(2024, 1, 1)
N = 20_000


def _read(spark, df, path):
    write_table(df, path)
    return spark.read.parquet(path)


@pytest.fixture()
def large_batches(monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_BUDGET_BYTES", 0)


def test_surrogate_key_shuffles_rows_once(spark, workdir):
    df = _read(spark, spark.range(N).select((F.col("id") % 97).alias("a"), "id"), workdir + "/t")
    moved = _shuffled(spark, lambda: surrogate_key(df, ["a"], "key").count())
    assert moved < 1.2 * N


def test_large_groups_of_copies_are_found_and_spread(spark, monkeypatch):
    monkeypatch.setattr(K, "SAMPLED", 0.5)
    monkeypatch.setattr(K, "COPY_CHUNK", 100)
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 0.0).otherwise(F.col("id") % 50)
                                  .cast("double").alias("x"),
                                  F.when(F.col("id") < 1500, None).otherwise("o").alias("s"))
    groups = K.large_copy_groups(df)
    assert rows(groups) == [(0.0, None)]
    indexed = K._with_copy_index(df)
    assert indexed.select("x", "s").exceptAll(df).isEmpty() and indexed.count() == 2000
    assert indexed.where("s IS NULL").agg(F.countDistinct(K.COPY_COLUMN)).first()[0] == 1500
    got = surrogate_key(df, ["x"], "k")
    assert sorted(r.k for r in got.collect()) == list(range(1, 2001))
    assert got.where("s IS NULL").agg(F.max("k")).first()[0] == 1500


def test_stable_keys_shuffle_each_side_once(spark, workdir, large_batches):
    dim = _read(spark, spark.range(N).selectExpr("id k", "concat('n', id) n", "cast(id as int) key"),
                workdir + "/d")
    batch = spark.range(100, N + 100).selectExpr("id k", "concat('n', id) n", "id % 3 v")
    got = []
    moved = _shuffled(spark, lambda: got.append(stable_keys(
        batch, dim, ["k", "n"], "key", ["k"], keep_vanished=False)))
    assert moved < 2.2 * N
    assert got[0].where("k < 20000").where("k <> key").isEmpty()
    assert sorted(r.key for r in got[0].where("k >= 20000").collect()) == list(range(N, N + 100))


@pytest.mark.parametrize("large", [True, False])
def test_copies_nulls_and_zeros_of_natural_keys(spark, workdir, monkeypatch, large):
    if large:
        monkeypatch.setattr(K, "BROADCAST_BUDGET_BYTES", 0)
    nan = float("nan")
    dim = spark.createDataFrame([("a", 1.0, 7), ("a", 1.0, 3), ("b", 0.0, 9), (None, None, 5),
                                 ("c", nan, 2), ("d", 2.0, None), ("z", 1.0, 11)],
                                "n string, x double, key int")
    batch = spark.createDataFrame([("a", 1.0, 2), ("a", 1.0, 1), ("a", 1.0, 3), ("b", -0.0, 1),
                                   (None, None, 1), ("c", nan, 1), ("d", 2.0, 1), ("e", -0.0, 1)],
                                  "n string, x double, v int")
    got = stable_keys(batch, dim, ["n", "x"], "key", ["n", "v"], keep_vanished=False)
    assert {(r.n, str(r.x), r.v): r.key for r in got.collect()} == {
        ("a", "1.0", 1): 3, ("a", "1.0", 2): 7, ("a", "1.0", 3): 12, ("b", "-0.0", 1): 9,
        (None, "None", 1): 5, ("c", "nan", 1): 2, ("d", "2.0", 1): 13, ("e", "-0.0", 1): 14}


def test_natural_keys_of_other_types(spark):
    dim = spark.createDataFrame([(1, 5), (2, 6)], "k int, key int")
    batch = spark.createDataFrame([(1,), (3,)], "k bigint")
    assert rows(stable_keys(batch, dim, "k", "key", ["k"], keep_vanished=False)) == [(1, 5), (3, 7)]


def test_delta_reads_only_facts_with_an_old_value(spark, workdir, large_batches):
    appointments = spark.range(100).selectExpr("concat('y', id % 20) YARD_NAME", "cast(id as string) "
                                               "SALES_ORDER_TICKET_ID", "'c' CARRIER_NAME")
    sales = _read(spark, spark.range(N).selectExpr(
        "cast(id as string) YARD_ID", "id % 9 YARD_KEY", "concat('y', id % 20) YARD",
        "'m' COMMODITY_NAME", "cast(id as double) PRICE", "1D SELL_PRICE", "2D INVOICE_TOTAL"),
        workdir + "/sales")
    old = _read(spark, dim_appointment(appointments, "r0", TS), workdir + "/dim")
    fact = _read(spark, fact_sales(sales, old, "r0", TS), workdir + "/fact")
    first = old.where("YARD_NAME = 'y3'").agg(F.min("APPOINTMENT_DATA_KEY")).first()[0]
    new = old.where(F.col("APPOINTMENT_DATA_KEY") != first)
    got = []
    moved = _shuffled(spark, lambda: got.append(fact_sales_delta(sales, fact, old, new, "r1", TS)))
    assert moved < 0.5 * N
    want = fact_sales(sales, new, "r1", TS)
    columns = [c for c in fact.columns if c.split("_")[0] not in ("SALES", "ADDED", "MODIFIED")]
    assert got[0].select(columns).exceptAll(want.select(columns)).isEmpty()
    assert got[0].where("MODIFIED_BY = 'r1'").count() == N // 20
