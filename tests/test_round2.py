"""Late and reordered landing files, stable keys, silver columns, key limits, sizes."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata.mapping import ColumnMapping, mapping_frame
from strata.operators import left_join_unique, stable_keys, surrogate_key, upsert_partitioned
from strata.operators.joins import broadcast_if_small
from strata.operators.keys import count_copies
from strata.plans import dim_appointment, fact_sales, silver_load
from strata.plans.config import ObjectConfig, silver_job
from strata.functions import cast_by_type_name
from strata.streaming import incremental_ingest, read_ingested

BRONZE = StructType([StructField("A", StringType()), StructField("B", StringType()),
                     StructField("ADDED_BY", StringType()),
                     StructField("ADDED_ON", TimestampType())])


def _put(folder, name, text, days_old=0):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    if days_old:
        t = time.time() - days_old * 86400
        os.utime(path, (t, t))


def _ingest(spark, base):
    return incremental_ingest(spark, f"{base}/in", f"{base}/t", f"{base}/c", f"{base}/old",
                              BRONZE, "run")


def test_ingest_late_reordered_and_missing(spark, workdir):
    assert _ingest(spark, workdir) == {"batches": 0, "rows": 0}            # no folder
    os.makedirs(f"{workdir}/in")
    assert _ingest(spark, workdir)["rows"] == 0                            # empty folder
    _put(f"{workdir}/in", "1.csv", "a,b\n1,x\n")
    _put(f"{workdir}/in", "2.csv", "b,a\ny,2\n")                           # two orders at once
    _put(f"{workdir}/in", "0.csv", "")                                     # nothing in it
    assert _ingest(spark, workdir)["rows"] == 2
    _put(f"{workdir}/in", "3 c.csv", "a,b\n3,z\n", days_old=10)            # copied with an old time
    _put(f"{workdir}/in", "4.csv", " B ,A,C\nv,4,more\n")                  # reordered, later
    assert _ingest(spark, workdir)["rows"] == 2
    assert _ingest(spark, workdir)["rows"] == 0
    got = sorted((r.A, r.B) for r in read_ingested(spark, f"{workdir}/t").collect())
    assert got == [("1", "x"), ("2", "y"), ("3", "z"), ("4", "v")]


def test_dimension_keys_stay_one_to_one(spark):
    rows = spark.createDataFrame([("Y", 1, "c"), ("Y", 1, "c"), ("Z", 2, "d"), (None, 3, None),
                                  (None, 3, None)],
                                 "YARD_NAME string, SALES_ORDER_TICKET_ID int, CARRIER_NAME string")
    dim = dim_appointment(rows, "r1")
    first = {(r.YARD_NAME, r.APPOINTMENT_DATA_KEY) for r in dim.collect()}
    for _ in range(2):
        dim = dim_appointment(rows, "r2", existing=dim)
        assert {(r.YARD_NAME, r.APPOINTMENT_DATA_KEY) for r in dim.collect()} == first
    less = dim_appointment(rows.where("YARD_NAME = 'Y'"), "r3", existing=dim)
    assert less.count() == 5                                                # vanished rows stay
    new = rows.where("YARD_NAME = 'Y'").union(
        spark.createDataFrame([("B", 9, "n")], rows.schema))
    after = {r.YARD_NAME: r.APPOINTMENT_DATA_KEY
             for r in dim_appointment(new, "r4", existing=less).collect()}
    assert after["B"] == 6                                                  # no key is given twice


def test_stable_keys_without_vanished_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("c", 3)], "k string, v int")
    dim = spark.createDataFrame([("a", 5), ("b", 7)], "k string, key int")
    got = {r.k: r.key for r in stable_keys(rows, dim, "k", "key", ["k"],
                                           keep_vanished=False).collect()}
    assert got == {"a": 5, "c": 8}
    kept = {r.k: (r.v, r.key) for r in stable_keys(rows, dim, "k", "key", ["k"]).collect()}
    assert kept == {"a": (1, 5), "b": (None, 7), "c": (3, 8)}


def test_keys_change_no_values_and_do_not_wrap(spark):
    rows = spark.createDataFrame([(-0.0,), (0.0,), (-0.0,), (None,), (1.5,)], "x double")
    got = sorted(str(r.x) for r in surrogate_key(rows, ["x"], "k").collect())
    assert got == ["-0.0", "-0.0", "0.0", "1.5", "None"]
    assert sorted(r["__sk_n"] for r in count_copies(rows).collect()) == [1, 1, 1, 2]
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(OverflowError):
            surrogate_key(rows, ["x"], "k", start=2**31 - 3)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    big = surrogate_key(rows, ["x"], "k", start=2**31, key_type="bigint")
    assert big.agg(F.max("k")).first()[0] == 2**31 + 4
    nested = spark.createDataFrame([([1],), ([1],)], "a array<int>")
    with pytest.raises(ValueError):
        surrogate_key(nested, [], "k")


def test_hot_leading_value_is_spread_whatever_the_tie_break(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("lead"), "id")
    keyed = surrogate_key(rows, ["lead"], "k", tie_break=[], num_partitions=8)
    tagged = spark.read.parquet(*keyed.inputFiles())
    sizes = [r["count"] for r in tagged.groupBy("__sk_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 8_000
    unique = surrogate_key(rows, ["lead"], "k", unique_by=["id"])
    assert unique.where("k <> id + 1").count() == 0


def test_marts_with_long_keys(spark):
    rows = spark.createDataFrame([("Y", 1, "c")], "YARD_NAME string, SALES_ORDER_TICKET_ID int, "
                                                  "CARRIER_NAME string")
    dim = dim_appointment(rows, "r", key_type="bigint")
    assert dim.schema["APPOINTMENT_DATA_KEY"].dataType == LongType()
    sales = spark.createDataFrame([("1", "2", "i", 1.0, 1.0, 1.0, "Y")], (
        "YARD_ID string, YARD_KEY int, COMMODITY_NAME string, PRICE double, SELL_PRICE double, "
        "INVOICE_TOTAL double, YARD string").replace("YARD_KEY int", "YARD_KEY string"))
    out = fact_sales(sales, dim, "r", on_error="null", key_type="bigint")
    assert out.schema["SALES_KEY"].dataType == LongType() and out.count() == 1


MAP = [("S", "O", "id", "ID", "int", None), ("S", "O", "name", "NAME", "string", None),
       ("S", "O", "fresh", "FRESH", "string", None), ("T", "O", "id", "OTHER", "int", None)]


def test_silver_writes_mapped_columns_only(spark):
    mapping = ColumnMapping.from_frame(mapping_frame(spark, MAP), "O", "S")
    assert mapping.renames["id"] == "ID"
    audit = "ADDED_BY string, ADDED_ON timestamp, MODIFIED_BY string, MODIFIED_ON timestamp"
    target = spark.createDataFrame([(1, "old", "keep", "r0", None, "r0", None)],
                                   f"ID int, NAME string, U string, {audit}")
    bronze = spark.createDataFrame([("1", "new", "bad", "f1"), ("2", "two", "bad", "f2")],
                                   "id string, name string, U string, fresh string") \
        .withColumn("ADDED_ON", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    wide = StructType([*target.schema.fields[:3], StructField("FRESH", StringType()),
                       *target.schema.fields[3:]])
    out = silver_load(bronze, mapping, "ID", "r1", target=target, target_schema=wide)
    got = {r.ID: (r.NAME, r.U, r.FRESH) for r in out.collect()}
    assert got == {1: ("new", "keep", "f1"), 2: ("two", None, "f2")}
    with pytest.raises(ValueError):
        ColumnMapping.from_frame(mapping_frame(spark, MAP), "O")
    cfg = ObjectConfig(object_name="O", source_name="S", keys=("ID",), operation="upsert",
                       bronze_table=None, silver_table=None, full_load=False)
    assert silver_job(cfg, bronze, mapping_frame(spark, MAP), "r", target=target,
                      target_schema=wide).count() == 2


def test_newest_row_by_a_typed_time(spark):
    rows = [("T", "O", "id", "ID", "int", None), ("T", "O", "name", "NAME", "string", None),
            ("T", "O", "ADDED_ON", "ADDED_ON", "timestamp", None)]
    mapping = ColumnMapping.from_frame(mapping_frame(spark, rows), "O")
    bronze = spark.createDataFrame([("1", "zz-old", "2024-01-01"), ("1", "aa-new", "2024-02-01")],
                                   "id string, name string, ADDED_ON string") \
        .withColumn("ADDED_ON", F.col("ADDED_ON").cast("timestamp"))
    assert [r.NAME for r in silver_load(bronze, mapping, "ID", "r").collect()] == ["aa-new"]
    typed = spark.sql("SELECT date '2024-05-06' AS d").select(
        cast_by_type_name("d", "date", text_input=False).alias("x"))
    assert str(typed.first().x) == "2024-05-06"


def test_lookup_side_is_computed_once_and_nested_sides_are_not_broadcast(spark):
    nested = spark.range(10).select("id", F.array_repeat("id", 1000).alias("a"))
    assert "BroadcastHint" not in str(broadcast_if_small(nested)._jdf.queryExecution().logical()) \
        and "ResolvedHint" not in str(broadcast_if_small(nested)._jdf.queryExecution().logical())
    left = spark.range(100).select(F.col("id").alias("k"))
    right = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    out = left_join_unique(left, right, ["k"], ["k"], ["v"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "GlobalLimit" not in plan
    assert out.where("v IS NOT NULL").count() == 50


def _files(table):
    return {os.path.relpath(os.path.join(d, f), table) for d, _, names in os.walk(table)
            for f in names if f.endswith(".parquet")}


def test_partitioned_upsert_rewrites_only_what_changed(spark, workdir):
    table = f"{workdir}/t"
    rows = [(1, "a b", "x"), (2, "a b", "y"), (3, "c/d", "z"), (4, "e", "w"), (5, None, "n"),
            (None, "e", "null key")]
    schema = "id int, part string, v string"
    spark.createDataFrame(rows, schema).coalesce(1).write.partitionBy("part").parquet(table)
    before = _files(table)
    # 3 leaves its partition empty, 5 leaves the NULL one, 2 stays, 6 and a NULL key are new
    batch = spark.createDataFrame([(3, "a b", "z2"), (5, "g", "n2"), (2, "a b", "y2"),
                                   (6, None, "new"), (None, "g", "null too")], schema)
    order = StructType([StructField("id", IntegerType()), StructField("v", StringType()),
                        StructField("part", StringType())])
    # the old homes "a b", "c/d" and NULL, and the new one "g"
    assert upsert_partitioned(spark, table, batch, "ID", "part", "r", schema=order) == 4
    got = sorted((str(r.id), str(r.part), r.v) for r in spark.read.schema(order).parquet(table).collect())
    assert got == sorted([("1", "a b", "x"), ("2", "a b", "y2"), ("3", "a b", "z2"), ("4", "e", "w"),
                          ("None", "e", "null key"), ("5", "g", "n2"), ("6", "None", "new"),
                          ("None", "g", "null too")])
    after = _files(table)
    assert {f for f in before if f.startswith("part=e/")} == {f for f in after if f.startswith("part=e/")}
    assert not [f for f in after if f.startswith("part=c")]
    assert upsert_partitioned(spark, table, batch.limit(0), "id", "part", "r", schema=order) == 0
    assert _files(table) == after
    with pytest.raises(ValueError):
        upsert_partitioned(spark, table, batch.union(batch), "id", "part", "r", schema=order)
    assert _files(table) == after


def test_incremental_fact_keeps_keys(spark):
    dim = spark.createDataFrame([(7, "Y")], "APPOINTMENT_DATA_KEY int, YARD_NAME string")
    schema = ("YARD_ID string, YARD_KEY int, COMMODITY_NAME string, PRICE double, "
              "SELL_PRICE double, INVOICE_TOTAL double, YARD string")
    old = [("b", 1, "i", 0.1, 1.0, 1.0, "Y"), ("b", 1, "i", 0.1, 1.0, 1.0, "Y"),
           ("c", None, None, None, 1.0, 1.0, None)]
    first = fact_sales(spark.createDataFrame(old, schema), dim, "r1")
    new = [old[0], old[2], ("a", 1, "i", 0.1, 1.0, 1.0, "Y")]
    out = fact_sales(spark.createDataFrame(new, schema), dim, "r2", existing=first)
    got = {r.SALES_KEY: (r.YARD_ID, r.ADDED_BY, r.MODIFIED_BY) for r in out.collect()}
    assert got == {1: ("b", "r1", "r2"), 2: ("b", "r1", "r1"), 3: ("c", "r1", "r2"),
                   4: ("a", "r2", "r2")}
