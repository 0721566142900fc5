"""Bucketed merges and lookups, fact maintenance by delta, mergeable type inference."""

import re
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.functions.infer import (cast_to_evidence, inferred_schema, merge_evidence, narrowest,
                                    type_evidence)
from strata.operators import (left_join_bucketed, left_join_unique, merge_bucketed, upsert,
                              write_bucketed, write_table)
from strata.operators.bucketed import buckets_of
from strata.plans import dim_appointment, fact_sales, fact_sales_delta
from tests.conftest import rows

TS = datetime(2024, 1, 1)
AUDIT = "ADDED_BY string, ADDED_ON timestamp, MODIFIED_BY string, MODIFIED_ON timestamp"


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _name():
    return "t_" + uuid.uuid4().hex


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanged(plan):
    """For each exchange of a plan whether a bucketed scan is below it (deeper, before a sibling)."""
    lines = plan.split("\n")
    depth = [len(re.match(r"[ :+|*()0-9-]*", x).group()) for x in lines]
    out = []
    for i, x in enumerate(lines):
        if re.search(r"\bExchange hashpartitioning", x):
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            out.append(any("Bucketed: true" in b or "SelectedBucketsCount" in b for b in below))
    return out


def test_merge_into_buckets_shuffles_the_batch_alone(spark, workdir, no_broadcast):
    target = spark.range(1000).selectExpr(
        "nullif(cast(id as int), 7) k", "concat('v', id) v", "'note' note", "'r0' ADDED_BY",
        f"timestamp '{TS}' ADDED_ON", "'r0' MODIFIED_BY", f"timestamp '{TS}' MODIFIED_ON")
    batch = spark.createDataFrame([(1, "one"), (5000, "new"), (None, "null")], "k int, v string")
    name = _name()
    stored = write_bucketed(target, name, f"{workdir}/t", "k", 4)
    assert buckets_of(spark, name) == (4, ["k"])
    out = merge_bucketed(spark, name, batch, "k", "r1", TS)
    plan = _plan(out)
    assert "Bucketed: true" in plan
    assert _exchanged(plan) and not any(_exchanged(plan)), plan
    assert rows(out) == rows(upsert(stored, batch, "k", "r1", TS, method="shuffle"))
    after = merge_bucketed(spark, name, batch, "k", "r1", TS, into=(name + "_2", f"{workdir}/t2"))
    assert buckets_of(spark, name + "_2") == (4, ["k"]) and rows(after) == rows(out)
    again = merge_bucketed(spark, name + "_2", batch.where("k = 1"), "k", "r2", TS)
    assert not any(_exchanged(_plan(again)))
    assert again.where("k = 1").first().MODIFIED_BY == "r2"
    with pytest.raises(ValueError, match="bucketed by"):
        merge_bucketed(spark, name, batch, "v", "r1")
    with pytest.raises(ValueError, match="cannot replace"):
        merge_bucketed(spark, name, batch, "k", "r1", into=(name, f"{workdir}/t3"))


def test_lookup_in_buckets(spark, workdir, no_broadcast):
    right = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "c", 0),
                                   (None, "n", 1)] + [(i, "z", i) for i in range(10, 60)],
                                  "id int, name string, n int")
    left = spark.createDataFrame([(1, 0), (1, 1), (2, 2), (3, 3), (None, 4)], "key int, x int")
    name = _name()
    write_bucketed(right, name, f"{workdir}/t", "id", 3)
    out = left_join_bucketed(left, name, "key", "id", ["name", "n"])
    assert not any(_exchanged(_plan(out)))
    assert rows(out) == rows(left_join_unique(left, right, ["key"], ["id"], ["name", "n"]))
    with pytest.raises(ValueError, match="already exist"):
        left_join_bucketed(left.withColumnRenamed("x", "NAME"), name, "key", "id", ["name"])


SALES = ("YARD_ID string, YARD_KEY int, COMMODITY_NAME string, PRICE double, SELL_PRICE double, "
         "INVOICE_TOTAL double, YARD string")


def test_fact_follows_its_dimension_by_delta(spark, workdir):
    visits = spark.createDataFrame([(f"y{i % 6}", f"o{i}", "c") for i in range(30)],
                                   "YARD_NAME string, SALES_ORDER_TICKET_ID string, "
                                   "CARRIER_NAME string")
    # equal sales of several yards, exact copies, sales without a yard or without a visit
    sales = spark.createDataFrame(
        [("s", 1, "scrap", 1.5, None, 2.0, f"y{i % 8}") for i in range(40)]
        + [("s", 2, "scrap", 1.0, 1.0, 1.0, None)] * 3
        + [(f"s{i}", 1, "iron", float(i), 1.0, 1.0, f"y{i % 6}") for i in range(20)], SALES)
    old = dim_appointment(visits, "r0", TS)
    write_table(fact_sales(sales, old, "r0", TS), f"{workdir}/fact")
    fact = spark.read.parquet(f"{workdir}/fact")
    new = (old.where("YARD_NAME <> 'y5' AND NOT (YARD_NAME IN ('y1', 'y2') "
                     "AND SALES_ORDER_ID IN ('o1', 'o2'))")
           .unionByName(old.limit(1).selectExpr(
               "999 APPOINTMENT_DATA_KEY", "'y7' YARD_NAME", "'x' SALES_ORDER_ID",
               *[c for c in old.columns[3:]])))
    out = fact_sales_delta(sales, fact, old, new, "r1", TS)
    values = [c for c in fact.columns if c not in (
        "SALES_KEY", "ADDED_BY", "ADDED_ON", "MODIFIED_BY", "MODIFIED_ON")]
    assert rows(out, *values) == rows(fact_sales(sales, new, "r1", TS), *values)
    assert rows(out, "SALES_KEY") == rows(fact, "SALES_KEY")
    before = {r.SALES_KEY: r for r in fact.collect()}
    for r in out.collect():
        moved = r.APPOINTMENT_DATA_KEY != before[r.SALES_KEY].APPOINTMENT_DATA_KEY
        assert r.MODIFIED_BY == ("r1" if moved else "r0") and r.ADDED_BY == "r0"
        assert r.COMMODITY_NAME == before[r.SALES_KEY].COMMODITY_NAME
    # a fifth of the yards changed here, and nothing else is updated
    assert 0 < out.where("MODIFIED_BY = 'r1'").count() < fact.count()
    same = fact_sales_delta(sales, fact, old, old, "r2", TS)
    assert rows(same) == rows(fact)


def _types(spark, *deliveries):
    parts = [type_evidence(spark.createDataFrame([(v,) for v in d], "v string"))
             for d in deliveries]
    return merge_evidence(*parts).select(narrowest()).first()[0]


@pytest.mark.parametrize("values,want", [
    (["1", "-2", "+3", None], "int"), (["2147483647"], "int"), (["2147483648"], "bigint"),
    (["9223372036854775808"], "decimal(19,0)"), (["1", "1.5"], "decimal(2,1)"),
    (["007", ".5", "-12."], "decimal(3,1)"), (["0.0"], "decimal(1,1)"), (["0"], "int"),
    (["1" * 30 + "." + "2" * 9], "double"), (["1e5", "2"], "double"), (["1E-3"], "double"),
    (["2024-02-29"], "date"), (["2024-02-30"], "string"),
    (["2024-02-29", "2024-01-01 10:00:00"], "timestamp_ntz"),
    (["2024-01-01T10:00:00.123456"], "timestamp_ntz"), (["2024-01-01 25:00:00"], "string"),
    (["true", "FALSE"], "boolean"), (["true", "1"], "string"), ([None], "string"), ([], "string"),
    (["1,200"], "string"), ([" 1"], "string"), (["NaN"], "string"), (["", "1"], "string"),
    (["2024-01-01", "5"], "string")])
def test_narrowest_type(spark, values, want):
    assert _types(spark, values) == want
    # in any split over deliveries
    assert _types(spark, values[:1], values[1:], []) == want


def test_later_delivery_widens_and_columns_cast(spark):
    first = spark.createDataFrame([("1", "2024-01-01", None)], "A string, b string, c string")
    later = spark.createDataFrame([("2.50", "2024-01-02 00:00:01", "x")], "a string, B string, C string")
    one = type_evidence(first)
    assert {f.name: f.dataType.simpleString() for f in inferred_schema(one).fields} == {
        "A": "int", "b": "date", "c": "string"}
    both = merge_evidence(one, type_evidence(later))
    kinds = {f.name: f.dataType for f in inferred_schema(both).fields}
    assert kinds["A"] == DecimalType(3, 2) and kinds["B"].simpleString() == "timestamp_ntz"
    out = cast_to_evidence(first.unionByName(later), both)
    assert [str(r.A) for r in out.collect()] == ["1.00", "2.50"]
    plan = _plan(type_evidence(first))
    assert "Python" not in plan and "SinglePartition" not in plan
    with pytest.raises(ValueError, match="no text"):
        type_evidence(spark.range(3))
    assert type_evidence(first.withColumn("n", F.lit(1)), ["B"]).count() == 1
