"""The upsert by versions compares keys and versions before it moves rows."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import dedupe_ends, dedupe_latest, upsert, upsert_partitioned
from tests.conftest import rows

TS = datetime(2024, 1, 1)
AUDIT = "ADDED_BY string, ADDED_ON timestamp, MODIFIED_BY string, MODIFIED_ON timestamp"
SCHEMA = f"k int, j string, v int, a int, b int, note string, {AUDIT}"
OLD = ("r0", datetime(2023, 1, 1)) * 2


def _stored(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _table(spark, workdir):
    kept = [(1, "x", 5, 1, 1, "n"), (2, "x", 5, 1, 1, "n"), (3, "x", None, 1, 1, "n"),
            (4, "x", 5, 1, None, "n"), (5, "x", 5, 1, 1, "n"), (5, "x", 7, 1, 1, "n"),
            (6, "x", 5, 1, 1, "n"), (6, "x", 5, 1, 1, "n"), (7, "x", None, 1, 1, "n"),
            (None, "x", 1, 1, 1, "n"), (8, None, 1, 1, 1, "n")]
    return _stored(spark.createDataFrame([r + OLD for r in kept], SCHEMA), workdir + "/t")


def _batch(spark, workdir):
    new = [(1, "x", 4, 9, 9), (2, "x", 6, 9, 9), (3, "x", None, 1, 1), (4, "x", 5, None, 1),
           (5, "x", 6, 9, 9), (6, "x", 5, 1, 2), (7, "x", 1, 0, 0), (None, "x", 9, 9, 9),
           (8, None, 9, 9, 9), (9, "x", None, 9, 9)]
    return _stored(spark.createDataFrame(new, "k int, j string, v int, a int, b int"),
                   workdir + "/s")


@pytest.mark.parametrize("budget", [0, 64 * 1024 * 1024])
def test_same_rows_as_by_broadcast(spark, workdir, budget):
    table, batch = _table(spark, workdir), _batch(spark, workdir)
    args = dict(keys="k, j", run_id="r1", run_ts=TS, newest_by="v", with_action=True)
    got = upsert(table, batch, method="shuffle", broadcast_budget=budget, **args)
    assert rows(got) == rows(upsert(table, batch, method="broadcast", **args))


def test_null_positions_are_versions_of_their_own(spark, workdir):
    # (1, NULL) and (NULL, 1) hash alike where NULLs are passed over
    table = _stored(spark.createDataFrame([(4, "x", 5, None, 1, "n") + OLD], SCHEMA), workdir + "/t")
    batch = _stored(spark.createDataFrame([(4, "x", 5, 1, None)], "k int, j string, v int, a int, b int"),
                    workdir + "/s")
    out = upsert(table, batch, "k, j", "r1", TS, newest_by="v", method="shuffle")
    assert rows(out, "a", "b") == [(1, None)]


def test_copies_in_the_batch(spark, workdir):
    table = _table(spark, workdir)
    batch = _batch(spark, workdir)
    twice = _stored(batch.unionByName(batch), workdir + "/s2")
    with pytest.raises(ValueError, match="not unique"):
        upsert(table, twice, "k, j", "r1", TS, newest_by="v", method="shuffle")
    args = dict(keys="k, j", run_id="r1", run_ts=TS, newest_by="v", check_unique=False)
    assert rows(upsert(table, twice, method="shuffle", **args)) == rows(
        upsert(table, twice, method="broadcast", **args))


def test_a_delivery_that_loses_moves_no_row(spark, workdir):
    table = _stored(spark.range(2000).select(
        F.col("id").alias("k"), F.lit(5).alias("v"), F.lit("t").alias("a"),
        *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in AUDIT.split(", "))]),
        workdir + "/t")
    late = _stored(spark.range(2000).select(F.col("id").alias("k"), F.lit(4).alias("v"),
                                            F.lit("s").alias("a")), workdir + "/s")
    for delivery in (late, _stored(table.select("k", "v", "a"), workdir + "/again")):
        out = upsert(table, delivery, "k", "r1", TS, newest_by="v", method="shuffle",
                     materialize_source=False, broadcast_budget=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Exchange|SortMergeJoin", plan)
        assert rows(out) == rows(table)


def test_both_ends_at_once(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, None, "c"), (2, 3, "d"), (2, 3, "e"),
                                (None, 1, "f"), (None, 2, "g")], "k int, v int, x string")
    both = dedupe_ends(df, "k", ["v"], flag="newer")
    for newest in (True, False):
        assert rows(both.where(F.col("newer") == newest).drop("newer")) == rows(
            dedupe_latest(df, "k", ["v"], newest=newest))


def test_a_partitioned_table_is_left_alone_by_a_merge_done_again(spark, workdir):
    path = workdir + "/t"
    table = spark.createDataFrame(
        [(k, "x", 5, 1, 1, "n" if k % 2 else "m") + OLD for k in range(20)], SCHEMA)
    table.write.partitionBy("note").parquet(path)
    batch = _stored(spark.createDataFrame(
        [(1, "x", 6, 2, 2, "n"), (2, "x", 4, 2, 2, "m"), (30, "x", 1, 2, 2, "m")],
        "k int, j string, v int, a int, b int, note string"), workdir + "/s")
    args = (spark, path, batch, "k, j", "note", "r1", TS)
    options = dict(schema=table.schema, newest_by="v", method="shuffle", broadcast_budget=0)
    assert upsert_partitioned(*args, **options) == 2
    after = rows(spark.read.schema(table.schema).parquet(path))
    assert {(1, "r1"), (30, "r1")} == {r for r in rows(
        spark.read.schema(table.schema).parquet(path), "k", "MODIFIED_BY") if r[1] == "r1"}
    files = sorted((d, f) for d, _, fs in os.walk(path) for f in fs)
    assert upsert_partitioned(*args, **options) == 0
    assert sorted((d, f) for d, _, fs in os.walk(path) for f in fs) == files
    assert rows(spark.read.schema(table.schema).parquet(path)) == after
