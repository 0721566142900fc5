"""Order-guarded merges, file-level upserts, silver from a stream, header probe, batch-sized keys."""

import os
from datetime import datetime
from itertools import permutations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata.mapping import ColumnMapping, mapping_frame
from strata.operators import (dedupe_latest, recover_by_file, recover_partitioned, stable_keys,
                              upsert, upsert_by_file, upsert_partitioned, write_clustered,
                              write_table)
from strata.operators import by_file, partitioned
from strata.plans import dim_appointment, silver_load
from strata.schemas import VERSION_COLUMN, versioned
from strata.sources import csv_headers, scan_csv_folder
from strata.streaming import incremental_silver, read_silver
from strata.streaming.ingest import BATCH_COLUMN
from tests.conftest import rows

AUDIT = "ADDED_BY string, ADDED_ON timestamp, MODIFIED_BY string, MODIFIED_ON timestamp"
TS = datetime(2024, 1, 1)


# ------------------------------------------------------------------ newest wins
DELIVERIES = [
    [("a", 9, "new", 1.0), ("b", 2, "x", None), ("c", None, "undated", 1.0)],
    [("a", 2, "old", 5.0), ("b", 2, "y", None), ("d", 1, None, None)],
    [("a", 9, "new", 2.0), ("c", 1, "dated", 0.0), ("d", 1, None, -1.0), ("b", 2, "y", 3.0)],
]


@pytest.mark.parametrize("method", ["broadcast", "shuffle"])
def test_deliveries_commute_and_repeat(spark, method):
    frames = [spark.createDataFrame(d, "k string, v int, t string, x double") for d in DELIVERIES]
    every = frames[0].union(frames[1]).union(frames[2])
    want = rows(dedupe_latest(every, "k", ["v"]))
    empty = spark.createDataFrame([], f"k string, v int, t string, x double, {AUDIT}")
    for order in [*permutations(range(3)), (0, 1, 2, 1, 0, 2)]:
        table = empty
        for k in order:
            table = upsert(table, frames[k], "k", f"r{k}", TS, method=method, newest_by="v")
        assert rows(table, "k", "v", "t", "x") == want, order


def test_a_losing_row_is_kept_with_its_audit(spark):
    target = spark.createDataFrame([("a", 9, "new", "r0", TS, "r0", TS)], f"k string, v int, t string, {AUDIT}")
    late = spark.createDataFrame([("a", 2, "old"), ("a2", 1, "n")], "k string, v int, t string")
    out = upsert(target, late, "k", "r1", TS, newest_by="v", with_action=True)
    assert rows(out, "k", "v", "t", "MODIFIED_BY", "__action") == [
        ("a", 9, "new", "r0", "kept"), ("a2", 1, "n", "r1", "inserted")]
    # without an order the merge stays unconditional
    assert rows(upsert(target, late, "k", "r1", TS), "k", "v") == [("a", 2), ("a2", 1)]


def test_newest_by_must_be_stored(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="newest_by"):
        upsert(target, target, "k", "r", newest_by="k")
    with pytest.raises(ValueError, match="newest_by"):
        upsert(target, target.select("k"), "k", "r", newest_by="v")


MAPPING = [("s", "O", "ID", "ID", "int", None), ("s", "O", "V", "V", "string", "none"),
           ("s", "O", "P", "P", "string", None)]
SILVER = versioned(StructType([
    StructField("ID", IntegerType()), StructField("V", StringType()),
    StructField("P", StringType()), StructField("ADDED_BY", StringType()),
    StructField("ADDED_ON", TimestampType()), StructField("MODIFIED_BY", StringType()),
    StructField("MODIFIED_ON", TimestampType())]))
BRONZE = StructType([StructField(c, StringType()) for c in ("ID", "V", "P", "ADDED_BY")]
                    + [StructField("ADDED_ON", TimestampType())])


def _bronze(spark, *data):
    return spark.createDataFrame([(i, v, p, "b", datetime(2024, 1, day)) for i, v, p, day in data],
                                 BRONZE)


def _mapping(spark):
    return ColumnMapping.from_frame(mapping_frame(spark, MAPPING), "O")


def test_silver_load_keeps_the_newer_delivery(spark):
    mapping = _mapping(spark)
    new, late = (_bronze(spark, ("1", "new", "p", 9), ("2", None, "p", 3)),
                 _bronze(spark, ("1", "old", "p", 2), ("3", "c", "q", 1), ("3", "b", "q", 1)))
    out = []
    for first, second in ((new, late), (late, new)):
        table = silver_load(first, mapping, "ID", "r1", target_schema=SILVER)
        assert table.columns == SILVER.fieldNames()
        table = silver_load(second, mapping, "ID", "r2", target=table, target_schema=SILVER)
        out.append(rows(table, "ID", "V", "P", VERSION_COLUMN))
    assert out[0] == out[1] == [(1, "new", "p", datetime(2024, 1, 9)),
                                (2, "none", "p", datetime(2024, 1, 3)),
                                (3, "c", "q", datetime(2024, 1, 1))]
    with pytest.raises(ValueError, match="latest"):
        silver_load(new, mapping, "ID", "r1", target_schema=SILVER, dedupe="any")


# ------------------------------------------------------------------ silver stream
def test_silver_stream_merges_new_bronze_once_late_and_again(spark, workdir):
    mapping = _mapping(spark)

    def deliver(batch, *data):
        (_bronze(spark, *data).withColumn(BATCH_COLUMN, F.lit(batch).cast("long")).write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COLUMN).parquet(f"{workdir}/bronze"))

    def run(on_batch=None):
        return incremental_silver(spark, f"{workdir}/bronze", BRONZE, f"{workdir}/silver", SILVER,
                                  f"{workdir}/ckpt", mapping, "ID", "P", "r", TS, on_batch=on_batch)

    def table():
        return rows(read_silver(spark, f"{workdir}/silver", SILVER), "ID", "V", "P")

    assert run() == {"batches": 0, "partitions": 0}                         # no bronze yet
    deliver(0, ("1", "new", "p", 9), ("2", "two", "p", 3), ("4", "four", "r", 1))
    assert run() == {"batches": 1, "partitions": 2}
    assert run() == {"batches": 0, "partitions": 0}                         # nothing new
    untouched = os.stat(next(f.path for f in os.scandir(f"{workdir}/silver/P=r")
                             if f.name.endswith(".parquet")))
    deliver(1, ("1", "old", "q", 2), ("2", "moved", "q", 5))                # one late, one newer
    lost = []

    def lose(batch_id, partitions):
        lost.append(batch_id)
        raise RuntimeError("lost after the merge")

    with pytest.raises(StreamingQueryException):
        run(lose)
    assert len(lost) == 1
    want = [(1, "new", "p"), (2, "moved", "q"), (4, "four", "r")]
    assert table() == want
    assert run()["batches"] == 1 and table() == want                        # merged again
    deliver(1, ("1", "old", "q", 2), ("2", "moved", "q", 5))                # ingest redid its batch
    run()
    assert table() == want
    after = os.stat(next(f.path for f in os.scandir(f"{workdir}/silver/P=r")
                         if f.name.endswith(".parquet")))
    assert (after.st_ino, after.st_mtime_ns) == (untouched.st_ino, untouched.st_mtime_ns)
    with pytest.raises(ValueError, match=VERSION_COLUMN):
        incremental_silver(spark, workdir, BRONZE, workdir, BRONZE, workdir, mapping, "ID", "P", "r")


# ------------------------------------------------------------------ changes that fail half way
TABLE = f"k int, part string, v string, {AUDIT}"


def _table(spark, n=40):
    return spark.createDataFrame([(i, "abcd"[i % 4], f"v{i}", "r0", TS, "r0", TS)
                                  for i in range(n)], TABLE)


def test_partitioned_upsert_finishes_what_failed(spark, workdir, monkeypatch):
    path = f"{workdir}/t"
    write_table(_table(spark), path, partition_by="part")
    batch = spark.createDataFrame([(0, "b", "moved"), (1, "b", "new"), (99, "c", "ins")],
                                  "k int, part string, v string")
    whole = partitioned._replace_partitions

    def fails(spark, path, change):
        change = {**change, "emptied": []}
        rows_ = spark.read.schema(StructType.fromJson(change["schema"])).parquet(change["merged"])
        (rows_.where("part = 'b'").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))
        raise OSError("lost")

    monkeypatch.setattr(partitioned, "_replace_partitions", fails)
    with pytest.raises(OSError):
        upsert_partitioned(spark, path, batch, "k", "part", "r1", TS)
    monkeypatch.setattr(partitioned, "_replace_partitions", whole)
    # 0 is in both partitions now; the next run finishes the change first
    assert spark.read.parquet(path).where("k = 0").count() == 2
    assert recover_partitioned(spark, path) and not recover_partitioned(spark, path)
    got = {r.k: (r.part, r.v) for r in spark.read.parquet(path).collect()}
    want = {i: ("abcd"[i % 4], f"v{i}") for i in range(40)}
    assert got == {**want, 0: ("b", "moved"), 1: ("b", "new"), 99: ("c", "ins")}
    assert spark.read.parquet(path).count() == 41


def _files(path):
    return {f.name: (f.stat().st_ino, f.stat().st_mtime_ns) for f in os.scandir(path)
            if f.name.endswith(".parquet")}


def test_upsert_by_file_leaves_other_files_alone(spark, workdir):
    path = f"{workdir}/some table"
    write_clustered(_table(spark, 400).drop("part"), path, "k", 8)
    before = _files(path)
    assert len(before) > 4
    batch = spark.createDataFrame([(5, "changed"), (7, None), (1000, "new"), (None, "null key")],
                                  "k int, v string")
    did = upsert_by_file(spark, path, batch, "k", "r1", TS)
    after = _files(path)
    assert did["replaced"] == 1 and did["kept"] == len(before) - 1
    assert len(set(before) & set(after)) == len(before) - 1
    assert all(after[f] == before[f] for f in set(before) & set(after))
    got = {r.k: (r.v, r.ADDED_BY, r.MODIFIED_BY) for r in spark.read.parquet(path).collect()}
    want = {i: (f"v{i}", "r0", "r0") for i in range(400)}
    assert got == {**want, 5: ("changed", "r0", "r1"), 7: (None, "r0", "r1"),
                   1000: ("new", "r1", "r1"), None: ("null key", "r1", "r1")}
    assert upsert_by_file(spark, path, batch.limit(0), "k", "r2") == {
        "replaced": 0, "added": 0, "kept": len(after)}
    assert upsert_by_file(spark, path, batch.where("k = 2000"), "k", "r2")["added"] == 0


def test_upsert_by_file_with_many_and_composite_keys(spark, workdir, monkeypatch):
    monkeypatch.setattr(by_file, "FEW_KEYS", 3)
    path = f"{workdir}/t"
    table = spark.createDataFrame([(i % 20, f"s{i // 20}", i) for i in range(300)],
                                  "a int, b string, v int")
    write_clustered(table, path, "a, b", 6)
    batch = spark.createDataFrame([(i % 20, f"s{i // 20}", -1) for i in range(0, 300, 7)]
                                  + [(50, "s1", -2)], "A long, B string, V long")
    upsert_by_file(spark, path, batch, "a, b", "r")
    want = sorted([(i % 20, f"s{i // 20}", -1 if i % 7 == 0 else i) for i in range(300)]
                  + [(50, "s1", -2)])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == want


@pytest.mark.parametrize("step", ["rename", "delete"])
def test_upsert_by_file_finishes_what_failed(spark, workdir, monkeypatch, step):
    path = f"{workdir}/t"
    write_clustered(_table(spark, 100).drop("part"), path, "k", 4)
    batch = spark.createDataFrame([(i, "changed") for i in range(0, 100, 3)], "k int, v string")
    real, calls = getattr(by_file, step), []

    def fails(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(by_file, step, fails)
    with pytest.raises(OSError):
        upsert_by_file(spark, path, batch, "k", "r1", TS)
    monkeypatch.setattr(by_file, step, real)
    # the next run, of another batch, finishes the change first
    upsert_by_file(spark, path, spark.createDataFrame([(1, "later")], "k int, v string"), "k",
                   "r2", TS)
    assert not recover_by_file(spark, path)
    got = sorted((r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == sorted((i, "later" if i == 1 else f"v{i}" if i % 3 else "changed")
                         for i in range(100))
    assert not [f for f in os.listdir(path) if f.startswith("_staged")]


def test_bloom_filter_and_statistics_skip_row_groups(spark, workdir):
    import pyarrow.parquet as pq
    path = f"{workdir}/t"
    write_clustered(spark.range(0, 20_000, 2).selectExpr("cast(id * 7 as int) k", "id v"), path,
                    "k", 4)
    ranges = sorted((m.row_group(0).column(0).statistics.min, m.row_group(0).column(0).statistics.max)
                    for m in (pq.ParquetFile(f"{path}/{f}").metadata for f in _files(path)))
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    target = spark.read.parquet(path)
    keys = spark.createDataFrame([(14,), (28,)], "k int")
    assert len(by_file.files_with_keys(target, keys)) == 1
    absent = spark.createDataFrame([(13,), (100_001,)], "k int")     # within the range, not there
    assert by_file.files_with_keys(target, absent) == []
    seen = Observation("rows past the Parquet filters")
    probe = target.select("k").where(F.col("k").isin([13, 100_001])).observe(
        seen, F.count(F.lit(1)).alias("n"))
    assert probe.count() == 0 and seen.get["n"] == 0


# ------------------------------------------------------------------ header probe
def _bytes_read(spark):
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in stats)


def test_header_probe_reads_a_few_kb_of_each_file(spark, workdir):
    layouts = ["A,B,C", "b,c,a", "C#,a,\"B \""]
    for k, head in enumerate(layouts):
        with open(f"{workdir}/{k} x.csv", "w") as f:
            f.write(head + "\n" + "".join(f"{i},{i},{i}\n" for i in range(200_000)))
    size = sum(f.stat().st_size for f in os.scandir(workdir))
    before = _bytes_read(spark)
    heads = csv_headers(spark, workdir).collect()
    read = _bytes_read(spark) - before
    assert sorted(r.header for r in heads) == sorted(layouts)
    assert read <= 3 * 16_384 < size / 50
    got = scan_csv_folder(spark, workdir)
    assert sorted(got.columns) == ["A", "B", "C"] and got.count() == 600_000


def test_header_probe_of_long_compressed_and_odd_files(spark, workdir):
    import gzip
    names = [f"column_{i}" for i in range(3000)]                            # longer than one read
    with open(f"{workdir}/long.csv", "w") as f:
        f.write(",".join(names) + "\r\n" + ",".join(["1"] * 3000))
    with open(f"{workdir}/bom.csv", "wb") as f:
        f.write(b"\xef\xbb\xbfA,\xc3\xa9")                                  # no line end
    open(f"{workdir}/empty.csv", "w").close()
    with gzip.open(f"{workdir}/z.csv.gz", "wt") as f:
        f.write("A,B\n1,2\n")
    heads = {os.path.basename(r.path): r.header for r in csv_headers(
        spark, workdir, "*.csv*").collect()}
    assert heads == {"long.csv": ",".join(names), "bom.csv": "A,é", "z.csv.gz": "A,B"}


# ------------------------------------------------------------------ batch-sized keys
def _shuffled(spark, run):
    """Rows written to shuffles while ``run`` ran, by Spark's own task metrics."""
    tracker = spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    none = spark.sparkContext._jvm.java.util.ArrayList()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        stages = tracker.stageList(none, False, False, spark.sparkContext._gateway.new_array(
            spark.sparkContext._jvm.double, 0), none)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_incremental_dimension_shuffles_the_batch_alone(spark, workdir):
    schema = "YARD_NAME string, SALES_ORDER_TICKET_ID string, CARRIER_NAME string"
    big = spark.range(60_000).selectExpr("concat('y', id % 50) YARD_NAME",
                                         "cast(id as string) SALES_ORDER_TICKET_ID",
                                         "'c' CARRIER_NAME")
    write_table(dim_appointment(big, "r0", TS), f"{workdir}/dim")
    dim = spark.read.parquet(f"{workdir}/dim")
    batch = spark.createDataFrame([("y1", "1", "c"), ("y9", "59959", "c"), ("a", "new", "c"),
                                   ("a", "new", "c"), (None, None, None)], schema)
    out = []
    moved = _shuffled(spark, lambda: out.extend(
        dim_appointment(batch, "r1", TS, existing=dim).where("MODIFIED_BY = 'r1'").collect()))
    assert moved < 2_000
    old = {r.SALES_ORDER_ID: r.APPOINTMENT_DATA_KEY for r in
           dim.where("SALES_ORDER_ID IN ('1', '59959')").collect()}
    got = sorted((r.APPOINTMENT_DATA_KEY, r.SALES_ORDER_ID) for r in out)
    assert got == sorted([(old["1"], "1"), (old["59959"], "59959"), (60_001, None),
                          (60_002, "new"), (60_003, "new")])
    again = stable_keys(batch.select(F.col("YARD_NAME").alias("n")), spark.createDataFrame(
        [("y1", 4)], "n string, key int"), "n", "key", ["n"], keep_vanished=False, last_key=70)
    assert sorted(r.key for r in again.collect()) == [4, 71, 72, 73, 74]


def test_stable_keys_with_a_hot_natural_key(spark):
    rows_ = [("hot", i % 3) for i in range(900)] + [(f"k{i}", i) for i in range(50)] + [(None, 1)] * 20
    now = spark.createDataFrame(rows_, "n string, v int").repartition(5)
    first = stable_keys(now, spark.createDataFrame([], "n string, key int"), "n", "key", ["n", "v"])
    keys = sorted(r.key for r in first.collect())
    assert keys == list(range(1, 971))
    less = now.where("n = 'hot'").limit(500)
    kept = stable_keys(less, first.select("n", "key"), "n", "key", ["n"], keep_vanished=False)
    hot = sorted(r.key for r in first.where("n = 'hot'").collect())
    assert sorted(r.key for r in kept.collect()) == hot[:500]
