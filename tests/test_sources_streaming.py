"""CSV landing files and load-once ingestion."""

import os

import pytest
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from strata.plans import bronze_load
from strata.sources import csv_headers, scan_csv, scan_csv_folder
from strata.streaming import incremental_ingest, read_ingested
from tests.conftest import rows

BRONZE = StructType([StructField(c, StringType()) for c in ("YARD_ID", "PRICE", "NOTE")]
                    + [StructField("ADDED_BY", StringType()), StructField("ADDED_ON", TimestampType())])


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def _landing(folder):
    os.makedirs(folder, exist_ok=True)
    _write(f"{folder}/Sales_1.csv",
           'Yard ID,Price ($),Note\n1,10,plain\n2,20\n3,30,x,surplus\n4,,""\n')
    _write(f"{folder}/Sales_2.csv", "note,PRICE,yard-id\nz,50,5\n")
    _write(f"{folder}/readme.txt", "not,a,csv\n1,2,3\n")


def test_scan_csv_strings_rules(spark, workdir):
    _landing(workdir)
    df = scan_csv(spark, f"{workdir}/Sales_1.csv")
    assert [f.dataType for f in df.schema.fields] == [StringType()] * 3
    assert rows(df) == [("1", "10", "plain"), ("2", "20", None), ("3", "30", "x"),
                        ("4", None, None)]


def test_csv_folder_scan_aligns_headers_and_skips_txt(spark, workdir):
    _landing(workdir)
    heads = {os.path.basename(r.path): r.header for r in csv_headers(spark, workdir).collect()}
    assert set(heads) == {"Sales_1.csv", "Sales_2.csv"}
    df = scan_csv_folder(spark, workdir)
    assert sorted(df.columns) == ["NOTE", "PRICE", "YARD_ID"]
    assert rows(df, "YARD_ID", "PRICE", "NOTE") == [
        ("1", "10", "plain"), ("2", "20", None), ("3", "30", "x"), ("4", None, None),
        ("5", "50", "z")]


def test_colliding_headers_raise(spark, workdir):
    _write(f"{workdir}/bad.csv", "A B,A-B\n1,2\n")
    with pytest.raises(ValueError, match="both normalise"):
        scan_csv_folder(spark, workdir)


def test_bronze_load_conforms(spark, workdir):
    _landing(workdir)
    out = bronze_load(spark, workdir, BRONZE, "r1")
    assert out.columns == BRONZE.fieldNames()
    assert out.count() == 5 and out.filter("ADDED_BY = 'r1' AND ADDED_ON IS NOT NULL").count() == 5


def test_ingest_loads_each_file_once(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/bronze"
    os.makedirs(src)
    _write(f"{src}/Sales_1.csv", "Yard ID,Price ($),Note\n1,10,a\n2,20,b\n")
    _write(f"{src}/skip.txt", "x\n")
    args = dict(source_dir=src, table_path=f"{base}/table", checkpoint_path=f"{base}/ckpt",
                archive_dir=f"{workdir}/archive", target_schema=BRONZE, run_id="r1")
    first = incremental_ingest(spark, **args)
    assert first["rows"] == 2
    again = incremental_ingest(spark, **args)
    assert again["rows"] == 0
    assert read_ingested(spark, f"{base}/table").count() == 2
    _write(f"{src}/Sales_2.csv", "Yard ID,Price ($),Note\n3,30,c\n")
    third = incremental_ingest(spark, **args)
    assert third["rows"] == 1
    assert rows(read_ingested(spark, f"{base}/table"), "YARD_ID") == [("1",), ("2",), ("3",)]
    # loaded CSV files are archived once a later batch committed; other files stay
    assert os.path.exists(f"{src}/skip.txt")
    archived = [f for _, _, fs in os.walk(f"{workdir}/archive") for f in fs if f.endswith(".csv")]
    assert "Sales_1.csv" in archived


def test_retried_batch_replaces_its_partition(spark, workdir):
    # a batch that is written twice (retry after a failure) leaves one copy
    from pyspark.sql import functions as F
    from strata.plans import conform_bronze
    raw = spark.createDataFrame([("1", "10", "a"), ("2", "20", "b")], "`Yard ID` string, `Price ($)` string, Note string")
    out = conform_bronze(raw, BRONZE, "r1").withColumn("BATCH_ID", F.lit(0))
    path = f"{workdir}/t"
    for _ in range(2):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("BATCH_ID").parquet(path)
    assert spark.read.parquet(path).count() == 2


def test_ingest_backlog_in_bounded_batches(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/bronze"
    os.makedirs(src)
    for i in range(5):
        _write(f"{src}/Sales_{i}.csv", f"Yard ID,Price ($),Note\n{i},1,x\n")
    stats = incremental_ingest(spark, source_dir=src, table_path=f"{base}/table",
                               checkpoint_path=f"{base}/ckpt", archive_dir=f"{workdir}/archive",
                               target_schema=BRONZE, run_id="r1", max_files_per_trigger=2)
    assert stats["batches"] == 3 and stats["rows"] == 5
    t = read_ingested(spark, f"{base}/table", keep_batch_id=True)
    assert t.count() == 5 and t.select("BATCH_ID").distinct().count() == 3


def test_header_probe_needs_no_package_on_workers(workdir):
    # run from another folder, so Python workers cannot import the package
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    _landing(workdir)
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from strata.session import build_session\n"
            "from strata.sources import scan_csv_folder\n"
            "spark = build_session(master='local[2]', shuffle_partitions=2)\n"
            f"print('ROWS', scan_csv_folder(spark, {workdir!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 5" in out.stdout, out.stderr[-2000:]


def test_header_probe_reads_whole_long_header(spark, workdir):
    names = [f"Column Number {i}" for i in range(40)]
    _write(f"{workdir}/wide.csv", ",".join(names) + "\n" + ",".join(str(i) for i in range(40)) + "\n")
    got = csv_headers(spark, workdir).collect()
    assert got[0].header == ",".join(names)


def test_spelling_variants_of_one_layout_read_together(spark, workdir):
    _write(f"{workdir}/a.csv", "Yard ID,Price ($)\n1,10\n")
    _write(f"{workdir}/b.csv", "YARD_ID,price\n2,20\n")
    df = scan_csv_folder(spark, workdir)
    assert df.columns == ["YARD_ID", "PRICE"]
    assert rows(df) == [("1", "10"), ("2", "20")]


def test_read_only_new_batches_by_partition_pruning(spark, workdir):
    from strata.streaming import last_batch
    src, base = f"{workdir}/in", f"{workdir}/bronze"
    os.makedirs(src)
    args = dict(source_dir=src, table_path=f"{base}/table", checkpoint_path=f"{base}/ckpt",
                archive_dir=f"{workdir}/archive", target_schema=BRONZE, run_id="r1")
    _write(f"{src}/Sales_1.csv", "Yard ID,Price ($),Note\n1,10,a\n")
    incremental_ingest(spark, **args)
    seen = last_batch(spark, f"{base}/table")
    _write(f"{src}/Sales_2.csv", "Yard ID,Price ($),Note\n2,20,b\n")
    incremental_ingest(spark, **args)
    new = read_ingested(spark, f"{base}/table", since_batch=seen)
    assert rows(new, "YARD_ID") == [("2",)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(BATCH_ID" in plan


def test_batch_failing_after_its_write_is_redone_once(spark, workdir):
    src, base = f"{workdir}/in", f"{workdir}/bronze"
    os.makedirs(src)
    _write(f"{src}/Sales_1.csv", "Yard ID,Price ($),Note\n1,10,a\n2,20,b\n")
    args = dict(source_dir=src, table_path=f"{base}/table", checkpoint_path=f"{base}/ckpt",
                archive_dir=f"{workdir}/archive", target_schema=BRONZE, run_id="r1")
    calls = []

    def fail_first(batch_id, n):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("crash after the write")

    with pytest.raises(Exception):
        incremental_ingest(spark, on_batch=fail_first, **args)
    assert spark.read.parquet(f"{base}/table").count() == 2      # written, not committed
    again = incremental_ingest(spark, on_batch=fail_first, **args)
    assert calls == [0, 0] and again["rows"] == 2                 # the same batch redone
    t = read_ingested(spark, f"{base}/table", keep_batch_id=True)
    assert t.count() == 2 and rows(t.select("BATCH_ID").distinct()) == [(0,)]
    assert incremental_ingest(spark, **args)["rows"] == 0         # and now committed


def test_jdbc_partitioned_read_needs_bounds(spark):
    # only argument checks: reading needs a database, which is not started here
    from strata.sources import scan_jdbc
    with pytest.raises(ValueError, match="bounds"):
        scan_jdbc(spark, "jdbc:none://x", "t", partition_column="id")
