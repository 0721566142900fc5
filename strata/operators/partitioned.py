"""Upsert into a partitioned Parquet table that rewrites only what changed.

A small daily batch touches few partitions of a large table. The affected ones
are those the batch writes to and those its keys are in now (a key may move).
Only they are read in full, merged by :func:`strata.operators.load.upsert` and
replaced by a dynamic partition overwrite; files of all others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators._commit import delete, exists, forget, note, noted, of_uri
from strata.operators._util import COMPRESSION, and_all, materialize, q, resolve, split_keys
from strata.operators.load import upsert_changes
from strata.session import scratch_path


def _one_of(columns: list[str], values: list) -> Column:
    """Whether the columns hold one of the value tuples, NULL like any other value.

    A balanced tree of ORs, so that many partitions make no deep expression.
    """
    if not values:
        return F.lit(False)
    tests = [and_all([q(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, row)]) for row in values]
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i]
                 for i in range(0, len(tests), 2)]
    return tests[0]


def _partitions(df: DataFrame, columns: list[str]) -> list[tuple]:
    """Distinct partition values, as many as there are folders to rewrite."""
    return [tuple(r) for r in df.select([q(c) for c in columns]).distinct().collect()]


def _replace_partitions(spark: SparkSession, path: str, change: dict) -> None:
    """Put the merged rows in place of their partitions; delete the folders left empty.

    May be repeated: both steps give the same table again.
    """
    columns = change["columns"]
    rows = spark.read.schema(StructType.fromJson(change["schema"])).parquet(change["merged"])
    (rows.hint("rebalance", *columns).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
     .partitionBy(*columns).parquet(path))
    for folder in change["emptied"]:
        delete(spark, folder)


def recover_partitioned(spark: SparkSession, path: str) -> bool:
    """Finish a replacement that a failed run has left half done; whether there was one.

    ``upsert_partitioned`` does this by itself; readers that must see a whole table
    after a failure call it first. The merged rows are still in the scratch folder.
    """
    change = noted(spark, path)
    if change is None:
        return False
    _replace_partitions(spark, path, change)
    forget(spark, path)
    return True


def upsert_partitioned(spark: SparkSession, path: str, source: DataFrame, keys, partition_by,
                       run_id: str, run_ts=None, schema: StructType | None = None,
                       **options) -> int:
    """MERGE ``source`` into the Parquet table at ``path``; return the partitions rewritten.

    ``partition_by`` names the table's partition columns, which ``source`` must
    have; ``schema`` is the table's (else Spark infers the partition columns'
    types from the folder names). Rules, audit columns and ``options`` are those
    of ``upsert``. A key found in another partition moves to the batch's one,
    and a partition left without rows is deleted. An empty batch changes nothing, nor does
    one of which ``newest_by`` shows that no row of it wins or is new.

    The merged rows are in the shared scratch folder before the table is
    touched, so a lost executor cannot mix old and new. Folders are replaced
    one after another, as Parquet has no commit over several: do not read the
    table meanwhile. The change is noted in the table first, and the next run
    finishes one that failed half way before it begins its own.
    """
    if exists(spark, path):
        recover_partitioned(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    target = reader.parquet(path)
    keys = resolve(target, split_keys(keys))
    columns = resolve(target, split_keys(partition_by))
    batch, rows, _ = materialize(source, "upsert-batch")
    if not rows:
        return 0
    names = dict(zip(resolve(batch, columns), columns))
    new_homes = set(_partitions(batch.select(
        [q(a).cast(target.schema[b].dataType).alias(b) for a, b in names.items()]), columns))
    # keys and partition columns only; batch keys made distinct, so no key multiplies
    batch_keys = batch.select([q(a).alias(b) for a, b in zip(resolve(batch, keys), keys)]).distinct()
    # where the batch's keys are now matters only if some partition is not affected anyway
    all_homes = set(_partitions(target, columns))
    old_homes = set() if all_homes <= new_homes else set(
        _partitions(target.join(batch_keys, keys, "left_semi"), columns))
    affected = sorted(new_homes | old_homes, key=repr)
    part = target.where(_one_of(columns, affected))
    merged_path = scratch_path(spark, "upsert-merged")
    snapshot, changed = upsert_changes(part, batch, keys, run_id, run_ts,
                                       **{"materialize_source": False, **options})
    if not changed:
        return 0
    snapshot.drop("__action").write.option("compression", COMPRESSION).parquet(merged_path)
    merged = spark.read.schema(target.schema).parquet(merged_path)
    left = set(_partitions(merged, columns))
    emptied = [of_uri(spark, r[0]) for r in
               target.where(_one_of(columns, [p for p in affected if p not in left])).select(
                   F.regexp_replace("_metadata.file_path", "/[^/]*$", "")).distinct().collect()]
    change = {"merged": merged_path, "schema": target.schema.jsonValue(), "columns": columns,
              "emptied": emptied}
    note(spark, path, change)
    _replace_partitions(spark, path, change)
    forget(spark, path)
    return len(affected)
