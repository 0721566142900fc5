"""Upsert into an unpartitioned Parquet table that rewrites only the files it hits.

Copy-on-write by file: the files that hold a key of the batch are read, merged by
:func:`strata.operators.load.upsert` and replaced; all others keep their name and
time. Finding them reads the key columns only, and of those only the row groups
that the batch's key range (their minima and maxima) and, for a few keys, Parquet
Bloom filters cannot rule out. New files are clustered by key and carry a Bloom
filter, so the table stays easy to skip.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators._commit import (delete, exists, files_in, forget, note, noted, of_uri,
                                      rename)
from strata.operators._util import all_not_null, and_all, materialize, q, resolve, split_keys
from strata.operators.joins import broadcast_if_small
from strata.operators.load import upsert
from strata.session import scratch_path

#: Distinct values of the first key up to which they are looked up one by one.
FEW_KEYS = 1000
_IN_LIMIT = "spark.sql.parquet.pushdown.inFilterThreshold"


@contextmanager
def _set(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_clustered(df: DataFrame, path: str, keys, files: int, mode: str = "errorifexists") -> None:
    """Write ``df`` as about ``files`` files that follow one another in key order, with a
    Bloom filter of the first key; a key held by many rows spreads by a hash of the row."""
    keys = resolve(df, split_keys(keys))
    plain = [q(f.name) for f in df.schema.fields if f.dataType.typeName() not in
             ("map", "array", "struct")]
    order = [*[q(k) for k in keys], F.xxhash64(*plain)]
    (df.repartitionByRange(files, *order).sortWithinPartitions(*[q(k) for k in keys])
     .write.mode(mode).option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").parquet(path))


def files_with_keys(target: DataFrame, batch_keys: DataFrame) -> list[str]:
    """URIs of the files of ``target`` with one of ``batch_keys`` (distinct, all columns).

    The list is on the driver, as Spark's own listing of the table is.
    """
    spark, keys = target.sparkSession, batch_keys.columns
    known = batch_keys.where(all_not_null([q(k) for k in keys]))
    bounds = known.agg(*[f(q(k)).alias(f"{f.__name__}_{i}")
                         for i, k in enumerate(keys) for f in (F.min, F.max)]).first()
    if bounds[0] is None:
        return []
    near = target.where(and_all([q(k).between(F.lit(bounds[2 * i]), F.lit(bounds[2 * i + 1]))
                                 for i, k in enumerate(keys)]))
    few = [r[0] for r in known.select(q(keys[0])).distinct().limit(FEW_KEYS + 1).collect()]
    if len(few) <= FEW_KEYS:
        near = near.where(q(keys[0]).isin(few))
    hits = (near.select(*[q(k) for k in keys], F.col("_metadata.file_path").alias("__file"))
            .join(broadcast_if_small(known), keys, "left_semi").select("__file").distinct())
    # else more than ten values would be pushed down as a range, and no Bloom filter asked
    with _set(spark, _IN_LIMIT, str(FEW_KEYS)):
        return sorted(r[0] for r in hits.collect())


def _apply(spark: SparkSession, path: str, change: dict) -> None:
    """Move the new files in, then delete the old ones; each step may be repeated."""
    for name in change["add"]:
        rename(spark, f"{path}/{change['staged']}/{name}", f"{path}/{name}")
    for old in change["remove"]:
        delete(spark, old)
    delete(spark, f"{path}/{change['staged']}")
    forget(spark, path)


def recover_by_file(spark: SparkSession, path: str) -> bool:
    """Finish a replacement that a failed run has left half done; whether there was one."""
    change = noted(spark, path)
    if change is None:
        return False
    _apply(spark, path, change)
    return True


def upsert_by_file(spark: SparkSession, path: str, source: DataFrame, keys, run_id: str,
                   run_ts=None, schema: StructType | None = None, **options) -> dict:
    """MERGE ``source`` into the flat Parquet table at ``path``.

    Rules, audit columns and ``options`` are those of ``upsert``. Returns the
    numbers of files replaced, added and left alone. New rows come in the new
    files; an empty batch changes nothing. The new files are complete in a hidden
    folder of the table before the change is noted, and only then are files moved
    in and old ones deleted: do not read the table during that, and the next run
    finishes a change that failed half way before it begins its own.
    """
    path = path.rstrip("/")
    if exists(spark, path):
        recover_by_file(spark, path)
    target = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    keys = resolve(target, split_keys(keys))
    batch, rows, _ = materialize(source, "upsert-batch")
    before = files_in(spark, path)
    if not rows:
        return {"replaced": 0, "added": 0, "kept": len(before)}
    batch_keys = batch.select([q(a).cast(target.schema[b].dataType).alias(b) for a, b in
                               zip(resolve(batch, keys), keys)]).distinct()
    hit = [of_uri(spark, f) for f in files_with_keys(target, batch_keys)]
    part = (spark.read.schema(target.schema).parquet(*hit) if hit else
            spark.createDataFrame([], target.schema))
    merged_path = scratch_path(spark, "upsert-merged")
    upsert(part, batch, keys, run_id, run_ts, **options).write.parquet(merged_path)
    staged = f"_staged-{uuid.uuid4().hex}"
    write_clustered(spark.read.schema(target.schema).parquet(merged_path), f"{path}/{staged}",
                    keys, max(1, len(hit)))
    add = [f.rsplit("/", 1)[1] for f in files_in(spark, f"{path}/{staged}")]
    change = {"staged": staged, "add": add, "remove": hit}
    note(spark, path, change)
    _apply(spark, path, change)
    return {"replaced": len(hit), "added": len(add), "kept": len(before) - len(hit)}
