"""Helpers shared by the operators: scratch tables, code shipping, Arrow slices."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Null ids sort and compare as this one: after every other.
LAST_ID = 2**63 - 1
#: Text bytes that one vectorised step works on; bounds the memory of a Python worker.
SLICE_BYTES = 2_000_000
_SHIPPED = "_strata_llm_code_shipped"
#: Bytes of one Arrow batch between Spark and a Python worker (Spark's default is 64 MB).
ARROW_BYTES = "4m"
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per Spark context, and
    bound the bytes of an Arrow batch unless the session has set its own bound.

    Tasks then import it like any module, so what a worker loads (a tokenizer,
    a word cache) lives as long as the worker and not only for one task.
    """
    sc = spark.sparkContext
    # whole texts make large batches; both the JVM and the worker hold several at a time
    if spark.conf.get(_BATCH_KEY, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, ARROW_BYTES)
    if getattr(sc, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="strata-code-"), "strata.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("strata", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    setattr(sc, _SHIPPED, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases now, not at some later collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_scratch(df: DataFrame) -> None:
    """Delete the files below a :func:`written` table that no later phase reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(df: DataFrame) -> DataFrame:
    """``doc_id`` (long, null as the largest id) and ``text`` (null as empty)."""
    return df.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def shown_id(name: str = "doc_id") -> Column:
    """The id as given: the stand-in for null back to null."""
    return F.when(F.col(name) != LAST_ID, F.col(name)).alias(name)


def slices(batch: pa.RecordBatch, column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes of ``column`` (one row at least)."""
    if batch.num_rows == 0:
        return
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes):
        n = 0 if n != n else int(n)
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    yield batch.slice(start)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A string column as Python bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of the test data, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name
