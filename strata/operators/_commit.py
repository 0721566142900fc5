"""Replacing files of a stored table so that a failure half way can be finished later.

What is about to change is written down first, in a hidden file of the table that
readers ignore (``_pending``). From then on the change only rolls forward: the next
writer finds the note and does the rest, each step of which may be repeated.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

PENDING = "_pending"


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a URI or plain path, as Spark's own writers see it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(conf), at


def of_uri(spark: SparkSession, uri: str) -> str:
    """The plain path of a file named by a URI with escapes, as Spark lists it."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return bool(fs.exists(at))


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file unless an earlier attempt has moved it."""
    fs, a = file_system(spark, source)
    if fs.exists(a):
        if not fs.rename(a, file_system(spark, target)[1]):
            raise OSError(f"cannot move {source} to {target}")


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """Plain paths of the data files right below a folder."""
    fs, at = file_system(spark, folder)
    return sorted(f.getPath().toString() for f in fs.listStatus(at)
                  if f.isFile() and f.getPath().getName()[0] not in "_.")


def note(spark: SparkSession, table: str, what: dict) -> None:
    """Write down a change; complete or not there at all."""
    fs, final = file_system(spark, f"{table}/{PENDING}")
    draft = file_system(spark, f"{table}/{PENDING}.draft")[1]
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(what).encode()))
    out.close()
    if not fs.rename(draft, final):
        raise OSError(f"{table} has a change of another writer under way")


def noted(spark: SparkSession, table: str) -> dict | None:
    """The change that an earlier writer has begun and not finished."""
    fs, at = file_system(spark, f"{table}/{PENDING}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return json.loads(bytes(raw).decode())


def forget(spark: SparkSession, table: str) -> None:
    delete(spark, f"{table}/{PENDING}")
