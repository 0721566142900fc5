"""Exact dedup by content sort.

Texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted. Sampled splitters range-partition the
normalised bytes (by a fixed-size head of them, their 64-bit hash and the id, so
a splitter is small and a hot text is spread over many partitions); Spark's
external sort places equal texts side by side; each partition compares whole
neighbouring texts. A group that touches a partition's edge may go on in the
next partition; those fragments, two keys per partition, are united by SHA-256.

Edge cases: null text is empty and equal to any text of white space; a null id
is the largest; of repeated rows one is kept; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, IntegerType, LongType, StructField,
                               StructType)

from strata.llm.common import documents, ship, shown_id, slices, utf8, written

SPACE = b" \t\n\x0b\x0c\r"
HEAD_BYTES = 24

NORMAL = "doc_id long, size long, head binary, h long, sha binary, body binary"
FRAGMENT = StructType([StructField("doc_id", LongType()), StructField("sha", BinaryType()),
                       StructField("keep", LongType()), StructField("size", LongType()),
                       StructField("members", LongType()), StructField("first", BooleanType()),
                       StructField("edge", BooleanType()), StructField("part", IntegerType())])


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, limit=16_000_000):
            body = [t.translate(None, SPACE) for t in utf8(part)]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("size").cast(pa.int64()),
                pa.array([b[:HEAD_BYTES] for b in body], pa.binary()),
                pa.array([xxhash.xxh64_intdigest(b) - 2**63 for b in body], pa.int64()),
                pa.array([hashlib.sha256(b).digest() for b in body], pa.binary()),
                pa.array(body, pa.binary())], names=["doc_id", "size", "head", "h", "sha", "body"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal texts in a sorted partition, one row per document.

    Rows of one (head, hash) wait until the next one begins, since only then is
    it known whether they stand at the partition's edge; only ids wait, not texts.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    key = body = None
    runs: list[list] = []       # of the present key: [sha, keep, size, ids]
    first_key = True

    def flush(edge: bool):
        for sha, keep, size, ids in runs:
            n = len(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([sha] * n, pa.binary()),
                pa.array([keep] * n, pa.int64()), pa.array([size] * n, pa.int64()),
                pa.array([n] * n, pa.int64()), pa.array([True] + [False] * (n - 1), pa.bool_()),
                pa.array([edge] * n, pa.bool_()), pa.array([part] * n, pa.int32())],
                names=FRAGMENT.names)

    def stream():
        nonlocal key, body, first_key
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "size", "head", "h", "sha")]
            bodies = batch.column("body")
            for i, (doc, size, head, h, sha) in enumerate(zip(*cols, strict=True)):
                text = bodies[i].as_py()
                if (head, h) != key:
                    yield from flush(first_key)
                    first_key = key is None
                    key, body, runs[:] = (head, h), None, []
                if text == body:
                    runs[-1][3].append(doc)
                else:
                    runs.append([sha, doc, size, [doc]])
                    body = text
        yield from flush(True)

    yield from _packed(stream())


def _packed(rows: Iterator[pa.RecordBatch], least: int = 10_000) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += r.num_rows
        if n >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row."""
    ship(docs.sparkSession)
    normal = (documents(docs).withColumn("size", F.length("text"))
              .mapInArrow(_normalise, NORMAL))
    ordered = (normal.repartitionByRange("head", "h", "doc_id")
               .sortWithinPartitions("head", "h", "body", F.desc("size"), "doc_id"))
    rows = written(ordered.mapInArrow(_neighbours, FRAGMENT), "content-sort")
    edges = (rows.where("edge").groupBy("sha").agg(
        F.count("*").alias("all"),
        F.min(F.struct(-F.col("size"), "keep", "part")).alias("best"))
        .select(F.col("sha").alias("edge_sha"), "all", F.col("best.keep").alias("best_keep"),
                F.col("best.part").alias("best_part")))
    # at most two keys of a partition stand at its edges: bounded by the number of partitions
    out = rows.join(F.broadcast(edges), F.col("edge") & (F.col("sha") == F.col("edge_sha")), "left")
    keep = F.coalesce("best_keep", "keep")
    return out.select(
        shown_id(), F.when(keep != 2**63 - 1, keep).alias("keep_id"),
        F.coalesce("all", "members").alias("group_size"),
        (F.col("first") & (F.coalesce("best_part", "part") == F.col("part"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
