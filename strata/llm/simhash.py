"""SimHash near-dedup by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius (itself
and, for radius 2, its 64 one-bit neighbours); two fingerprints within the
radius share a variant half-way. Variants are aggregated in Spark; a variant's
bucket holds at most 65 fingerprints (a ball of radius 1 has no more), whatever
the data. Colliding pairs are made distinct and verified by bit distance, then
united by distributed union-find. Copies fold into one fingerprint first.

Edge cases: null, empty and word-free texts have fingerprint zero and are
linked like any other; a null id is the largest; repeated rows get equal rows;
no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (LAST_ID, documents, fresh, ship, shown_id, slices, utf8,
                               written)
from strata.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
_BLOCK = 200_000


def fingerprints_of(texts: list[bytes], shingle: int) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text."""
    hash64 = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for k, text in enumerate(texts):
        words = text.lower().split()      # bytes: ASCII letters and ASCII white space only
        if not words:
            continue
        n = max(1, len(words) - shingle + 1)
        joined = b" ".join(words)
        ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
        starts = [0] + [e + 1 for e in ends[:-1]]
        ends = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
        h = np.fromiter((hash64(joined[s:e], SEED)
                         for s, e in zip(starts, ends, strict=False)), np.uint64, n)
        ones = np.zeros(64, np.int64)
        for at in range(0, n, _BLOCK):
            bits = np.unpackbits(h[at:at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8),
                                 axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
    return out


def _fingerprint(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names],
                     pa.array(fingerprints_of(utf8(part), shingle).view(np.int64))],
                    names=[*names, "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    ship(docs.sparkSession)
    return documents(docs).mapInArrow(_fingerprint(shingle), "doc_id long, fp long")


def _ball(name: str, radius: int):
    """All values within ``radius`` bits of column ``name``."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1)
             for bits in combinations(range(64), r)]
    return F.array(*[F.col(name).bitwiseXOR(F.lit(m - (1 << 64) if m >> 63 else m).cast("long"))
                     for m in masks])


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints of column ``fp`` within ``max_bits`` bits.

    Members of one bucket are linked to its smallest one: they are at most
    ``2 * ceil(max_bits / 2)`` bits apart, and for an even radius every such
    pair is a link itself, so none is lost. An odd radius would need all pairs
    of a bucket and is refused.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    half = max_bits // 2
    # each fingerprint becomes many variants: spread by value, not as the table's files happen to be
    variants = fps.select("fp").repartition("fp").select(F.explode(_ball("fp", half)).alias("variant"), "fp")
    buckets = written(variants.groupBy("variant").agg(
        F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n")).where("n > 1"),
        "simhash-buckets")
    # members between the smallest and largest: look the bucket's ball up again
    inner = (buckets.where("n > 2").select("a", "b", F.explode(_ball("variant", half)).alias("fp"))
             .where("fp > a AND fp < b").join(fps.select("fp"), "fp")
             .select("a", F.col("fp").alias("b")))
    return (buckets.select("a", "b").union(inner).distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))


def _rooted(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, doc, root): each fingerprint of ``rows``, its smallest id, its component."""
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("doc")), "simhash-distinct")
    found = components(near_links(fps, max_bits))
    return (fps.join(found, F.col("fp") == F.col("node"), "left")
            .select("fp", "doc", F.coalesce("component", "fp").alias("root")))


def near_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row."""
    rows = written(fingerprints(docs, shingle), "simhash")
    rooted = _rooted(rows, max_bits)
    least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return (rows.join(named, "fp")
            .select(shown_id(), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    shown_id("component_id")))


def first_rows(docs: DataFrame, shingle: int = SHINGLE_WORDS,
               max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component, all columns: the one with the smallest id.

    Rows are told apart by a hash of all columns, which also orders rows that
    share an id or have none; of rows equal in every column one stays.
    """
    ship(docs.sparkSession)
    i, h, n = (fresh(docs, x) for x in ("simhash_doc", "simhash_row", "simhash_copies"))
    whole = F.xxhash64(*[c for x in docs.columns for c in (F.col(x), F.col(x).isNull())])
    keyed = docs.withColumns({i: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), h: whole})
    rows = written(
        keyed.select(F.col(i).alias("doc_id"), F.col(h).alias("row"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .mapInArrow(_fingerprint(shingle), "doc_id long, row long, fp long"), "simhash")
    first = written(
        rows.groupBy("doc_id", "row", "fp").agg(F.count("*").alias("n"))
        .join(_rooted(rows, max_bits).select("fp", "root"), "fp")
        .groupBy("root").agg(F.min(F.struct("doc_id", "row", "n")).alias("kept"))
        .select("kept.*"), "simhash-first").toDF(i, h, n)
    once = keyed.join(first.where(F.col(n) == 1), [i, h], "left_semi")
    copies = keyed.join(first.where(F.col(n) > 1), [i, h], "left_semi").dropDuplicates([i, h])
    return once.union(copies).select(*docs.columns)
