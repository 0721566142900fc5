"""Importance resampling towards a target distribution, with length-bucketed CRC matrices.

A text's features are the runs of 1 to ``NGRAM`` consecutive folded words (see
:mod:`strata.llm.words`), joined by a space, repeats counted; a feature's bucket is
the unsigned CRC-32 of its bytes modulo ``BUCKETS``. The distinct features of a
slice of texts are grouped by length, each group is a two-dimensional array of
bytes, and all CRCs of a group advance together, column by column; the buckets
are then scattered back to the features and texts.

With s of the S features of all documents and t of the T of the target texts in a
bucket, its gain is floor(1000 ln((t+1)(S+BUCKETS) / ((s+1)(T+BUCKETS)))), in
doubles. A document's weight is the floored mean of its features' gains, 0 without
any. Its score adds floor(-1000 ln(-ln((h + 0.5) / 2**32))), Gumbel noise from the
first 32 bits h of sha256("SEED:doc_id"): the highest scores are a draw without
replacement in proportion to exp(weight / 1000).

Counts are added up in the tasks, ``BUCKETS`` rows reach the driver. Scores are whole
numbers in a bounded range (a logarithm of counts and of 32 bits), so a histogram
finds the lowest drawn one; the drawn rows alone are range-partitioned and numbered,
with no step in one partition.

Edge cases: a null or empty text has no features, weight 0 and is never drawn (fewer
than ``LEAST_WORDS`` words); the noise of a null doc_id comes from "SEED:", and it
loses ties; of rows that share an id and a score the smaller text hash comes first;
repeated rows are drawn one by one; without a target every gain compares with an
empty one; no documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import LAST_ID, documents, fresh, ship, shown_id, slices, utf8, written
from strata.llm.words import folded_words
from strata.operators.keys import surrogate_key

NGRAM = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
STEP_BYTES = 1_000_000


def _crc_table() -> np.ndarray:
    """What one byte does to the reflected CRC-32 remainder (polynomial 0xEDB88320)."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & 1, (r >> np.uint32(1)) ^ np.uint32(0xEDB88320), r >> np.uint32(1))
    return r


_CRC = _crc_table()


def crc32_all(features: list[bytes]) -> np.ndarray:
    """Unsigned CRC-32 of every feature, a matrix per length, a column at a time."""
    out = np.zeros(len(features), np.uint32)
    size = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for n, start, end in zip(lengths.tolist(), first, np.append(first[1:], len(order)), strict=False):
        rows = order[start:end]
        block = np.frombuffer(b"".join([features[r] for r in rows]), np.uint8).reshape(len(rows), n)
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(block.T):
            crc = _CRC[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
        out[rows] = ~crc
    return out


def bucketed(texts: list[bytes], ngram: int, buckets: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(words of each text, its features, the bucket of each feature in text order)."""
    n_words, n_features = [], []
    features: list[bytes] = []
    for t in texts:
        words = folded_words(t)
        before = len(features)
        features += words
        for k in range(2, ngram + 1):
            features += [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
        n_words.append(len(words))
        n_features.append(len(features) - before)
    distinct = list(set(features))
    place = dict(zip(distinct, range(len(distinct)), strict=True))
    at = np.fromiter(map(place.__getitem__, features), np.int64, len(features))
    return n_words, np.array(n_features, np.int64), (crc32_all(distinct) % np.uint32(buckets))[at]


def bucket_counts(texts: DataFrame, ngram: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                total += np.bincount(bucketed(utf8(part), ngram, buckets)[2], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    got = (texts.select("text").mapInArrow(run, "bucket long, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())       # a row per bucket
    out = np.zeros(buckets, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket from its counts in the source and in the target."""
    k = float(len(source))
    all_s, all_t = float(source.sum()) + k, float(target.sum()) + k
    return np.array([math.floor(1000.0 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(),
                                     strict=True)], np.int64)


def _weigher(gain: np.ndarray, ngram: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                words, n, bucket = bucketed(utf8(part), ngram, len(gain))
                ends = np.concatenate([[0], np.cumsum(gain[bucket])])
                stop = np.cumsum(n)
                weight = (ends[stop] - ends[stop - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(words, pa.int64()),
                     pa.array(n), pa.array(weight)],
                    names=[*kept, "n_words", "n_features", "weight"])
    return run


def weigh(docs: DataFrame, target: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS,
          seed: int = SEED, row: str | None = None) -> DataFrame:
    """(doc_id, th, n_words, n_features, weight, score), one row per row of ``docs``.

    ``th`` is ``xxhash64`` of the text, a null doc_id is ``LAST_ID``. ``row`` names a
    column of ``docs`` with a number for every row, which is returned too, as ``row``.
    """
    ship(docs.sparkSession)
    d = documents(docs)
    wanted = target.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gain = gains(bucket_counts(d, ngram, buckets), bucket_counts(wanted, ngram, buckets))
    if row is not None:
        d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.col(row).alias("row"))
    kept = [c for c in d.columns if c != "text"] + ["th"]
    weighed = d.withColumn("th", F.xxhash64("text")).mapInArrow(
        _weigher(gain, ngram, kept),
        ", ".join(f"{c} long" for c in [*kept, "n_words", "n_features", "weight"]))
    named = F.concat(F.lit(f"{seed}:"), F.when(F.col("doc_id") == LAST_ID, "").otherwise(
        F.col("doc_id").cast("string")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000.0 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return weighed.withColumn("score", F.col("weight") + noise)


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``weighed`` with ``rank``: 1, 2, 3 ... for the drawn rows, null for the others."""
    if "row" not in weighed.columns:
        weighed = weighed.withColumn("row", F.monotonically_increasing_id())
    rows = written(weighed, "draw-scores")
    fit = F.col("n_words") >= least_words
    histogram = rows.where(fit).groupBy("score").agg(F.count("*").alias("n")).toArrow()
    order = np.argsort(-histogram.column("score").to_numpy())
    running = np.cumsum(histogram.column("n").to_numpy()[order])
    wanted = int(running[-1]) * percent // 100 if len(running) else 0
    if not wanted:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    cut = int(histogram.column("score").to_numpy()[order][np.searchsorted(running, wanted)])
    high = fit & (F.col("score") >= cut)
    numbered = surrogate_key(rows.where(high).withColumn("down", -F.col("score")),
                             ["down", "doc_id", "th"], "rank", key_type="bigint",
                             unique_by=["row"]).drop("down")
    drawn = numbered.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return drawn.unionByName(rows.where(~high).withColumn(
        "rank", F.lit(None).cast("long")))


def draw_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per input row."""
    return draw(weigh(docs, target)).select(shown_id(), "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, ngram: int = NGRAM,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs``, all columns."""
    row = fresh(docs, "draw_row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "draw-rows")
    drawn = draw(weigh(rows, target, ngram, buckets, seed, row), percent)
    chosen = drawn.where("rank IS NOT NULL").select(F.col("row").alias(row))
    return rows.join(chosen, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def brute_force(docs: list[tuple], target: list[str | None], ngram: int = NGRAM,
                buckets: int = BUCKETS, percent: int = PERCENT) -> list[tuple]:
    """Reference result for small inputs with distinct ids."""
    import hashlib
    import zlib

    def places(text):
        w = folded_words((text or "").encode())
        return len(w), [zlib.crc32(b" ".join(w[i:i + k])) % buckets
                        for k in range(1, ngram + 1) for i in range(len(w) - k + 1)]

    source, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for table, texts in ((source, [t for _, t in docs]), (wanted, target)):
        for t in texts:
            np.add.at(table, places(t)[1], 1)
    gain = gains(source, wanted)
    rows = []
    for d, t in docs:
        n_words, at = places(t)
        weight = int(gain[at].sum()) // len(at) if at else 0
        h = int(hashlib.sha256(f"{SEED}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((d, n_words, len(at), weight, score))
    able = sorted([r for r in rows if r[1] >= LEAST_WORDS],
                  key=lambda r: (-r[4], LAST_ID if r[0] is None else r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return [(d, n, w, s, rank.get(d)) for d, _, n, w, s in rows]
