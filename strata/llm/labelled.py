"""A bounded, deterministic sample of labelled documents as hashed features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship, slices, utf8
from strata.llm.features import Rows, pack_rows, unpack_rows


def sample(docs: DataFrame, labels: DataFrame, columns: list[str], rows: int,
           featurise: Callable[[list[bytes]], Rows], seed: int = 7,
           ) -> tuple[np.ndarray, Rows, np.ndarray]:
    """(doc ids, features, label matrix) of at most ``rows`` labelled documents.

    Labels with a null id or a null in ``columns`` are left out; of conflicting
    labels of one document the largest of each column counts. The sample is the
    ``rows`` smallest seeded hashes of the ids, so it does not depend on layout.
    The chosen labels, ``rows`` at most, are broadcast; documents are read once. Of rows
    that share an id the one with the smallest text hash counts, whatever the layout.
    """
    ship(docs.sparkSession)
    clean = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           *[F.col(c).cast("int").alias(c) for c in columns]).dropna()
             .groupBy("doc_id").agg(*[F.max(c).alias(f"y{i}") for i, c in enumerate(columns)]))
    chosen = clean.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows)
    ys = [f"y{i}" for i in range(len(columns))]
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text"), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "doc_id").select("doc_id", *ys, F.xxhash64("text")
                                                         .alias("th"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("doc_id", *ys, "th")],
                     pack_rows(featurise(utf8(part)))], names=["doc_id", *ys, "th", "x"])

    schema = "doc_id long, " + "".join(f"{c} int, " for c in ys) + "th long, x binary"
    one = texts.mapInArrow(run, schema).groupBy("doc_id", *ys).agg(F.min_by("x", "th").alias("x"))
    got = one.orderBy("doc_id").toArrow()
    ids = got.column("doc_id").to_numpy()
    y = np.stack([got.column(c).to_numpy() for c in ys], axis=1).astype(float)
    return ids, unpack_rows(got.column("x").to_pylist()), y
