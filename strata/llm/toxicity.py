"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models on hashed words;
each later model also sees the probabilities of the earlier categories. In
training those are out-of-fold predictions (``FOLDS`` folds by a hash of the
id), so a later model learns how far it may trust an earlier one on texts the
earlier one has not seen. Put the category that flags a document last: its verdict
then rests on the words and on what all earlier links say. Training uses a bounded sample of labelled rows
(``SAMPLE_ROWS``); every whole text is scored in Arrow batches.

Edge cases: null and empty texts have no words and get the models' biases; a
category without both classes in the sample gets its smoothed share; repeated
rows get equal results; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import documents, ship, shown_id, slices, utf8
from strata.llm.features import Rows, fit_logistic, hashed, log_unit, only, sigmoid, telling
from strata.llm.labelled import sample

BITS = 18
SAMPLE_ROWS = 8000
COLUMNS = 512
PENALTY = 0.1
FOLDS = 5
THRESHOLD = 0.4
STEP_BYTES = 300_000


class Link(NamedTuple):
    """One category: its columns and weights (words, earlier categories, bias)."""

    columns: np.ndarray
    weights: np.ndarray

    def probability(self, features: Rows, earlier: np.ndarray) -> np.ndarray:
        x, k = log_unit(only(features, self.columns)), len(self.columns)
        return sigmoid(x.dot(self.weights[:k]) + earlier @ self.weights[k:-1] + self.weights[-1])


def _fit_link(features: Rows, y: np.ndarray, earlier: np.ndarray) -> Link:
    cols = (telling(features, y, 1 << BITS, COLUMNS) if len(np.unique(y)) == 2
            else np.zeros(0, np.int64))
    return Link(cols, fit_logistic(log_unit(only(features, cols)), y, len(cols), PENALTY, earlier))


def fit(ids: np.ndarray, features: Rows, labels: np.ndarray) -> list[Link]:
    """The chain for the columns of ``labels``, in their order."""
    fold = np.array([xxhash.xxh64_intdigest(str(i).encode(), 5) % FOLDS for i in ids], int)
    chain: list[Link] = []
    earlier = np.zeros((len(ids), 0))
    for k in range(labels.shape[1]):
        y = (labels[:, k] > 0).astype(float)
        chain.append(_fit_link(features, y, earlier))
        if k + 1 == labels.shape[1]:
            break
        unseen = np.zeros(len(ids))
        for f in range(FOLDS):
            out, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
            if len(out):
                link = _fit_link(features.take(rest), y[rest], earlier[rest])
                unseen[out] = link.probability(features.take(out), earlier[out])
        earlier = np.column_stack([earlier, unseen])
    return chain


def predict(chain: list[Link], features: Rows) -> np.ndarray:
    """Probabilities, one column per category, each fed to the next."""
    p = np.zeros((len(features.start) - 1, 0))
    for link in chain:
        p = np.column_stack([p, link.probability(features, p)])
    return p


def featurise(texts: list[bytes], keep: np.ndarray | None = None) -> Rows:
    return hashed(texts, BITS, pairs=False, keep=keep)


def categories(labels: DataFrame) -> DataFrame:
    """The categories that the labels tell apart: toxic prose, toxic junk, and toxic at all."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return labels.select("doc_id", (toxic & good).cast("int").alias("toxic_prose"),
                         (toxic & ~good).cast("int").alias("toxic_junk"),
                         toxic.cast("int").alias("toxic"))


def score(docs: DataFrame, labels: DataFrame, names: list[str],
          rows: int = SAMPLE_ROWS, flag: str = "toxic") -> DataFrame:
    """doc_id, a probability ``p_<name>`` per category and ``flagged``, one row per input row.

    ``labels`` has doc_id and an int column per category, in the chain's order;
    a document is flagged if the probability of ``flag``, one of them, reaches THRESHOLD.
    """
    ship(docs.sparkSession)
    ids, x, y = sample(docs, labels, names, rows, featurise)
    chain = fit(ids, x, y)
    outs = [f"p_{n}" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(1 << BITS, bool)
        for link in chain:
            keep[link.columns] = True
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                p = predict(chain, featurise(utf8(part), keep))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(p[:, k]) for k in range(len(outs))]],
                    names=["doc_id", *outs])

    schema = "doc_id long, " + ", ".join(f"{c} double" for c in outs)
    return documents(docs).mapInArrow(run, schema).select(
        shown_id(), *outs, (F.col(f"p_{flag}") >= THRESHOLD).alias("flagged"))
