"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 to K-1 share one vector of hashed-text weights and differ only by
ordered thresholds: ``P(grade >= k) = sigmoid(w . x - t_k)`` with ``t_1 < t_2 <
...``, kept in order by fitting the first threshold and the logs of the gaps.
A model is fitted on a bounded sample of rated rows (``SAMPLE_ROWS``, the
smallest seeded hashes of the ids) and then scores every whole text in Arrow
batches; selection uses a tail probability, the expected grade is returned too.

Edge cases: null and empty texts have no features and get the thresholds' own
probabilities; without ratings, or with one grade only, every document is kept
and its grade is that one (0 without any); no rows give no rows; repeated rows
get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import documents, ship, shown_id, slices, utf8
from strata.llm.features import Rows, hashed, log_unit, minimise, only, sigmoid, telling
from strata.llm.labelled import sample

BITS = 18
SAMPLE_ROWS = 4000
COLUMNS = 4096
PENALTY = 0.03
#: Documents are kept if P(grade >= KEEP_GRADE) is at least KEEP_TAIL.
KEEP_GRADE, KEEP_TAIL = 1, 0.5
#: Text bytes per vectorised step: arrays of this size stay in a core's cache.
STEP_BYTES = 300_000


class OrdinalModel(NamedTuple):
    """Selected columns, their shared weights and the ordered thresholds."""

    columns: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, features: Rows) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1, one row per text."""
        z = log_unit(only(features, self.columns)).dot(self.weights)
        return sigmoid(z[:, None] - self.thresholds[None, :])


def fit(features: Rows, grades: np.ndarray, columns: int = COLUMNS,
        penalty: float = PENALTY) -> OrdinalModel:
    """Fit by maximum likelihood with an L2 penalty on the weights."""
    present = np.unique(grades)
    if len(present) < 2:
        top = int(present[0]) if len(present) else 0
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.full(top, -35.0))
    last = int(present[-1])
    y = grades.astype(int)
    # telling about any of the splits "below k" against "k and above"
    chosen = [telling(features, (y >= k).astype(float), 1 << BITS, columns)
              for k in range(1, last + 1)]
    cols = np.unique(np.concatenate(chosen))
    rows = log_unit(only(features, cols))
    above = np.array([(y >= k).mean() for k in range(1, last + 1)])
    cut = -np.log((above + 1e-4) / (1 - above + 1e-4))
    gaps = np.log(np.maximum(np.diff(cut), 1e-2))
    size = len(cols)

    def spread(x):
        return x[size] + np.concatenate([[0.0], np.cumsum(np.exp(np.clip(x[size + 1:], -12, 6)))])

    def loss(x):
        t, z = spread(x), rows.dot(x[:size])
        tail = np.concatenate([np.ones((len(y), 1)), sigmoid(z[:, None] - t),
                               np.zeros((len(y), 1))], axis=1)
        at = np.arange(len(y))
        hi, lo = tail[at, y], tail[at, y + 1]
        p = np.maximum(hi - lo, 1e-12)
        # derivative of -log p by z, and by each threshold
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        dz = -(dhi - dlo) / p
        dt = np.zeros(last)
        np.add.at(dt, y[y > 0] - 1, (dhi / p)[y > 0])
        np.add.at(dt, y[y < last], -(dlo / p)[y < last])
        after = np.cumsum(dt[::-1])[::-1]
        gap = np.exp(np.clip(x[size + 1:], -12, 6))
        grad = np.concatenate([rows.back(dz, size) + penalty * x[:size],
                               [after[0]], after[1:] * gap])
        return -np.log(p).sum() + penalty / 2 * x[:size].dot(x[:size]), grad

    x = minimise(loss, np.concatenate([np.zeros(size), [cut[0]], gaps]))
    return OrdinalModel(cols, x[:size], spread(x))


def featurise(texts: list[bytes], keep: np.ndarray | None = None) -> Rows:
    return hashed(texts, BITS, pairs=False, keep=keep)


def train(docs: DataFrame, labels: DataFrame, grade: Column, rows: int = SAMPLE_ROWS,
          ) -> OrdinalModel:
    """Fit on at most ``rows`` rated documents; ``grade`` is an int column of ``labels``."""
    rated = labels.select("doc_id", grade.alias("grade"))
    _, x, y = sample(docs, rated, ["grade"], rows, featurise)
    return fit(x, y[:, 0])


def scorer(model: OrdinalModel):
    """A vectorised function of a text column: struct of expected_grade and tail.

    The model, at most ``COLUMNS`` columns per threshold, travels with the tasks.
    """
    @F.pandas_udf("expected_grade double, tail double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        keep = np.zeros(1 << BITS, bool)
        keep[model.columns] = True
        for texts in parts:
            raw = pa.RecordBatch.from_arrays(
                [pa.array([t or "" for t in texts], pa.string())], names=["text"])
            tails = [model.tails(featurise(utf8(part), keep))
                     for part in slices(raw, limit=STEP_BYTES)]
            t = np.concatenate([np.zeros((0, len(model.thresholds))), *tails])
            tail = t[:, KEEP_GRADE - 1] if t.shape[1] >= KEEP_GRADE else np.ones(len(t))
            yield pd.DataFrame({"expected_grade": t.sum(axis=1), "tail": tail})
    return run


def grades(docs: DataFrame, labels: DataFrame, grade: Column) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept), one row per input row."""
    model = train(docs, labels, grade)
    scored = documents(docs).select("doc_id", scorer(model)("text").alias("s"))
    return scored.select(shown_id(), "s.expected_grade", F.col("s.tail").alias("tail_probability"),
                         (F.col("s.tail") >= KEEP_TAIL).alias("kept"))


def select_good(docs: DataFrame, labels: DataFrame, grade: Column) -> DataFrame:
    """The rows of ``docs``, all columns, that the model keeps."""
    model = train(docs, labels, grade)
    return docs.where(scorer(model)(F.col("text"))["tail"] >= KEEP_TAIL)


def graded_labels() -> Column:
    """Rating of the labelled rows: 0 poor, 1 acceptable but toxic, 2 good; null without a quality."""
    q, t = F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))
    return F.when(q == 0, 0).when(q == 1, F.when(t == 1, 1).otherwise(2))
