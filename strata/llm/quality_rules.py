"""Quality rules: exact text counts and a calibrated hashed n-gram classifier.

The counts are of whole texts: words ``[^\\x20\\x09-\\x0D]+``, their code points,
symbols ``[#*$%&|<>]``, lines (split at ``\\n``, with a word) equal to an earlier
line, and words in 3-word windows that occur twice or more. A text fails the
base rules if it has fewer than 50 words or more than half of them repeat.

The classifier is a logistic regression on hashed words, word pairs and
character n-grams, trained on a bounded sample of labelled rows
(``SAMPLE_ROWS``). A fifth of the sample, chosen by a hash of the id, is held
out of the fit and calibrates the scores (Platt scaling); every text is then
scored in Arrow batches against the fixed threshold ``THRESHOLD``.

Edge cases: null and empty texts have zero counts and fail; without labels, or
with one class, the probability is that class's smoothed share; repeated rows
get equal results; no rows give no rows.
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
from strata.llm.features import (Rows, fit_logistic, hashed, log_unit, only, sigmoid, telling)
from strata.llm.labelled import sample

BITS = 18
SAMPLE_ROWS = 4000
COLUMNS = 4096
PENALTY = 0.03
THRESHOLD = 0.5
LEAST_WORDS = 50
STEP_BYTES = 300_000
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(set(range(256)) - set(SYMBOLS))
#: Bytes that do not begin a code point.
_CONTINUED = bytes(range(0x80, 0xC0))
SPACE = b" \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts_of(text: bytes) -> tuple[int, int, int, int, int]:
    """The values of :data:`COUNTS` for one text in UTF-8."""
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, SPACE + _CONTINUED))
    symbols = len(text.translate(None, _NOT_SYMBOL))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= 4:
        number: dict[bytes, int] = {}
        code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        pair = np.unique(code[:-1] * len(number) + code[1:], return_inverse=True)[1]
        triple = pair[:-1] * len(number) + code[2:]
        _, where, size = np.unique(triple, return_inverse=True, return_counts=True)
        often = size[where] > 1
        covered = np.zeros(n, bool)
        for j in range(3):
            covered[j:n - 2 + j] |= often
        repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


class CalibratedModel(NamedTuple):
    """Selected columns, weights with the bias last, and Platt's slope and shift."""

    columns: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, features: Rows) -> np.ndarray:
        z = log_unit(only(features, self.columns)).dot(self.weights[:-1]) + self.weights[-1]
        return sigmoid(self.slope * z + self.shift)


def featurise(texts: list[bytes], keep: np.ndarray | None = None) -> Rows:
    return hashed(texts, BITS, chars=True, keep=keep)


def fit(ids: np.ndarray, features: Rows, y: np.ndarray) -> CalibratedModel:
    """Fit on four fifths of the rows, calibrate on the fifth chosen by a hash of the id."""
    held = np.array([xxhash.xxh64_intdigest(str(i).encode(), 11) % 5 == 0 for i in ids], bool)
    if held.all() or not held.any() or len(np.unique(y[~held])) < 2:
        held[:] = False
    fitted = np.flatnonzero(~held)
    cols = (telling(features.take(fitted), y[fitted], 1 << BITS, COLUMNS)
            if len(np.unique(y[fitted])) == 2 else np.zeros(0, np.int64))
    rows = log_unit(only(features, cols))
    w = fit_logistic(rows.take(fitted), y[fitted], len(cols), PENALTY)
    slope, shift = 1.0, 0.0
    if held.any() and len(np.unique(y[held])) == 2:
        z = rows.take(np.flatnonzero(held)).dot(w[:-1]) + w[-1]
        # Platt's smoothed targets keep a separable held-out part from an endless slope
        pos, neg = y[held].sum(), (1 - y[held]).sum()
        target = np.where(y[held] > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        slope, shift = _platt(z, target)
    return CalibratedModel(cols, w, slope, shift)


def _platt(z: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * z + b)
        r, v = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([r @ z, r.sum()])
        h = np.array([[(v * z) @ z, v @ z], [v @ z, v.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    # a slope that is not positive would turn the scores around
    return (float(a), float(b)) if a > 0 and np.isfinite([a, b]).all() else (1.0, 0.0)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> CalibratedModel:
    ids, x, y = sample(docs, labels, ["quality"], rows, featurise)
    return fit(ids, x, (y[:, 0] > 0).astype(float))


def rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, probability and kept, one row per input row."""
    ship(docs.sparkSession)
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(1 << BITS, bool)
        keep[model.columns] = True
        for batch in batches:
            for part in slices(batch, limit=STEP_BYTES):
                texts = utf8(part)
                counts = np.array([counts_of(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(counts[:, k]) for k in range(len(COUNTS))],
                     pa.array(model.probability(featurise(texts, keep)))],
                    names=["doc_id", *COUNTS, "probability"])

    schema = "doc_id long, " + "".join(f"{c} long, " for c in COUNTS) + "probability double"
    out = documents(docs).mapInArrow(run, schema)
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return out.select(shown_id(), *COUNTS, failed.alias("base_failed"),
                      (~failed & (F.col("probability") >= THRESHOLD)).alias("kept"),
                      "probability")
