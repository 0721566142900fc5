"""Hashed text features in vectorised form, and sparse linear algebra for fitting.

A text is a run of tokens: words (ASCII letters, digits, ``_`` and all bytes
from 0x80) in lower case, and runs of other visible bytes. Features, hashed into
``2 ** bits`` columns: words, pairs of neighbouring tokens, bytes three and four
in a row (characters of a word and its surroundings), and one fixed column for
a word that repeats the one before it. Texts are hashed whole, as one array per
slice; no per-token Python runs.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_WORD = np.zeros(256, np.uint8)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1
_WORD[[c for c in range(33, 127) if not _WORD[c]]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 21)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.cumprod(
            np.full(size, b, np.uint64), dtype=np.uint64)]) for b in (_BASE, inverse)]
    return _POWERS[0][:n + 1], _POWERS[1][:n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rows(NamedTuple):
    """Sparse rows: ``index`` and ``value`` of row r are those from ``start[r]`` to ``start[r+1]``."""

    start: np.ndarray
    index: np.ndarray
    value: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.value * w[self.index])])
        return sums[self.start[1:]] - sums[self.start[:-1]]

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, self.value * np.repeat(r, np.diff(self.start)), size)

    def take(self, rows: np.ndarray) -> Rows:
        counts = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.start[:-1][rows] - start[:-1], counts) + np.arange(start[-1])
        return Rows(start, self.index[at], self.value[at])


def hashed(texts: list[bytes], bits: int, pairs: bool = True, chars: bool = False,
           keep: np.ndarray | None = None) -> Rows:
    """Counts of hashed features, one sparse row per text, indexes ascending in a row.

    ``keep`` is a table of the columns wanted; others are left out early.
    """
    n_docs, mask = len(texts), np.uint64((1 << bits) - 1)
    a = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    if not n_docs or not len(a):
        return Rows(np.zeros(n_docs + 1, np.int64), np.zeros(0, np.int64), np.zeros(0))
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, n_docs) + 1)])
    low, kind = _LOWER[a], _WORD[a]
    edge = np.flatnonzero(np.diff(kind, prepend=np.uint8(0), append=np.uint8(0)))
    s, e = edge[:-1], edge[1:]
    real = kind[s] != 0
    s, e = s[real], e[real]
    up, down = _powers(len(a))
    total = np.concatenate([[np.uint64(0)], np.cumsum(
        (low.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)])
    h = mix((total[e] - total[s]) * down[s])
    doc = np.searchsorted(begin, s, "right") - 1
    keys, docs = [], []

    def add(key, doc_of, at):
        key = key & mask
        if keep is not None:
            wanted = np.flatnonzero(keep[key])
            key, at = key[wanted], at[wanted]
        keys.append(key)
        docs.append(doc_of(at))

    each = np.arange(len(h))
    add(h, lambda at: doc[at], each)
    if len(h) > 1:
        same_doc = doc[1:] == doc[:-1]
        if pairs:
            later = each[1:][same_doc]
            add(mix(h[later - 1] * np.uint64(3) + h[later]), lambda at: doc[at], later)
        again = each[1:][same_doc & (h[1:] == h[:-1]) & (kind[s[1:]] == 1)]
        add(np.zeros(len(again), np.uint64), lambda at: doc[at], again)   # a repeated word
    if chars:
        x, gap = low.astype(np.uint64), a == 0
        for n in (3, 4):
            size = len(a) - n + 1
            if size <= 0:
                continue
            gram, cut = x[:size].copy(), gap[:size].copy()
            for j in range(1, n):
                gram = (gram << np.uint64(8)) | x[j:size + j]
                cut |= gap[j:size + j]
            at = np.flatnonzero(~cut)
            add(mix(gram[at] + np.uint64(n << 56)),
                lambda at: np.searchsorted(begin, at, "right") - 1, at)
    key = np.sort((np.concatenate(docs).astype(np.uint64) << np.uint64(bits)) | np.concatenate(keys))
    new = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    count = np.diff(new, append=len(key)).astype(float)
    key = key[new]
    start = np.searchsorted(key, np.arange(n_docs + 1).astype(np.uint64) << np.uint64(bits))
    return Rows(start, (key & mask).astype(np.int64), count)


def telling(rows: Rows, y: np.ndarray, size: int, most: int, least_docs: int = 3) -> np.ndarray:
    """The ``most`` columns whose presence tells most about ``y`` (chi-square), ascending.

    Columns in fewer than ``least_docs`` rows are left out; ties go to the smaller index.
    """
    n, pos = len(y), y.sum()
    df = np.bincount(rows.index, minlength=size).astype(float)
    both = np.bincount(rows.index, np.repeat(y, np.diff(rows.start)), size)
    gap = both * n - df * pos
    score = gap * gap * n / np.maximum(df * (n - df) * pos * (n - pos), 1e-9)
    score[df < least_docs] = -1
    best = np.argsort(-score, kind="stable")[:most]
    return np.sort(best[score[best] > 0])


def only(rows: Rows, columns: np.ndarray) -> Rows:
    """The given ascending columns, renumbered from 0; the others are dropped."""
    at = np.searchsorted(columns, rows.index)
    hit = (at < len(columns)) & (np.append(columns, -1)[at] == rows.index)
    ends = np.concatenate([[0], np.cumsum(hit)])
    return Rows(ends[rows.start], at[hit], rows.value[hit])


def log_unit(rows: Rows) -> Rows:
    """Log counts, each row scaled to length one."""
    v = np.log1p(rows.value)
    norm = np.sqrt(np.bincount(rows.row, v * v, len(rows.start) - 1))
    return rows._replace(value=v / np.repeat(np.maximum(norm, 1e-12), np.diff(rows.start)))


def present(rows: Rows) -> Rows:
    """One for every feature that occurs."""
    return rows._replace(value=np.ones(len(rows.value)))


def pack_rows(rows: Rows) -> pa.Array:
    """Each sparse row as bytes: its indexes (32 bits), then its values (32-bit floats)."""
    index, value = rows.index.astype("<u4"), rows.value.astype("<f4")
    return pa.array([index[a:b].tobytes() + value[a:b].tobytes()
                     for a, b in zip(rows.start[:-1], rows.start[1:], strict=True)], pa.binary())


def unpack_rows(packed: list[bytes]) -> Rows:
    index = [np.frombuffer(p, "<u4", len(p) // 8) for p in packed]
    value = [np.frombuffer(p, "<f4", offset=len(p) // 2) for p in packed]
    start = np.concatenate([[0], np.cumsum([len(i) for i in index], dtype=np.int64)]).astype(np.int64)
    return Rows(start, np.concatenate([*index, np.zeros(0, "<u4")]).astype(np.int64),
                np.concatenate([*value, np.zeros(0, "<f4")]).astype(float))


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray,
             rounds: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with a halving line search; ``loss`` gives value and gradient."""
    f, g = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        d, alphas = g.copy(), []
        for s, y, r in reversed(steps):
            alphas.append(r * s.dot(d))
            d -= alphas[-1] * y
        if steps:
            s, y, r = steps[-1]
            d *= 1 / (r * y.dot(y))
        for (s, y, r), a in zip(steps, reversed(alphas), strict=True):
            d += (a - r * y.dot(d)) * s
        slope, t = g.dot(d), 1.0 if steps else 1 / max(1.0, float(np.abs(g).sum()))
        if slope <= 1e-12:
            break
        for _ in range(30):
            f2, g2 = loss(x - t * d)
            if f2 <= f - 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, y = -t * d, g2 - g
        if (sy := s.dot(y)) > 1e-12:
            steps = [*steps, (s, y, 1 / sy)][-memory:]
        x, done = x + s, abs(f - f2) <= 1e-7 * max(1.0, abs(f))
        f, g = f2, g2
        if done:
            break
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(rows: Rows, y: np.ndarray, size: int, penalty: float = 1.0,
                 extra: np.ndarray | None = None) -> np.ndarray:
    """Weights, then one for each column of ``extra`` (dense), then the bias.

    L2-penalised logistic regression; classes weigh as they come. With one class
    only, the weights are zero and the bias is that class's log odds, smoothed.
    """
    extra = np.zeros((len(y), 0)) if extra is None else extra
    k = extra.shape[1]
    base = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    x0 = np.zeros(size + k + 1)
    x0[-1] = base
    if len(y) == 0 or y.min() == y.max():
        return x0

    def loss(x):
        z = rows.dot(x[:size]) + extra @ x[size:size + k] + x[-1]
        r = sigmoid(z) - y
        w = x.copy()
        w[-1] = 0
        f = np.logaddexp(0, np.where(y > 0, -z, z)).sum() + penalty / 2 * w.dot(w)
        return f, np.concatenate([rows.back(r, size), extra.T @ r, [r.sum()]]) + penalty * w
    return minimise(loss, x0)
