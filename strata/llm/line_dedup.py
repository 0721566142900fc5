"""Fuzzy line dedup: MinHash, banding, exact Jaccard, distributed union-find.

Lines (split at ``\\n``, white space ``[\\x20\\x09-\\x0D]`` stripped) of at least
``LEAST_CHARS`` code points are sets of character shingles, ``SHINGLE`` code points
each, in every script. Equal lines fold into one id first. Every distinct line gets
``BANDS`` bands of ``ROWS`` minima; at Jaccard 0.8 a pair shares a band with
probability 0.995, and more above. Lines of a band are candidates: each is paired
with its bucket's first line and the two before it, which are all pairs
of up to ``ALL_PAIRS`` lines and a well connected chain of more. Candidates whose
exact Jaccard similarity reaches ``SIMILARITY`` are united.

The lines of larger buckets are crowded: an exact prefix-filter join finds every
other similar pair of them. Each line's shingles are put in one order, rare ones
first; a similar pair shares one among the first of both, and its positions
bound what else the two can share. Pairs that the chains have united are left
out, so a dense group is not squared, and a shingle of many lines is salted in
two dimensions.

A pair that shares many of its first shingles is made once for each of them but the
ones right behind another: if one of the two before is shared too, the pair is
known already.

Before the texts of such a pair are compared, it passes an exact filter: in a
line's sketch of ``SKETCH_BITS`` bits every shingle flips one. A bit that differs
between two sketches stands for a shingle that the lines do not share, so more
such bits than lines of that similarity may differ in rule the pair out.

Of each component the line that occurs first, by (doc_id, line number), stays,
and every other occurrence is removed.

Each task packs the (band, line) rows of its lines into one row for every part of the
bands, so that Spark moves few rows. Of a bucket with more than ``ALL_PAIRS + 1`` lines
in one chunk so many go on under its band and stand for it; the others go to buckets of
their own, ``CELL`` in each, together with these. So a bucket of any size is spread, its
lines hang together, and all of them count as crowded.

Shorter lines are alike only if they are equal: each is a component of its own,
with its copies. A changed inner character costs ``SHINGLE`` shingles, so a line
survives one from 79 code points on.

Edge cases: empty lines always stay; null and empty texts have no lines to remove; a null id is the largest; repeated rows keep and lose the same lines;
no rows give no rows. Line ids are 64-bit hashes of whole lines, shingles 64-bit
hashes of their code points.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.common import (LAST_ID, documents, drop_scratch, free_shuffles, fresh, ship,
                               shown_id, slices, utf8, written)
from strata.llm.components import components

SHINGLE = 8
LEAST_CHARS = 20
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
SPACE = b" \t\n\x0b\x0c\r"
#: Bytes of lines that one vectorised step works on: its arrays stay in a core's cache.
STEP_BYTES = 100_000
#: Lines of a bucket up to which the chain is all pairs.
ALL_PAIRS = 4
#: Bits of the number of counters (a byte each, on the driver and in tasks) that order shingles by
#: how many crowded lines have them: as many as the shingles ask for, within these.
LEAST_SLOT_BITS, MOST_SLOT_BITS = 16, 22
#: Bits of the number of bits that tell lines with a candidate, 16 for each of them within these;
#: when they fill up, more bodies than needed are shuffled.
LEAST_ID_BITS, MOST_ID_BITS = 16, 25
#: Lines with one shingle that are compared in one cell; more are salted.
CELL = 1000
SKETCH_BITS = 512
#: Bits of the marks by which a batch of pairs is filtered before shingles are compared one by one.
MARK_BITS = 2048
SKETCH = [f"sketch{i}" for i in range(SKETCH_BITS // 64)]
#: Distinct lines whose band keys are sorted and packed at a time; bytes of packed rows, in whole
#: buckets, that candidates are looked for in at a time.
CHUNK_LINES, BUCKET_BYTES = 50_000, 2_000_000
#: Bits of the number of parts that buckets are dealt out in.
LEAST_PART_BITS, MOST_PART_BITS = 10, 16
_RANDOM = np.random.default_rng(20240229)
_XOR = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MULTIPLY = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = _RANDOM.integers(0, 1 << 63, SHINGLE // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _grams(text: bytes) -> np.ndarray:
    """The shingle at each code point of a text that has one, as a 64-bit hash."""
    p = (np.frombuffer(text, np.uint8) if text.isascii()
         else np.frombuffer(text.decode().encode("utf-32-le"), "<u4")).astype(np.uint64)
    n = max(0, len(p) - SHINGLE + 1)
    if not n:
        return np.zeros(0, np.uint64)
    # two code points in 42 bits, then four such pairs in one product sum
    pair = p[:-1] | (p[1:] << np.uint64(21))
    out = pair[:n] * _FACTORS[0]
    for k in range(1, SHINGLE // 2):
        out += pair[2 * k:n + 2 * k] * _FACTORS[k]
    return out


def _spread(grams: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits of a multiplicative hash of shingles."""
    return (((grams ^ (grams >> np.uint64(32))) * _BASE) >> np.uint64(64 - bits)).astype(np.int64)


def shingles(line: bytes) -> np.ndarray:
    """The distinct shingles of a line, ascending, each as a 64-bit integer."""
    g = np.sort(_grams(line))
    return g[np.concatenate([[True], g[1:] != g[:-1]])] if g.size else g


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two ascending sets."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (a.size + b.size - both)


def long_lines(text: bytes, least: int = LEAST_CHARS) -> list[tuple[int, bytes]]:
    """(number, stripped line) of the lines of at least ``least`` code points."""
    return [(i, s) for i, x in enumerate(text.split(b"\n"))
            if len(s := x.strip(SPACE)) >= least
            and (s.isascii() or len(s) >= 4 * least or len(s.decode()) >= least)]


def _steps(items: list, size=len) -> Iterator[list]:
    """Consecutive parts of ``items`` with at most ``STEP_BYTES`` bytes (one item at least)."""
    start = total = 0
    for i, item in enumerate(items):
        n = size(item)
        if i > start and total + n > STEP_BYTES:
            yield items[start:i]
            start, total = i, 0
        total += n
    if start < len(items):
        yield items[start:]


def line_id(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line) - 2**63


def _grams_of(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all lines, one after another; how many each line has).

    Every line has ``SHINGLE`` code points at least; shingles that repeat in a line are repeated.
    """
    text = b"".join(lines)
    if text.isascii():
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    else:
        sizes = np.fromiter((len(x.decode()) for x in lines), np.int64, len(lines))
    g = _grams(text)
    whole = np.ones(len(g), bool)
    ends = np.cumsum(sizes)
    for j in range(1, SHINGLE):         # shingles across two lines
        whole[ends[:-1] - j] = False
    return g[whole], sizes - SHINGLE + 1


def band_keys(lines: list[bytes]) -> np.ndarray:
    """One row of ``BANDS`` 64-bit keys per line; all of at least ``SHINGLE`` code points."""
    g, n = _grams_of(lines)
    h = _spread(g, 32).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    keys = np.empty((len(lines), BANDS), np.uint64)
    mixed = np.empty_like(h)
    for b in range(BANDS):
        key = np.full(len(lines), b + 1, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            np.multiply(np.bitwise_xor(h, _XOR[k], out=mixed), _MULTIPLY[k], out=mixed)
            key = (key ^ np.minimum.reduceat(mixed, starts)) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(29)
        keys[:, b] = key
    return keys.view(np.int64)


def sketches(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(``SKETCH_BITS`` bits as 64-bit integers, a row per line; distinct shingles of each line)."""
    g, n = _grams_of(lines)
    row = np.repeat(np.arange(len(lines)), n)
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    odd = np.bincount(row * SKETCH_BITS + _spread(g, SKETCH_BITS.bit_length() - 1),
                      minlength=len(lines) * SKETCH_BITS) & 1
    bits = np.packbits(odd.astype(bool).reshape(-1, SKETCH_BITS), axis=1, bitorder="little")
    return bits.view(np.int64), np.bincount(row, minlength=len(lines))


def may_be_similar(s: list[bytes], t: list[bytes]) -> np.ndarray:
    """For each pair of lines whether it passes an exact filter; a similar pair always does.

    A bit marked in one line alone stands for a shingle that the lines do not share,
    and counts with repeats are no lower than those of distinct shingles.
    """
    def marks(lines):
        g, n = _grams_of(lines)
        out = np.zeros((len(lines), MARK_BITS), bool)
        out.reshape(-1)[np.repeat(np.arange(len(lines)) * MARK_BITS, n)
                        + _spread(g, MARK_BITS.bit_length() - 1)] = True
        return out, n

    (x, m), (y, n) = marks(s), marks(t)
    differ = np.count_nonzero(x != y, axis=1)
    return differ <= (1 - SIMILARITY) / (1 + SIMILARITY) * (m + n) + 1e-6


def _sketched(lines: DataFrame) -> DataFrame:
    """``lines`` (line, body and others) with each body's ``length`` in shingles and its sketch."""
    kept = lines.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", STEP_BYTES):
                bits, n = sketches(part.column("body").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n), *[pa.array(c) for c in bits.T]],
                    names=[*kept, "length", *SKETCH])

    schema = StructType([*lines.schema.fields,
                         *[StructField(c, LongType()) for c in ("length", *SKETCH)]])
    return lines.mapInArrow(run, schema)


def _may_be_similar(a: str, b: str, sizes: str) -> str:
    """SQL test of two sketches with the column prefixes a and b; never false for a similar pair."""
    differ = " + ".join(f"bit_count({a}{c} ^ {b}{c})" for c in SKETCH)
    return f"{differ} <= {(1 - SIMILARITY) / (1 + SIMILARITY)!r}D * ({sizes}) + 1e-6D"


def _occurrences(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [long_lines(t, least) for t in utf8(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("th"),
                     pa.array([[i for i, _ in x] for x in found], pa.list_(pa.int32())),
                     pa.array([[line_id(s) for _, s in x] for x in found], pa.list_(pa.int64()))],
                    names=["doc_id", "th", "numbers", "lines"])
    return run


def _bucket_rows(lines: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band, line) of every key of distinct lines, ascending by band as unsigned integers.

    Of a bucket with over ``ALL_PAIRS + 1`` lines so many keep its band, and every ``CELL`` of
    the others get one of their own together with these: all are in buckets that count as
    large, they hang together, and none of them holds more of one chunk.
    """
    bands, lines = keys.T.reshape(-1).view(np.uint64), np.tile(lines, keys.shape[1])
    order = np.argsort(bands)
    bands, lines = bands[order], lines[order]
    new = np.flatnonzero(np.concatenate([[True], bands[1:] != bands[:-1]]))
    few = ALL_PAIRS + 1
    sizes = np.diff(np.append(new, len(bands)))
    if not (sizes > few).any():
        return bands, lines
    large, more = new[sizes > few], sizes[sizes > few] - few
    head = np.repeat(large, more)
    nth = np.arange(len(head)) - np.repeat(np.cumsum(more) - more, more)
    tail = head + few + nth
    opens = nth % CELL == 0
    own = (bands[tail[opens]] ^ lines[tail[opens]].view(np.uint64) * _BASE) * _BASE
    rest = np.ones(len(bands), bool)
    rest[tail] = False
    bands, lines = (
        np.concatenate([bands[rest], own[np.cumsum(opens) - 1], np.repeat(own, few)]),
        np.concatenate([lines[rest], lines[tail],
                        lines[head[opens][:, None] + np.arange(few)].reshape(-1)]))
    order = np.argsort(bands)
    return bands[order], lines[order]


def _signatures(bits: int):
    """Buckets' rows as bytes, a row for each value of the leading ``bits`` bits of a band."""
    def packed(lines, keys):
        lines, first = np.unique(np.concatenate(lines), return_index=True)
        bands, lines = _bucket_rows(lines, np.concatenate(keys)[first])
        part = (bands >> np.uint64(64 - bits)).astype(np.int32)
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(at, len(part)).astype(np.int32) * 16
        rows = np.stack([bands.view(np.int64), lines], 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(part[at]), pa.BinaryArray.from_buffers(
                pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(rows)])],
            names=["part", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, size = [], [], 0
        for batch in batches:
            for part in slices(batch):
                lines = {line_id(s): s for t in utf8(part) for _, s in long_lines(t)}
                if lines:
                    ids.append(np.fromiter(lines, np.int64, len(lines)))
                    keys += [band_keys(x) for x in _steps(list(lines.values()))]
                    size += len(lines)
                if size >= CHUNK_LINES:
                    yield packed(ids, keys)
                    ids, keys, size = [], [], 0
        if size:
            yield packed(ids, keys)
    return run


def _bucket_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates among packed rows sorted by ``part``, which has its buckets whole."""
    def unpacked(held):
        rows = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
        rows = rows[np.argsort(rows[:, 0])]
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())],
                                          names=["band", "line"])

    def sorted_rows():
        held, size, last = [], 0, None
        for batch in batches:
            for part, rows in zip(batch.column("part").to_pylist(),
                                  batch.column("rows").to_pylist(), strict=True):
                if part != last and size >= BUCKET_BYTES:
                    yield unpacked(held)
                    held, size = [], 0
                held.append(rows)
                size, last = size + len(rows), part
        if held:
            yield unpacked(held)

    for out in _candidates(sorted_rows()):
        yield out.select(["a", "b"]).filter(pc.equal(out.column("edge"), 0))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a partition with the rows of a band together; its edge buckets as (band, first, last).

    A line of a bucket with more than ``ALL_PAIRS`` lines here is also paired with itself.
    Lines may repeat in a bucket; copies in one batch, or of a line held from the last, count once.
    """
    # of the bucket at hand: band, its first line here, the last two; whether it began the partition
    band = first = None
    last: list[int] = []
    opening = True
    # its lines so far, and the first of them
    size, early = 0, np.empty(0, np.int64)

    def out(a, b, kind, bands=None):
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()),
             pa.array([kind] * len(a), pa.int32()),
             pa.array([None] * len(a) if bands is None else bands, pa.int64())],
            names=["a", "b", "edge", "band"])

    for batch in batches:
        if not batch.num_rows:
            continue
        bands, lines = batch.column("band").to_numpy(), batch.column("line").to_numpy()
        if band is not None:        # carry the bucket at hand over: its first line and last two
            held = list(dict.fromkeys([first, *last]))
            bands = np.concatenate([np.full(len(held), band), bands])
            lines = np.concatenate([held, lines])
            done = len(held)
        else:
            done = 0
        # lines alone in their bucket go, but at the edges; the others in order, copies once
        same = bands[1:] == bands[:-1]
        keep = np.concatenate([[True], same]) | np.concatenate([same, [True]])
        keep[:done] = True
        bands, lines, fresh_rows = bands[keep], lines[keep], np.arange(len(keep))[keep] >= done
        bucket = np.cumsum(np.concatenate([[False], bands[1:] != bands[:-1]]))
        order = np.lexsort((lines, fresh_rows, bucket))
        bands, lines, fresh_rows = bands[order], lines[order], fresh_rows[order]
        once = np.ones(len(bands), bool)
        once[1:] = (bands[1:] != bands[:-1]) | (lines[1:] != lines[:-1])
        if done:
            once &= ~(fresh_rows & (bands == band) & np.isin(lines, held))
        bands, lines, fresh_rows = bands[once], lines[once], fresh_rows[once]
        new = np.flatnonzero(np.concatenate([[True], bands[1:] != bands[:-1]]))
        head = np.repeat(new, np.diff(np.append(new, len(bands))))
        at = np.arange(len(bands))
        a, b = [], []
        for back in (0, 1, 2):
            other = head if back == 0 else at - back
            ok = fresh_rows & (other >= head) & (other < at)
            a.append(lines[other[ok]])
            b.append(lines[at[ok]])
        a, b = np.concatenate(a), np.concatenate(b)
        if a.size:
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            yield out(pairs[:, 0], pairs[:, 1], 0)
        counts = np.add.reduceat(fresh_rows, new, dtype=np.int64)
        counts[0] += size
        crowded = lines[fresh_rows & np.repeat(counts > ALL_PAIRS, np.diff(np.append(new, len(bands))))]
        if counts[0] > ALL_PAIRS >= size:
            crowded = np.concatenate([early, crowded])
        if crowded.size:
            crowded = np.unique(crowded)
            yield out(crowded, crowded, 0)
        here = lines[new[-1]:][fresh_rows[new[-1]:]]
        early = (np.concatenate([early, here]) if len(new) == 1 else here)[:ALL_PAIRS]
        size = int(counts[-1])
        if opening and len(new) > 1:
            yield out([lines[0]], [lines[new[1] - 1]], 1, [int(bands[0])])
            opening = False
        band, first = int(bands[-1]), int(lines[new[-1]])
        last = [int(x) for x in lines[max(int(new[-1]), len(lines) - 2):]]
    if band is not None:
        yield out([first], [last[-1]], 1, [band])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = list(zip(utf8(batch, "s"), utf8(batch, "t"), strict=True))
        keep = []
        for part in _steps(pairs, lambda p: len(p[0]) + len(p[1])):
            known: dict[bytes, np.ndarray] = {}
            for pair, may in zip(part, may_be_similar(*map(list, zip(*part, strict=True))), strict=True):
                if may:
                    for text in pair:
                        if text not in known:
                            known[text] = shingles(text)
                    x, y = (known[text] for text in pair)
                    may = (min(x.size, y.size) >= SIMILARITY * max(x.size, y.size)
                           and jaccard(x, y) >= SIMILARITY)
                keep.append(bool(may))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])


def _slot_counts(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in slices(batch, "body", STEP_BYTES):
                at, n = np.unique(_spread(np.concatenate(
                    [shingles(x) for x in part.column("body").to_pylist()]), bits),
                    return_counts=True)
                total[at] += n
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])],
                                         names=["slot", "n"])
    return run


def _frequencies(lines: DataFrame) -> np.ndarray:
    """For each slot how frequent its shingles are, as thirds of a power of two.

    No count is capped; a slot shared by shingles only changes the order, not what is found.
    """
    size = lines.agg(F.coalesce(F.sum(F.length("body")), F.lit(0)).alias("n")).first()["n"]
    bits = min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, int(size).bit_length()))
    counted = lines.select("body").mapInArrow(_slot_counts(bits), "slot long, n long").groupBy(
        "slot").agg(F.rint(3 * F.log2(1 + F.sum("n"))).alias("level")).select(
        F.col("slot").cast("int"), F.least("level", F.lit(127.0)).cast("byte").alias("level"))
    got = counted.toArrow()
    out = np.zeros(1 << bits, np.int8)
    out[got.column("slot").to_numpy()] = got.column("level").to_numpy()
    return out


def _beyond(share: float, size: int) -> int:
    """How many of ``size`` ordered shingles must be looked at if ``share`` of them are shared."""
    return size - math.ceil(share * size - 1e-9) + 1


def _prefixes(often: np.ndarray):
    """The first shingles of each line, rare ones first, their positions and the two before.

    The larger line of a similar pair (``probe``) has a shared one among its
    first ``_beyond(SIMILARITY)``, the smaller (``index``) among fewer.
    """
    bits = len(often).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", STEP_BYTES):
                gram, sizes, lengths, index = [], [], [], []
                for body in part.column("body").to_pylist():
                    g = shingles(body)
                    n = _beyond(SIMILARITY, g.size)
                    gram.append(g[np.lexsort((g, often[_spread(g, bits)]))[:n]])
                    sizes.append(g.size)
                    lengths.append(n)
                    index.append(_beyond(2 * SIMILARITY / (1 + SIMILARITY), g.size))
                lengths = np.array(lengths)
                at = np.concatenate([np.arange(n) for n in lengths])
                row = pa.array(np.repeat(np.arange(part.num_rows), lengths))
                gram = np.concatenate(gram).view(np.int64)
                before = [pa.array(np.concatenate([gram[:k], gram[:-k]]), mask=at < k)
                          for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), *[part.column(c).take(row) for c in ("line", "component")],
                     *before, pa.array(np.repeat(sizes, lengths).astype(np.int32)),
                     pa.array(at.astype(np.int32)),
                     pa.array(at < np.repeat(index, lengths))],
                    names=["gram", "line", "component", "before1", "before2", "size", "at", "index"])
    return run


def crowded_pairs(lines: DataFrame) -> DataFrame:
    """(a, b): pairs of ``lines`` (line, body, component) that may be similar.

    Every similar pair of two components is among them.
    """
    spark = lines.sparkSession
    every = written(lines.select("line", "body", "component").mapInArrow(
        _prefixes(_frequencies(lines)), "gram long, line long, component long, before1 long, "
        "before2 long, size int, at int, index boolean"), "line-prefixes")
    # a shingle of one component leads to no new pair
    shared = every.groupBy("gram").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.ceil(F.count("*") / F.lit(CELL)).alias("salts")).where("lo < hi")
    rows = written(every.join(shared.select("gram", "salts"), "gram"), "line-shared")
    drop_scratch(every)
    free_shuffles(spark)
    own = F.pmod(F.xxhash64("line"), F.col("salts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))

    def side(df, mine, theirs, prefix, name):
        return df.select("gram", own.alias(mine), other.alias(theirs), F.col("line").alias(name),
                         *[F.col(c).alias(f"{prefix}{c}") for c in (
                             "component", "size", "at", "before1", "before2")])

    x = side(rows, "i", "j", "x", "b")
    y = side(rows.where("index"), "j", "i", "y", "a")
    t = SIMILARITY
    known = " OR ".join(f"coalesce(xbefore{i} = ybefore{j}, false)" for i in (1, 2) for j in (1, 2))
    # at the first shared shingle no more than what follows can be shared
    may = ("xcomponent <> ycomponent AND (ysize < xsize OR ysize = xsize AND a < b) "
           f"AND ysize >= {t}D * xsize - 1e-6D "
           f"AND least(xsize - xat, ysize - yat) >= {t / (1 + t)!r}D * (xsize + ysize) - 1e-6D "
           f"AND NOT ({known})")
    return (x.join(y, ["gram", "i", "j"]).where(may)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _marked(lines: DataFrame) -> np.ndarray:
    """A bit for each value of the leading bits of a line id, set for those of ``lines``.

    A set bit may stand for other lines too, the more the fuller the bits are.
    """
    bits = min(MOST_ID_BITS, max(LEAST_ID_BITS, (16 * lines.count()).bit_length()))
    got = lines.select(F.expr(f"shiftrightunsigned(line, {64 - bits})").alias("slot")).groupBy(
        F.expr("shiftright(slot, 3)").cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(slot & 7 AS int))")).cast("short").alias("byte")).toArrow()
    out = np.zeros(1 << bits - 3, np.uint8)
    out[got.column("at").to_numpy()] = got.column("byte").to_numpy()
    return out


def _texts(marked: np.ndarray):
    """Lines and their bodies, without those whose bit is not set."""
    down = np.uint64(64 - 3 - (len(marked).bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lines = {line_id(s): s for t in utf8(part) for _, s in long_lines(t)}
                ids = np.fromiter(lines, np.int64, len(lines))
                slot = ids.view(np.uint64) >> down
                has = (marked[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[has > 0]),
                     pa.array([s for s, h in zip(lines.values(), has.tolist(), strict=True) if h],
                              pa.binary())], names=["line", "body"])
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).withColumn("th", F.xxhash64("text"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar; ``texts`` has the body of each line.

    If it has sketches too, they rule pairs out before any body is compared.
    """
    drawn = [c for c in ("length", *SKETCH) if c in texts.columns]

    def side(name, body):
        return texts.select(F.col("line").alias(name), F.col("body").alias(body),
                            *[F.col(c).alias(f"{body}{c}") for c in drawn])

    both = pairs.join(side("a", "s"), "a").join(side("b", "t"), "b")
    if drawn:
        both = both.where(_may_be_similar("s", "t", "slength + tlength"))
    return both.select("a", "b", "s", "t").mapInArrow(_similar, "a long, b long")


def similar_lines(docs: DataFrame) -> DataFrame:
    """(a, b): verified links between ids of distinct lines."""
    spark = docs.sparkSession
    ship(spark)
    d = documents(docs)
    # band keys are hashes, so their leading bits deal the buckets out evenly
    wide = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(MOST_PART_BITS, max(LEAST_PART_BITS, wide.bit_length()))
    found = written(d.mapInArrow(_signatures(bits), "part int, rows binary").repartition("part")
                    .sortWithinPartitions("part").mapInArrow(_bucket_pairs, "a long, b long"),
                    "line-candidates")
    free_shuffles(spark)
    pairs = written(found.where("a <> b").distinct(), "line-pairs")
    crowded = written(found.where("a = b").select(F.col("a").alias("line")).distinct(),
                      "line-crowded")
    drop_scratch(found)
    wanted = written(pairs.select("a").union(pairs.select("b")).distinct().toDF("line"),
                     "line-wanted")
    texts = written(d.mapInArrow(_texts(_marked(wanted)), "line long, body binary")
                    .join(wanted, "line", "left_semi").dropDuplicates(["line"]), "line-texts")
    free_shuffles(spark)
    links = written(_verified(pairs, texts), "line-links")
    if crowded.isEmpty():
        return links
    among = (links.join(crowded.toDF("a"), "a", "left_semi")
             .join(crowded.toDF("b"), "b", "left_semi").select("a", "b"))
    united = components(among)
    lines = written(_sketched(
        crowded.join(texts, "line").join(united, F.col("line") == F.col("node"), "left")
        .select("line", "body", F.coalesce("component", "line").alias("component"))),
        "line-crowded-texts")
    free_shuffles(spark)
    return links.union(written(_verified(crowded_pairs(lines), lines), "line-links"))


def removed_lines(docs: DataFrame, short_copies: bool = True) -> DataFrame:
    """(doc_id, th, gone): line numbers to remove, for documents that lose any.

    Lines under ``LEAST_CHARS`` code points go if they repeat an earlier one exactly,
    or not at all without ``short_copies``. ``th`` is ``xxhash64`` of the text; a null id is ``LAST_ID``.
    """
    spark = docs.sparkSession
    ship(spark)
    found = components(similar_lines(docs))
    free_shuffles(spark)
    at = written(_keyed(docs).select("doc_id", "th", "text").mapInArrow(
        _occurrences(1 if short_copies else LEAST_CHARS),
        "doc_id long, th long, numbers array<int>, lines array<long>"), "lines")
    each = at.select("doc_id", "th", F.explode(F.arrays_zip("numbers", "lines")).alias("z")).select(
        "doc_id", "th", F.col("z.numbers").alias("number"), F.col("z.lines").alias("line"))
    # the lines that recur or have a component, each with its class: no other can go
    member = found.toDF("line", "class").union(
        found.select("component", F.col("component").alias("class")).distinct())
    named = written(each.select("line", F.lit(None).cast("long").alias("class")).union(member)
                    .groupBy("line").agg(F.max("class").alias("class"), F.count("*").alias("n"))
                    .where("class IS NOT NULL OR n > 1")
                    .select("line", F.coalesce("class", "line").alias("class")), "line-classes")
    # tables of their own, so that the joins are free to split the rows of a frequent line or class
    rows = written(each.join(named, "line").select("class", "doc_id", "th", "number"), "line-rows")
    free_shuffles(spark)
    first = written(rows.groupBy("class").agg(F.min(F.struct("doc_id", "th", "number")).alias("kept")),
                    "line-firsts")
    gone = (rows.join(first, "class")
            .where(F.struct("doc_id", "th", "number") != F.col("kept")))
    return gone.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("number")).alias("gone"))


def cut(text: str, gone) -> str:
    """The text without the lines of the given numbers."""
    if gone is None or not len(gone):
        return text
    numbers = set(gone)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in numbers)


@F.pandas_udf(StringType())
def _cut(text: pd.Series, gone: pd.Series) -> pd.Series:
    return pd.Series([t if t is None else cut(t, g) for t, g in zip(text, gone, strict=True)],
                     dtype=object)


def drop_lines(docs: DataFrame, short_copies: bool = True) -> DataFrame:
    """``docs`` with the removed lines cut out of ``text``; all columns and rows stay.

    ``n_chars``, if there is such a column, becomes the new length. Without
    ``short_copies`` lines under ``LEAST_CHARS`` code points all stay.
    """
    gone = removed_lines(docs, short_copies)
    i, h, g = (fresh(docs, x) for x in ("line_doc", "line_hash", "line_gone"))
    keyed = docs.withColumns({i: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
                              h: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    out = keyed.join(gone.toDF(i, h, g), [i, h], "left").withColumn(
        "text", _cut(F.col("text"), F.col(g)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(g).isNotNull(), F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = batch.column("text").to_pylist(), batch.column("gone").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"),
             pa.array([t.count("\n") + 1 for t in texts], pa.int64()),
             pa.array([len(g or ()) for g in gone], pa.int64()),
             pa.array([digest(cut(t, g)) for t, g in zip(texts, gone, strict=True)], pa.string())],
            names=["doc_id", "n_lines", "n_removed", "kept_sha256"])


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256), one row per input row."""
    d = _keyed(docs).join(removed_lines(docs), ["doc_id", "th"], "left")
    return d.select("doc_id", "text", "gone").mapInArrow(
        _report, "doc_id long, n_lines long, n_removed long, kept_sha256 string").select(
        shown_id(), "n_lines", "n_removed", "kept_sha256")


def brute_force(texts: list[tuple[int, str]]) -> dict[int, str]:
    """Reference result for small inputs: every pair of lines is compared, short ones as a whole."""
    occurrences = [(d, i, s) for d, t in sorted(texts) for i, s in long_lines(t.encode(), 1)]
    bodies = sorted({s for _, _, s in occurrences}, key=lambda s: (len(s.decode()) < LEAST_CHARS, s))
    sets = [shingles(s) for s in bodies if len(s.decode()) >= LEAST_CHARS]
    root = list(range(len(bodies)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= SIMILARITY:
                root[max(find(i), find(j))] = min(find(i), find(j))
    seen, gone = set(), set()
    for d, i, s in occurrences:
        c = find(bodies.index(s))
        if c in seen:
            gone.add((d, i))
        seen.add(c)
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
            for d, t in texts}


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
