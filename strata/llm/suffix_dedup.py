"""Substring dedup by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of a document;
every word covered by a window whose words also start in a document with a
smaller id is removed, judged on the input.

1. Documents fold into classes of equal word sequences; only the smallest id of
   a class stays in play, and a copy of ``WINDOW`` words or more loses all.
2. Each window has an anchor, its leftmost smallest word ``GRAM``-gram by hash,
   so equal windows have equal anchors at equal places. An anchor gram found in
   one class only cannot begin a repeat: aggregation drops it, with its windows.
3. Suffixes that begin at the anchors left are split by their prefix: the
   anchor gram, ``GRAM`` words, as long as at most ``GROUP_ROWS`` suffixes share
   it. Each group is sorted into a suffix tree (suffix array and common-prefix
   lengths). A window of l words before its anchor is a node of depth WINDOW - l
   whose suffixes also agree in the l words before: a deep internal node, if it
   holds more than one class, and its smallest id is the window's first holder.
   Sorted groups stream through a task in pieces of bounded memory.
4. Prefixes shared by more suffixes are lengthened to the full ``WINDOW`` words
   of each window; such a suffix is a leaf run, of which only the smallest id
   matters, so equal surroundings are aggregated before they are lengthened and
   shuffled, and the result is joined back.

Words are compared by 64-bit hashes, 13 in a row.

Edge cases: null and empty texts have no words; texts under ``WINDOW`` words
lose none; a null id is the largest; repeated rows with one (doc_id, text) lose
the same words; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.llm.common import (LAST_ID, documents, drop_scratch, free_shuffles, fresh, ship,
                               shown_id, slices, utf8, written)
from strata.llm.features import mix

WINDOW = 13
GRAM = 6
#: Grams in a window, and so places an anchor can have in it.
PLACES = WINDOW - GRAM + 1
GROUP_ROWS = 20_000
#: Sorted suffixes that a task looks at together (a whole group at least).
STEP_ROWS = 60_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Codes(dict):
    """64-bit code of a word, remembered while the worker has room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_CODES = _Codes()


def codes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))


def grams_of(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` words from each place on."""
    n = len(codes) - GRAM + 1
    g = np.zeros(n, np.uint64)
    for j in range(GRAM):
        g = mix(g * np.uint64(0x9E3779B97F4A7C15) + codes[j:n + j])
    return g


def anchors_of(grams: np.ndarray) -> np.ndarray:
    """For each window the place of its anchor: its leftmost smallest gram."""
    view = np.lib.stride_tricks.sliding_window_view(grams, PLACES)
    return np.arange(len(view)) + view.argmin(axis=1)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: words, hash of the sequence, and the distinct anchors' places and grams."""
    for batch in batches:
        for part in slices(batch):
            out: list[list] = [[], [], [], [], []]
            for text in utf8(part):
                words = text.split()
                out[0].append(len(words))
                sha = hashlib.sha256(b" ".join(words)).digest()
                out[1].append(sha)
                at = np.zeros(0, np.int64)
                g = np.zeros(0, np.uint64)
                if len(words) >= WINDOW:
                    g = grams_of(codes_of(words))
                    at = np.unique(anchors_of(g))
                out[2].append(at.astype(np.int32))
                out[3].append(g[at].view(np.int64))
                out[4].append(int.from_bytes(sha[:8], "big", signed=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("th"), pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int32())),
                 pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.int64())],
                names=["doc_id", "th", "n_words", "sha", "places", "grams", "cls"])


SUFFIX = ("gram long, doc_id long, th long, places array<int>, before int, words binary, most int, "
          "n long")


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per live anchor: ``before`` words on its left, then its suffix, as word codes.

    Anchors of one document with equal surroundings share a row, which has their ``places``.
    ``most`` has a bit for each number l of words before the anchor at which a
    window with this anchor begins; ``n`` suffixes share the anchor's gram.
    """
    for batch in batches:
        for part in slices(batch):
            out: list[list] = [[] for _ in range(8)]
            for doc, th, text, live, shared in zip(
                    part.column("doc_id").to_pylist(), part.column("th").to_pylist(), utf8(part),
                    part.column("live"), part.column("shared"), strict=True):
                codes = codes_of(text.split())
                g = grams_of(codes)
                anchor = anchors_of(g)
                live = live.values.to_numpy()
                first = np.searchsorted(anchor, live)       # anchors ascend with their windows
                end = np.searchsorted(anchor, live, "right")
                raw = codes.astype(">u8").tobytes()
                rows: dict[tuple, list[int]] = {}
                for p, a, b, n in zip(live.tolist(), first.tolist(), end.tolist(),
                                      shared.as_py(), strict=True):
                    rows.setdefault((p - a, raw[8 * a:8 * (b - 1 + WINDOW)],
                                     sum(1 << (p - s) for s in range(a, b)), n), []).append(p)
                for (before, words, most, n), places in rows.items():
                    for k, v in enumerate((int(g[places[0]].view(np.int64)), doc, th, places,
                                           before, words, most, n)):
                        out[k].append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.binary(),
                     pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, types, strict=True)],
                names=["gram", "doc_id", "th", "places", "before", "words", "most", "n"])


def repeated_in(group: pa.Table) -> np.ndarray:
    """For each suffix of a table sorted by gram and suffix, the windows held by a smaller id.

    Bit l is set if the window that begins l words before the anchor repeats.
    """
    n = group.num_rows
    before = group.column("before").to_numpy()
    doc = group.column("doc_id").to_numpy()
    most = group.column("most").to_numpy()
    gram = group.column("gram").to_numpy()
    raw = group.column("words").to_pylist()
    size = np.fromiter((len(r) // 8 for r in raw), np.int64, n)
    flat = np.frombuffer(b"".join(raw), ">u8").astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    flat = np.append(flat, np.uint64(0))
    # suffix array: word codes from the anchor on; words past the end differ from row to row
    after = size - before
    suffix = np.empty((n, WINDOW), np.uint64)
    for j in range(WINDOW):
        suffix[:, j] = np.where(j < after, flat[np.minimum(start + before + j, len(flat) - 1)], 0)
    left = np.empty((n, PLACES), np.uint64)     # hash of the l words before the anchor
    left[:, 0] = 0
    for l in range(1, PLACES):
        word = flat[np.maximum(start + before - l, 0)]
        left[:, l] = mix(left[:, l - 1] * np.uint64(0x9E3779B97F4A7C15) + word)
    # common prefixes of neighbours: 0 where the gram changes
    same = np.ones((n, WINDOW + 1), bool)
    same[1:, 1:] = (suffix[1:] == suffix[:-1]) & (np.arange(WINDOW) < np.minimum(
        after[1:], after[:-1])[:, None])
    common = np.cumprod(same[:, 1:], axis=1).sum(axis=1)
    common[0] = 0
    common[1:][gram[1:] != gram[:-1]] = 0
    out = np.zeros(n, np.int32)
    for l in range(PLACES):
        rows = np.flatnonzero((most >> l) & 1)
        if not len(rows):
            continue
        node = np.cumsum(common < WINDOW - l)[rows]         # ancestor at depth WINDOW - l
        where = np.unique(mix(left[rows, l] ^ mix(node.astype(np.uint64))),
                          return_inverse=True)[1]
        least = np.full(where.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, where, doc[rows])
        out[rows[doc[rows] > least[where]]] |= 1 << l
    return out


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups at a time from a partition sorted by gram and suffix."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def solve(table: pa.Table):
        found = repeated_in(table)
        hit = np.flatnonzero(found)
        if not len(hit):
            return
        for batch in pa.table({
                "doc_id": table.column("doc_id").take(pa.array(hit)),
                "th": table.column("th").take(pa.array(hit)),
                "places": table.column("places").take(pa.array(hit)),
                "windows": pa.array(found[hit], pa.int32())}).combine_chunks().to_batches():
            yield batch

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= STEP_ROWS:
            table = pa.Table.from_batches(held).combine_chunks()
            gram = table.column("gram").to_numpy()
            whole = int(np.searchsorted(gram, gram[-1]))
            if whole:
                yield from solve(table.slice(0, whole).combine_chunks())
                table = table.slice(whole).combine_chunks()
            held, rows = table.to_batches(), table.num_rows
    if held:
        yield from solve(pa.Table.from_batches(held).combine_chunks())


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct surroundings of hot anchors: one row per window, by a 128-bit hash of its words."""
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for gram, around, doc, before, words, most in zip(
                *[batch.column(c).to_pylist()
                  for c in ("gram", "around", "doc_id", "before", "words", "most")], strict=True):
            for l in range(PLACES):
                if most >> l & 1:
                    a = 8 * (before - l)
                    for k, v in enumerate((gram, around, doc, 1 << l, xxhash.xxh3_128_digest(
                            words[a:a + 8 * WINDOW]))):
                        out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(
                out, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
            names=["gram", "around", "doc_id", "bit", "key"])


def _hot(suffixes: DataFrame) -> DataFrame:
    """Repeated windows at anchors whose prefix too many suffixes share.

    Suffixes with equal surroundings are aggregated first, to their smallest id;
    only distinct surroundings are lengthened to their windows.
    """
    hot = suffixes.withColumn("around", F.xxhash64("words", "before", "most"))
    key = ["gram", "around"]
    distinct = hot.groupBy(*key).agg(F.min("doc_id").alias("doc_id"), *[
        F.first(c).alias(c) for c in ("before", "words", "most")])
    windows = written(distinct.mapInArrow(
        _windows, "gram long, around long, doc_id long, bit int, key binary"), "suffix-hot")
    holder = windows.groupBy("key").agg(F.min("doc_id").alias("least"))
    firsts = windows.join(holder, "key").groupBy(*key).agg(
        F.collect_list(F.struct("bit", "least")).alias("firsts"))      # at most PLACES
    late = F.aggregate(F.filter("firsts", lambda x: F.col("doc_id") > x["least"]), F.lit(0),
                       lambda mask, x: mask + x["bit"])
    return (hot.select("doc_id", "th", "places", *key).join(firsts, key)
            .select("doc_id", "th", "places", late.alias("windows")).where("windows > 0"))


def covered(n_words: int, places, windows) -> np.ndarray:
    """Which words the repeated windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for l in range(PLACES):
        at = np.asarray(places)[(np.asarray(windows) >> l) & 1 > 0] - l
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).withColumn("th", F.xxhash64("text"))


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per document: doc_id, th, n_words, sha, copy; per document with repeats: places, windows).

    ``copy`` is true if a smaller id has the same words and there are WINDOW or
    more. The second table has one row per (doc_id, th) with arrays.
    """
    spark = docs.sparkSession
    ship(spark)
    d = _keyed(docs)
    scan = written(d.mapInArrow(_scan, "doc_id long, th long, n_words long, sha binary, "
                                       "places array<int>, grams array<long>, cls long")
                   .withColumn("row", F.monotonically_increasing_id()), "suffix-scan")
    # of equal sequences the smallest (id, text hash) stays in play
    first = written(scan.groupBy("sha").agg(F.min(F.struct("doc_id", "th", "row")).alias("f"))
                    .select("f.*"), "suffix-first")
    least = scan.groupBy("sha").agg(F.min("doc_id").alias("least"))
    heads = scan.select("doc_id", "th", "n_words", "sha").join(least, "sha")
    flags = written(heads.select("doc_id", "th", "n_words", "sha", (
        (F.col("doc_id") > F.col("least")) & (F.col("n_words") >= WINDOW)).alias("copy")),
        "suffix-docs")
    each = scan.select("row", "cls", F.explode(F.arrays_zip("places", "grams")).alias("z")).select(
        "row", "cls", F.col("z.places").alias("place"), F.col("z.grams").alias("gram"))
    # anchors of more than one class, with their number of occurrences
    live = written(each.groupBy("gram").agg(F.min("cls").alias("a"), F.max("cls").alias("b"),
                                            F.count("*").alias("n"))
                   .where("a < b").select("gram", "n"), "suffix-live")
    free_shuffles(spark)
    spots = written(each.select("row", "place", "gram").join(live, "gram").groupBy("row")
                    .agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("live"))
                    .join(first, "row").select(
                        "doc_id", "th", F.col("live.place").alias("live"),
                        F.col("live.n").alias("shared")), "suffix-spots")
    drop_scratch(scan)
    free_shuffles(spark)
    suffixes = written(d.join(spots, ["doc_id", "th"])
                       .mapInArrow(_suffixes, SUFFIX), "suffixes")
    free_shuffles(spark)
    tail = F.expr(f"substring(words, 8 * before + 1, {8 * WINDOW})")
    trees = (suffixes.where(F.col("n") <= GROUP_ROWS).withColumn("tail", tail)
             .repartition("gram").sortWithinPartitions("gram", "tail").drop("tail", "n")
             .mapInArrow(_trees, "doc_id long, th long, places array<int>, windows int"))
    late = _hot(suffixes.where(F.col("n") > GROUP_ROWS))
    found = (trees.union(late).groupBy("doc_id", "th")
             .agg(F.flatten(F.collect_list("places")).alias("places"),
                  F.flatten(F.collect_list(F.array_repeat("windows", F.size("places"))))
                  .alias("windows")))
    found = written(found, "suffix-repeats")
    drop_scratch(suffixes)
    free_shuffles(spark)
    return flags, found


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, shas = [], []
        for text, places, windows in zip(utf8(batch), batch.column("places"),
                                         batch.column("windows"), strict=True):
            words = text.split()
            gone = covered(len(words), places.values.to_numpy(), windows.values.to_numpy())
            removed.append(int(gone.sum()))
            shas.append(hashlib.sha256(b" ".join(
                [w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()),
             pa.array(shas, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def repeat_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per input row."""
    flags, found = repeats(docs)
    key = ["doc_id", "th"]
    touched = found.join(flags.where("NOT copy").dropDuplicates(key).select(*key, "n_words"), key)
    some = (_keyed(docs).join(touched, key)
            .select("doc_id", "text", "n_words", "places", "windows")
            .mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string"))
    rest = flags.join(touched.select(*key), key, "left_anti").select(
        "doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(0).alias("n_removed"),
        F.when(F.col("copy"), F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.lower(F.hex("sha"))).alias("kept_sha256"))
    return some.union(rest).withColumn("doc_id", shown_id())


def cut(text: str, copy: bool, places, windows) -> str:
    """The text without the covered words; white space stays around the words that stay."""
    raw = text.encode()
    starts = [m.start() for m in _WORD.finditer(raw)]
    if not starts:
        return text
    gone = np.ones(len(starts), bool) if copy else covered(len(starts), places, windows)
    starts[0] = 0       # white space goes with the word before it, at the start with the first
    return b"".join(raw[a:b] for a, b, g in zip(
        starts, [*starts[1:], len(raw)], gone.tolist(), strict=True) if not g).decode()


@F.pandas_udf(StringType())
def _cut(text: pd.Series, copy: pd.Series, places: pd.Series, windows: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or not (c or p is not None)
                      else cut(t, bool(c), p, w)
                      for t, c, p, w in zip(text, copy, places, windows, strict=True)],
                     dtype=object)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated words; all columns and rows stay.

    ``n_chars``, if there is such a column, becomes the new length.
    """
    flags, found = repeats(docs)
    key = ["doc_id", "th"]
    marks = (flags.where("copy").dropDuplicates(key).select(*key, "copy")
             .join(found, key, "full_outer"))
    names = [fresh(docs, f"repeat_{c}") for c in ("doc", "th", "copy", "places", "windows")]
    i, h, c, p, w = names
    keyed = docs.withColumns({i: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
                              h: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    out = keyed.join(marks.select(*key, "copy", "places", "windows").toDF(*names), [i, h], "left")
    changed = F.col(c).isNotNull() | F.col(p).isNotNull()
    out = out.withColumn("text", _cut(F.col("text"), F.coalesce(c, F.lit(False)), F.col(p),
                                      F.col(w)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def brute_force(texts: list[tuple[int, str]], window: int = WINDOW) -> dict[int, tuple]:
    """Reference result for small inputs: (n_words, n_removed, sha256) by id."""
    words = {d: t.encode().split() for d, t in texts}
    first: dict[tuple, int] = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i:i + window]), d)
    out = {}
    for d, ws in words.items():
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = [w for w, g in zip(ws, gone, strict=True) if not g]
        out[d] = (len(ws), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out
