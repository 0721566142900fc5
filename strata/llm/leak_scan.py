"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Texts are folded (A-Z to lower case) and read as words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: letters and digits of ASCII and all
characters beyond it. A window is ``WINDOW`` consecutive words of an item; an item
with fewer words, but not none, is one window. The automaton's alphabet is the
items' words, its patterns are the windows, so a document is scanned once, word
by word, whatever the number of items. Folding keeps every byte in its place, so
a hit's words lead straight back to character offsets of the original text.

An automaton holds ``BLOCK_WINDOWS`` windows (or ``BLOCK_BYTES`` of them) at most.
A test set within that, which is the usual case, needs one automaton and one pass
without a shuffle. A larger one is cut by a hash of (window, item) into blocks;
each block scans all documents, and what the blocks found is united per document.

Edge cases: a null or empty text has no words and is clean; an item without words
has no windows; items that share an id count as one; hits of an item without an id
count as hits, but not among the items; a null doc_id stays null; repeated rows
get equal results; no documents give no rows, no items leave every document clean.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import documents, ship, shown_id, slices, utf8, written
from strata.llm.words import fold, folded_words

WINDOW = 10
#: (window, item) pairs, and bytes of windows, that one automaton may hold.
BLOCK_WINDOWS = 100_000
BLOCK_BYTES = 32_000_000
_RUN = re.compile(rb"[^ ]+")
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def windows_of(words: list[bytes], window: int = WINDOW) -> set[bytes]:
    """The distinct windows of an item, each as words joined by a space."""
    if not words:
        return set()
    return {b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))}


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item string, body binary): the distinct windows of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids, bodies = [], []
                for item, text in zip(part.column("item").to_pylist(), utf8(part), strict=True):
                    found = windows_of(folded_words(text), window)
                    ids += [item] * len(found)
                    bodies += found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(bodies, pa.binary())],
                    names=["item", "body"])

    texts = items.select(F.col("item_id").cast("string").alias("item"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "item string, body binary").distinct()


class Automaton:
    """Windows of one block as a word automaton."""

    def __init__(self, items: list[str | None], bodies: list[bytes]) -> None:
        import ahocorasick
        self._code: dict[bytes, int] = {}
        self._items: list[list[str]] = []
        place: dict[bytes, int] = {}
        self._auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for item, body in zip(items, bodies, strict=True):
            if body not in place:
                place[body] = len(self._items)
                self._items.append([])
                # 0 is the code of every word that no item has
                key = tuple(self._code.setdefault(w, len(self._code) + 1) for w in body.split(b" "))
                self._auto.add_word(key, (len(key), place[body]))
            if item is not None:
                self._items[place[body]].append(item)
        if self._items:
            self._auto.make_automaton()

    def hits(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """(first, last + 1 of each run of hit words, one after another; items)."""
        if not self._items or not words:
            return [], set()
        code = self._code.get
        runs: list[int] = []
        seen: set[int] = set()
        for end, (size, place) in self._auto.iter(tuple([code(w, 0) for w in words])):
            seen.add(place)
            first = end - size + 1
            while runs and first <= runs[-1]:       # ends ascend: only the last runs can touch
                first = min(first, runs[-2])
                del runs[-2:]
            runs += [first, end + 1]
        return runs, {i for p in seen for i in self._items[p]}


_LOADED: dict[bytes, Automaton] = {}


def _automaton(key: bytes, table: bytes) -> Automaton:
    """This worker's automaton of a block; one at a time is held."""
    if key not in _LOADED:
        _LOADED.clear()
        block = pa.ipc.open_stream(table).read_all()
        _LOADED[key] = Automaton(block.column("item").to_pylist(),
                                 block.column("body").to_pylist())
    return _LOADED[key]


def spans(text: bytes, runs: list[int]) -> list[tuple[int, int]]:
    """Character offsets in the original text of runs of words (first, last + 1, ...)."""
    if not runs:
        return []
    at = [m.span() for m in _RUN.finditer(fold(text))]
    ends = [(at[a][0], at[b - 1][1]) for a, b in zip(runs[::2], runs[1::2], strict=True)]
    if text.isascii():
        return ends
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(before[a]), int(before[b])) for a, b in ends]


FOUND = ("doc_id long, n_words long, n_hit long, spans array<struct<start:long,end:long>>, "
         "items array<string>")


def _report(part: pa.RecordBatch, texts: list[bytes], words: list[int], runs: list[list[int]],
            items: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(words, pa.int64()),
         pa.array([sum(r[1::2]) - sum(r[::2]) for r in runs], pa.int64()),
         pa.array([[{"start": a, "end": b} for a, b in spans(t, r)]
                   for t, r in zip(texts, runs, strict=True)], pa.list_(_SPAN)),
         pa.array([sorted(i) for i in items], pa.list_(pa.string()))],
        names=["doc_id", "n_words", "n_hit", "spans", "items"])


def _scan(table: bytes):
    key = hashlib.sha256(table).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = utf8(part)
                words, runs, items = [], [], []
                for t in texts:
                    w = folded_words(t)
                    r, i = _automaton(key, table).hits(w)
                    words.append(len(w))
                    runs.append(r)
                    items.append(i)
                yield _report(part, texts, words, runs, items)
    return run


def _scan_block(table: bytes):
    """As :func:`_scan`, but only what is hit, as runs of words, under the document's key."""
    key = hashlib.sha256(table).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [_automaton(key, table).hits(folded_words(t)) for t in utf8(part)]
                hit = [k for k, (r, _) in enumerate(found) if r]
                rows = pa.array(hit, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), part.column("th").take(rows),
                     pa.array([found[k][0] for k in hit], pa.list_(pa.int32())),
                     pa.array([list(found[k][1]) for k in hit], pa.list_(pa.string()))],
                    names=["doc_id", "th", "runs", "items"])
    return run


def united(runs: list[int]) -> list[int]:
    """Runs of several blocks as disjoint ascending ones."""
    out: list[int] = []
    for a, b in sorted(zip(runs[::2], runs[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            texts = utf8(part)
            yield _report(part, texts, [len(folded_words(t)) for t in texts],
                          [united(r or []) for r in part.column("runs").to_pylist()],
                          [i or [] for i in part.column("items").to_pylist()])


def _blocks(windows: DataFrame, n: int) -> Iterator[bytes]:
    """The windows of each block, ``BLOCK_WINDOWS`` or so, as bytes of an Arrow table."""
    for k in range(n):
        mine = windows.where(F.pmod(F.xxhash64("body", "item"), F.lit(n)) == k)
        table = mine.orderBy("body", "item").toArrow()
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as w:
            w.write_table(table)
        yield out.getvalue().to_pybytes()


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW,
               block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items), one row per input row.

    ``docs`` has doc_id and text, ``items`` item_id and text. ``spans`` are the
    character offsets of hit words in the text as given, ``items`` the ids of the
    items with a window in it, as ascending strings.
    """
    spark = docs.sparkSession
    ship(spark)
    windows = written(item_windows(items, window), "leak-windows")
    size = windows.agg(F.count("*").alias("n"), F.coalesce(
        F.sum(F.octet_length("body")), F.lit(0)).alias("bytes")).first()
    n = max(1, math.ceil(size["n"] / block_windows), math.ceil(size["bytes"] / block_bytes))
    d = documents(docs)
    if n == 1:
        found = d.mapInArrow(_scan(next(_blocks(windows, 1))), FOUND)
    else:
        keyed = d.withColumn("th", F.xxhash64("text"))
        each = keyed.dropDuplicates(["doc_id", "th"])
        parts = [written(each.mapInArrow(
            _scan_block(b), "doc_id long, th long, runs array<int>, items array<string>"),
            "leak-block") for b in _blocks(windows, n)]
        every = parts[0]
        for p in parts[1:]:
            every = every.union(p)
        hits = every.groupBy("doc_id", "th").agg(      # a row per block and document at most
            F.flatten(F.collect_list("runs")).alias("runs"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        found = keyed.join(hits, ["doc_id", "th"], "left").select(
            "doc_id", "text", "runs", "items").mapInArrow(_unite, FOUND)
    return found.withColumn("doc_id", shown_id())


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per input row."""
    return find_leaks(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """Reference result for small inputs: every place of every document against every window."""
    patterns = [(i, w.split(b" ")) for i, t in items
                for w in windows_of(folded_words((t or "").encode()), window)]
    out = []
    for d, t in docs:
        words = folded_words((t or "").encode())
        hit, named = set(), set()
        for i, p in patterns:
            for a in range(len(words) - len(p) + 1):
                if words[a:a + len(p)] == p:
                    hit.update(range(a, a + len(p)))
                    named |= {str(i)} if i is not None else set()
        out.append((d, len(words), len(hit), sorted(named)))
    return out
