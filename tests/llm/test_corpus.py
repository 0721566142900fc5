"""Importance draw, phrase trees and leak scan: against brute force."""

import random
import zlib

import numpy as np
import pytest

from strata.llm import collocations, importance, leak_scan
from strata.llm.common import LAST_ID
from tests.llm.helpers import awkward, docs_of, empty, frame, pairs_of, SF

ITEMS = "item_id long, text string, words string, lang string"
BOUND = [(0, "one two three four five six seven eight nine ten eleven"),
         (1, "ONE, two; three-four five\nsix seven eight nine ten"), (2, "lazy dog"), (3, None),
         (4, " .;! "), (5, "passage3 passage4 passage5 passage6 passage7 passage8 passage9 "
                           "passage10 passage11 passage12 passage13"),
         (5, "漢字 end"), (None, "word word word"), (11, "lazy DOG"), (2, "lazy dog")]


def _items(spark, rows=BOUND):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEMS)


# ------------------------------------------------------------------ leak scan
@pytest.mark.parametrize("source", ["awkward", "data"])
@pytest.mark.parametrize("blocks", [leak_scan.BLOCK_WINDOWS, 4])
def test_leaks_match_brute_force(spark, source, blocks):
    if source == "awkward":
        docs, items = frame(spark, awkward()), _items(spark)
    else:
        docs = docs_of(spark)
        blocks = max(blocks, 400)
        items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = leak_scan.find_leaks(docs.repartition(3), items, block_windows=blocks).collect()
    pairs = pairs_of(docs)
    bound = [(r.item_id, r.text) for r in items.collect()]
    if source == "data":    # brute force over the documents that share a word run with an item
        runs = {w for _, t in bound for w in leak_scan.windows_of(
            leak_scan.folded_words((t or "").encode()))}
        pairs = [(d, t) for d, t in pairs if any(w in b" ".join(leak_scan.folded_words(
            (t or "").encode())) for w in runs)]
        ids = {d for d, _ in pairs}
        assert pairs and all(not r.n_hit for r in got if r.doc_id not in ids)
        got = [r for r in got if r.doc_id in ids]
    key = lambda r: tuple((v is not None, v) for v in r[:3]) + (r[3],)
    assert (sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=key)
            == sorted(leak_scan.brute_force(pairs, bound), key=key))


def test_leak_spans_point_into_the_original(spark):
    text = "Über: Lazy—no, lazy\t DOG! Ünd ONE; two three four five six seven eight nine TEN."
    got = leak_scan.find_leaks(frame(spark, [(1, text)]), _items(spark)).first()
    assert [text[s.start:s.end] for s in got.spans] == [
        "lazy\t DOG", "ONE; two three four five six seven eight nine TEN"]
    assert got["items"] == ["0", "1", "11", "2"] and got.n_hit == 12


def test_leaks_over_empty_tables(spark):
    docs = frame(spark, awkward())
    assert leak_scan.leak_report(empty(spark), _items(spark)).collect() == []
    none = leak_scan.leak_report(docs, _items(spark, [(3, None), (4, "..")])).collect()
    assert len(none) == len(awkward())
    assert not any(r.contaminated or r.n_hit or r.n_items for r in none)


def test_runs_of_overlapping_windows_unite():
    auto = leak_scan.Automaton(["a", "b", "c"], [b"x y z", b"y", b"z q"])
    runs, items = auto.hits([b"y", b"x", b"y", b"z", b"q", b"x", b"y", b"y"])
    assert (runs, items) == ([0, 1, 2, 5, 6, 8], {"b", "c"}) or (
        runs, items) == ([0, 5, 6, 8], {"a", "b", "c"})
    assert leak_scan.united([4, 6, 0, 2, 2, 3, 9, 10, 5, 8]) == [0, 3, 4, 8, 9, 10]


# ------------------------------------------------------------------ importance
def test_crc_matrices_equal_zlib():
    rng = random.Random(3)
    features = [b"", b"a", "漢字 é".encode(), b"x" * 3000] + [
        bytes(rng.randrange(1, 256) for _ in range(rng.randrange(30))) for _ in range(500)]
    assert importance.crc32_all(features).tolist() == [zlib.crc32(f) for f in features]


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_draw_matches_brute_force(spark, source):
    if source == "awkward":     # distinct ids: brute force ranks by id
        pairs = list({d: (d, t) for d, t in awkward()}.values())
        docs, target = frame(spark, pairs), ["the lazy dog", None, "word " * 9, "漢字"]
        target_df = spark.createDataFrame([(t,) for t in target], "text string")
    else:
        docs = docs_of(spark)
        pairs = pairs_of(docs)
        target_df = spark.read.parquet(f"{SF}/benchmark.parquet")
        target = [r.text for r in target_df.collect()]
    got = [tuple(r) for r in importance.draw_report(docs.repartition(5), target_df).collect()]
    key = lambda r: LAST_ID if r[0] is None else r[0]
    assert sorted(got, key=key) == sorted(importance.brute_force(pairs, target), key=key)


def test_word_runs_and_gains_of_longer_features():
    texts = [b"Aa bb cc", b"", b"bb"]
    words, n, bucket = importance.bucketed(texts, 2, 1000)
    assert words == [3, 0, 1] and n.tolist() == [5, 0, 1]
    assert bucket.tolist() == [zlib.crc32(f) % 1000 for f in (
        b"aa", b"bb", b"cc", b"aa bb", b"bb cc", b"bb")]
    assert importance.gains(np.array([0, 0]), np.array([0, 0])).tolist() == [0, 0]


def test_repeated_rows_and_ids_are_drawn_one_by_one(spark):
    body = " ".join(f"word{i}" for i in range(25))
    rows = [(7, body)] * 40 + [(8, body + " more")] * 5 + [(8, body)] * 5 + [(None, body)] * 10
    docs = frame(spark, rows).repartition(6)
    target = spark.createDataFrame([("word1 word2",)], "text string")
    out = importance.draw(importance.weigh(docs, target), percent=50).collect()
    assert len(out) == 60
    assert sorted(r["rank"] for r in out if r["rank"] is not None) == list(range(1, 31))
    order = sorted((-r.score, r.doc_id, r.th) for r in out)[:30]
    assert order == [(-r.score, r.doc_id, r.th) for r in sorted(
        (r for r in out if r["rank"] is not None), key=lambda r: r["rank"])]
    kept = importance.resample(docs, target, percent=50)
    assert kept.schema == docs.schema and kept.count() == 30


def test_draw_over_empty_tables(spark):
    target = spark.createDataFrame([], "text string")
    assert importance.draw_report(empty(spark), target).collect() == []
    out = importance.draw_report(frame(spark, [(1, "a b"), (2, None)]), target).collect()
    assert [r["rank"] for r in out] == [None, None]


# ------------------------------------------------------------------ phrases
def _phrases(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, lang, "x") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, phrase string")
    return sorted(tuple(r) for r in collocations.collocations(
        docs.repartition(4), **options).collect())


@pytest.mark.parametrize("group_leaves", [collocations.GROUP_LEAVES, 3])
def test_collocations_match_brute_force(spark, group_leaves):
    rng = random.Random(11)
    words = ["a", "b", "New", "york", "\x01a", "é", "a\x00", "(c)", "d-e", "İ"]
    rows = [(None, None), ("en", ""), ("und", "a b"), (None, "a b a b"), ("", "a b a b a b")]
    for i in range(120):
        text = " ".join(rng.choices(words, range(10, 0, -1), k=rng.randrange(1, 40)))
        for mark in ".,;:!?\n\r\x0b\t":
            text = text.replace(" ", f"{mark} ", 1) if rng.random() < 0.4 else text
        rows.append((["en", "fr", None][i % 3], text))
    for least, top in ((2, 5000), (7, 10)):
        got = _phrases(spark, rows, least=least, top=top, group_leaves=group_leaves)
        assert got == sorted(collocations.brute_force(rows, least, top)) and got


def test_collocations_of_data_and_of_nothing(spark):
    docs = docs_of(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in collocations.collocations(docs).collect())
    assert got == sorted(collocations.brute_force(rows)) and got
    assert _phrases(spark, [("en", "a b c")]) == []
    assert collocations.collocations(empty(spark)).collect() == []


def test_prefixes_lengthen_until_they_fit(spark):
    rows = [("en", ["a", "b", f"w{i}", "x"], 1) for i in range(20)]
    rows += [("en", ["a", "c"], 5), ("fr", ["a", "b"], 2), ("en", ["a", "b"], 3)]
    leaves = spark.createDataFrame(rows, "lang string, words array<string>, n long")
    out = collocations.partitioned(leaves, 10).collect()
    assert sorted((tuple(r.words), r.n) for r in out) == sorted((tuple(w), n) for _, w, n in rows)
    sizes = {(r.lang, len(r.words), len(r.prefix)) for r in out}
    assert sizes == {("en", 4, 3), ("en", 2, 2), ("fr", 2, 1)}
