"""Token files, packing, BPE: against the tokenizers library and exact round trips."""

import hashlib
import io
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import bpe_codec, packing, token_files
from strata.session import scratch_path
from strata.llm.tokens import byte_bpe, crc32, library, public_path
from tests.llm.helpers import awkward, docs_of, empty, frame, pairs_of

BIG = 2**63 - 1
ODD = ["", " ", "  ", "a  b", "\n\n x \t", "<|endoftext|>", "x<|endoftext|> y", "'s 'LL it's", "é漢字İΣ",
       "é ́", "  \u0085x", "12³ ½", "😀👩‍👩‍👧", "a" * 3000, "!?" * 900]


def _ids(text, end):
    t = library(public_path("byte_bpe_50k.json"))
    return np.array(t.encode(text, add_special_tokens=False).ids + [end], "<u4")


def test_fast_encoder_equals_the_library(spark):
    bpe, lib = byte_bpe(), library(public_path("byte_bpe_50k.json"))
    for text in [*ODD, *[t or "" for _, t in awkward()], *[t for _, t in pairs_of(docs_of(spark))]]:
        assert bpe.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids
    # beyond the pattern matcher's stack the library itself is asked
    assert len(bpe.encode(" " * 1_200_000)) == len(
        lib.encode(" " * 1_200_000, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_fast_encoder_on_any_text(text):
    lib = library(public_path("byte_bpe_50k.json"))
    assert byte_bpe().encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids


def test_token_file_reads_only_what_is_asked():
    out, rng = io.BytesIO(), np.random.default_rng(1)
    docs = [(i * 3, rng.integers(0, 50_000, n).astype("<u4"))
            for i, n in enumerate([1, 0, 5, token_files.FRAME_IDS * 2 + 7, 100])]
    writer = token_files.TokenFileWriter(out)
    for d, ids in docs:
        writer.add(d, ids)
    writer.close()

    class Counted(io.BytesIO):
        got = 0

        def read(self, n=-1):
            data = super().read(n)
            Counted.got += len(data)
            return data

    file = token_files.TokenFile(Counted(out.getvalue()))
    for i, (_, ids) in enumerate(docs):
        assert file.ids(i).tolist() == ids.tolist()
    assert list(file.find(12)) == [4] and list(file.find(4)) == []
    Counted.got = 0
    file.ids(0)
    assert Counted.got < 100
    import zstandard
    plain = zstandard.ZstdDecompressor().stream_reader(
        io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(ids.tobytes() for _, ids in docs)


@pytest.mark.parametrize("at", [3, -3, -40])
def test_token_file_damage_is_found(at):
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out)
    writer.add(1, np.arange(1000, dtype="<u4"))
    writer.close()
    raw = bytearray(out.getvalue())
    raw[at] ^= 0xFF
    with pytest.raises(Exception):  # noqa: B017 - zstandard's error or TokenFileError
        token_files.TokenFile(io.BytesIO(bytes(raw))).ids(0)
    with pytest.raises(token_files.TokenFileError):
        token_files.TokenFile(io.BytesIO(b"short"))


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_token_round_trip(spark, source, monkeypatch):
    df = frame(spark, awkward()) if source == "awkward" else docs_of(spark)
    got = token_files.round_trip(df).collect()
    pairs = sorted(((BIG if d is None else d, len(t or ""), t or "") for d, t in pairs_of(df)))
    want, start = [], 0
    for d, _, t in pairs:
        ids = _ids(t, 0)
        want.append((None if d == BIG else d, start, len(ids), crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_packing(spark, source):
    df = frame(spark, awkward()) if source == "awkward" else docs_of(spark)
    rows = packing.pack(df).collect()
    pairs = _sorted = [(d, t or "") for d, t in pairs_of(df)]
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    copies = defaultdict(list)
    for d, t in pairs:
        copies[d].append(t)
    assert set(by_doc) == set(copies)
    for d, texts in copies.items():
        if len(texts) == 1:
            ids, at = _ids(texts[0], 1), 0
            for r in sorted(by_doc[d], key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
                assert r.ids_crc32 == crc32(ids[at:at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
        total += at
    assert total == sum(len(_ids(t, 1)) for _, t in pairs)
    if source == "data":
        assert total / (packing.WINDOW * len(sequences)) > 0.95


def _cheapest(places, penalties, window):
    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= window:
                best[j] = min(best[j], best[i] + window - (places[j] - places[i]) + penalties[j])
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(2)
    for _ in range(100):
        gaps = rng.integers(1, 9, rng.integers(1, 60))
        places = np.concatenate([[0], np.cumsum(gaps)])
        penalties = rng.choice([0.0, 2.0, 12.0], len(places))
        cuts = packing.best_cuts(places, penalties, 16)
        cost = sum(16 - (places[b] - places[a]) + penalties[b]
                   for a, b in zip(cuts, cuts[1:], strict=False))
        assert cost == _cheapest(places, penalties, 16)


def test_every_sentence_end_is_a_place():
    rng = np.random.default_rng(6)
    for _ in range(20):
        sentence = rng.random(200) < rng.choice([0.02, 0.2, 0.9])
        doc_ends = np.array([50, 120, 200])
        places, penalties = packing.cut_places(sentence, doc_ends)
        assert set(np.flatnonzero(sentence) + 1) <= set(places[penalties < packing.HARD_CUT])
        assert set(np.flatnonzero(penalties == 0)) == set(np.searchsorted(places, doc_ends))


def test_sentence_ends_of_quotes_and_scripts():
    bpe = byte_bpe()
    for text, sentences in (
            ('He said "go." Then (so!) he left.', ['He said "go."', " Then (so!)", " he left."]),
            ("Wait... \u201cNo?!\u201d She ran.\nOn", ["Wait...", " \u201cNo?!\u201d", " She ran.", "\n"]),
            ("\u6211\u5011\u8d70\u3002\u4f60\u5462\uff1f\u300c\u597d\uff01\u300d\u4ed6",
             ["\u6211\u5011\u8d70\u3002", "\u4f60\u5462\uff1f", "\u300c\u597d\uff01\u300d"]),
            ("\u0915\u0964 \u0916", ["\u0915\u0964"]), ("<|endoftext|>A. b", ["<|endoftext|>A."]),
            ("", []), ("none here", [])):
        ids = bpe.encode(text)
        ends = bpe.sentence_ends(text, ids)
        assert len(ends) == len(ids)
        at = np.cumsum([len(s.encode()) for s in sentences])
        got = np.cumsum(bpe._sizes[ids])[ends] if len(ids) else []
        assert list(got) == list(at)


def test_packer_blocks_carry_the_open_window():
    table = np.zeros(100, bool)
    table[7] = True
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 100, n).astype("<u4") for n in rng.integers(1, 400, 60)]
    packer = packing.Packer(table, 5, window=64, block=500)
    out = [p for i, d in enumerate(docs) for p in packer.add(i, d)] + list(packer.finish())
    rows = [dict(zip(p, v, strict=True)) for p in out for v in zip(*p.values(), strict=True)]
    for i, d in enumerate(docs):
        at = 0
        for r in (r for r in rows if r["doc_id"] == i):
            assert r["start"] == at and r["ids_crc32"] == crc32(d[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(d)
    fill = defaultdict(int)
    for r in rows:
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 64 and min(fill) == 5


def _library(text):
    t = library(public_path(bpe_codec.VOCABULARY))
    ids = t.encode(text, add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())


@pytest.mark.parametrize("source", ["awkward", "odd", "data"])
def test_codec_equals_the_library(spark, source):
    df = {"awkward": lambda: frame(spark, awkward()), "data": lambda: docs_of(spark),
          "odd": lambda: frame(spark, list(enumerate(ODD)))}[source]()
    got = sorted((BIG if r[0] is None else r[0], *r[1:])
                 for r in bpe_codec.encode_decode(df).collect())
    assert got == sorted((BIG if d is None else d, *_library(t or "")) for d, t in pairs_of(df))


def test_plain_characters_and_merges_equal_the_library():
    codec = bpe_codec.codec(public_path(bpe_codec.VOCABULARY))
    assert codec._fast
    t, rng = codec.tokenizer, random.Random(4)
    texts = [f"a{k}b {k}1{k}.{k} {k}{k} x {k}'s{k}'ll 's{k}" for k in bpe_codec._PLAIN_CHARS]
    words = [w.removesuffix("</w>") for w in t.get_vocab() if w.isascii()]
    texts += words
    texts += ["".join(rng.choice(words)[:rng.randint(1, 6)] for _ in range(rng.randint(1, 30)))
              for _ in range(2000)]
    for text in texts:
        ids = t.encode(text, add_special_tokens=False).ids
        got, decoded = codec.encode(text.encode())
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert decoded.decode() == t.decode(ids, skip_special_tokens=False)


_PARTS = st.sampled_from(["a", "b", "th", "e", "'s", "'", "ll", "!", "1", "é", "é", "Σ", "漢",
                          "<|endoftext|>", "İ", "ing", "?!", "́", " "])


@settings(max_examples=300, deadline=None)
@given(st.lists(_PARTS, min_size=2, max_size=120), st.integers(3, 40), st.integers(14, 64))
def test_tree_concatenation_equals_the_whole(parts, most, window):
    t, text = library(public_path(bpe_codec.VOCABULARY)), "".join(parts)
    pieces = [bpe_codec.encode(t, x) for x in bpe_codec.halves(text, most)]
    while len(pieces) > 1:
        pieces = [bpe_codec.concatenate(t, *pieces[i:i + 2], window=window)
                  if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    assert pieces[0].ids.tolist() == bpe_codec.encode(t, text).ids.tolist()


def test_empty_tables(spark):
    df = empty(spark)
    for f in (token_files.round_trip, packing.pack, bpe_codec.encode_decode):
        out = f(df)
        assert out.columns and out.count() == 0


@pytest.mark.parametrize("doc_id", [7, None])
def test_rows_of_one_id_spread_over_files(spark, doc_id):
    rows = [(doc_id, f"text {i % 4900} of one id") for i in range(5000)] + [(1, "first"), (1, "one")]
    out = token_files.round_trip(frame(spark, rows).repartition(6)).collect()
    assert len(out) == 5002
    starts = sorted((r.start, r.n_tokens) for r in out)
    assert starts[0][0] == 0
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert {r.doc_id for r in out[:]} == {1, doc_id}
    assert max(r.start for r in out if r.doc_id == 1) < min(
        r.start for r in out if r.doc_id == doc_id)
    folder = scratch_path(spark, "spread")
    # partitions this small would be put together again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_tokens(frame(spark, rows).repartition(6), folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(n for _, _, n in manifest) < 0.3 * sum(n for _, _, n in manifest)
