"""BPE encoding and decoding with tree concatenation of long unsplit texts.

A text is cut at ASCII white space, which this pre-tokenizer drops and where no
piece, added token or normalisation reaches across; runs between encode
independently. Short runs are encoded by the tokenizers library, each distinct
one once while the worker's cache has room, or, in texts of plain Latin
characters, by the same merges in a faster form (:class:`Codec`). A run of more than ``LONG``
characters without white space is cut into halves, and those again, until
pieces of at most ``LONG`` remain; pieces are rows of their own, encoded in
parallel by different tasks. Neighbouring encodings are then concatenated pair
by pair up the tree: a window around the join is encoded anew and grows until
two tokens in a row agree exactly, in id and place, with the left side and two
with the right side; then the left side's tokens up to its match, the window's
between and the right side's from its match on are the encoding of both. (A
window that covers a side needs no match there.)

Edge cases: null and empty texts have no ids and decode to the empty text; the
tokenizer's truncation and padding are off; repeated rows get equal results; no
rows give no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import documents, ship, shown_id, slices, utf8, written
from strata.llm.tokens import library, public_path

VOCABULARY = "word_bpe_49k.json"
#: Characters of a run above which it is encoded in pieces.
LONG = 8192
#: Characters on each side of a join that are encoded first; longer than any added token.
WINDOW = 64
#: Distinct runs a worker remembers.
CACHE_RUNS = 300_000

ROWS = ("uid long, doc_id long, seq long, kind int, n_tokens long, ids binary, text string, "
        "ids_sha binary, text_sha binary")
DONE, PART, PIECE = 0, 1, 2


class Encoded(NamedTuple):
    """A text with its ids and where, in characters, each token begins and ends."""

    text: str
    ids: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def encode(tokenizer, text: str) -> Encoded:
    e = tokenizer.encode(text, add_special_tokens=False)
    span = np.array(e.offsets, np.int64).reshape(-1, 2)
    return Encoded(text, np.array(e.ids, np.uint32), span[:, 0], span[:, 1])


def _matches(side: Encoded, shift: int, window: Encoded, at: int) -> list[tuple[int, int]]:
    """(i, k): tokens i, i+1 of ``side`` are k, k+1 of ``window``; both as places in one text."""
    key = {(int(b) + shift, int(e) + shift, int(t)): i
           for i, (b, e, t) in enumerate(zip(side.begin, side.end, side.ids, strict=True))
           if e + shift >= at and b + shift <= at + len(window.text)}
    got = [key.get((int(b) + at, int(e) + at, int(t)), -9)
           for b, e, t in zip(window.begin, window.end, window.ids, strict=True)]
    clean = window.end[:-1] <= window.begin[1:]     # tokens may share a character's bytes
    return [(got[k], k) for k in range(len(got) - 1)
            if got[k] >= 0 and got[k + 1] == got[k] + 1 and clean[k]
            and (k == 0 or clean[k - 1]) and (k + 2 >= len(got) or clean[k + 1])]


def concatenate(tokenizer, left: Encoded, right: Encoded, window: int = WINDOW) -> Encoded:
    """The encoding of ``left.text + right.text``, from those of both sides."""
    text, join = left.text + right.text, len(left.text)
    while True:
        a, b = max(0, join - window), min(len(text), join + window)
        mid = encode(tokenizer, text[a:b])
        lm = [(0, 0)] if a == 0 else _matches(left, 0, mid, a)
        rm = [(len(right.ids), len(mid.ids))] if b == len(text) else _matches(right, join, mid, a)
        # the first match on the left, the last on the right
        if lm and rm:
            (i, k), (j, m) = lm[0], rm[-1]
            if a == 0:
                i = k = 0
            if k <= m:
                return Encoded(
                    text, np.concatenate([left.ids[:i], mid.ids[k:m], right.ids[j:]]),
                    np.concatenate([left.begin[:i], mid.begin[k:m] + a, right.begin[j:] + join]),
                    np.concatenate([left.end[:i], mid.end[k:m] + a, right.end[j:] + join]))
        window *= 2


def halves(text: str, most: int = LONG) -> list[str]:
    """Cut in half until no piece is longer than ``most``: the leaves of the tree, in order."""
    if len(text) <= most:
        return [text]
    mid = len(text) // 2
    return halves(text[:mid], most) + halves(text[mid:], most)


def tree(tokenizer, pieces: list[Encoded]) -> Encoded:
    """Concatenate neighbours, pair by pair, until one encoding remains."""
    while len(pieces) > 1:
        pieces = [concatenate(tokenizer, *pieces[i:i + 2]) if i + 1 < len(pieces) else pieces[i]
                  for i in range(0, len(pieces), 2)]
    return pieces[0]


# Characters whose lower case, composition and class are the same for Python and the tokenizer;
# a test compares all of them. Texts with others go to the library run by run.
_PLAIN_CHARS = [chr(c) for c in (*range(9, 14), *range(32, 127), *range(0xA1, 0x180)) if c != 0x130]
_ONLY_PLAIN = re.compile(f"[{re.escape(''.join(_PLAIN_CHARS))}]*")
_LETTER = re.escape("".join(c for c in _PLAIN_CHARS if unicodedata.category(c)[0] == "L"))
_NUMBER = re.escape("".join(c for c in _PLAIN_CHARS if unicodedata.category(c)[0] == "N"))
#: The tokenizer's own split pattern, which the fast way requires, and the same for plain characters.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^ \t-\r{_LETTER}{_NUMBER}]+")


#: Marks a word's end in the byte form of the merges; no plain character contains it.
_END = b"\x01"


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Ids and decoded text of whole texts.

    Plain texts are normalised and split here; tiktoken then applies the file's
    own merges, with the word end as a byte that joins the last letter before
    any other merge. That gives the library's ids because ranks only grow along
    merges and every token of the file encodes to itself, which tests check.
    Other texts go to the library, distinct runs once.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = library(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._added = [t["content"] for t in spec["added_tokens"]]
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self._fast = (steps == ["NFC", "Replace", "Lowercase"] and spec["decoder"] is None
                      and [x.get("type") for x in parts] == ["Split", "ByteLevel"]
                      and parts[0]["pattern"] == {"Regex": SPLIT}
                      and spec["model"]["end_of_word_suffix"] == "</w>")
        self._runs: dict[bytes, tuple[np.ndarray, bytes]] = {}
        if self._fast:
            self._read_merges(spec["model"])

    def _read_merges(self, model: dict) -> None:
        import tiktoken
        letters, vocab = _byte_letters(), model["vocab"]
        ids = np.zeros(512 + len(model["merges"]), np.int64)
        ranks = {bytes([b]): b for b in range(256)}
        for c, b in letters.items():
            ids[b], ids[256 + b] = vocab[c], vocab[c + "</w>"]
            ranks.setdefault(bytes([b]) + _END, 256 + b)
        for k, pair in enumerate(model["merges"]):
            whole = "".join(pair.split(" ") if isinstance(pair, str) else pair)
            ids[512 + k] = vocab[whole]
            word = whole.endswith("</w>")
            raw = bytes(letters[c] for c in (whole[:-4] if word else whole))
            if _END not in raw:
                ranks[raw + (_END if word else b"")] = 512 + k
        self._merger = tiktoken.Encoding("word", pat_str="[^\x01]+\x01", mergeable_ranks=ranks,
                                         special_tokens={})
        self._ids = ids.astype("<u4")
        # token strings with a space after each, end to end
        shown = sorted(vocab.items(), key=lambda x: x[1])
        strings = [(t + " ").encode() for t, _ in shown]
        self._size = np.array([len(x) for x in strings])
        self._at = np.concatenate([[0], np.cumsum(self._size)[:-1]])
        self._letters = np.frombuffer(b"".join(strings), np.uint8)
        self._dense = [i for _, i in shown] == list(range(len(shown)))
        self._fast = self._dense

    def _decoded(self, ids: np.ndarray) -> bytes:
        """The ids' token strings, joined by spaces."""
        size = self._size[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        at = np.repeat(self._at[ids] - ends + size, size) + np.arange(ends[-1])
        return self._letters[at[:-1]].tobytes()

    def _slow(self, raw: bytes) -> tuple[np.ndarray, bytes]:
        runs = raw.split()
        new = list({r for r in runs if r not in self._runs})
        if len(self._runs) + len(new) > CACHE_RUNS:
            self._runs.clear()
            new = list(set(runs))
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(
            [r.decode() for r in new], add_special_tokens=False)]
        texts = self.tokenizer.decode_batch(encoded, skip_special_tokens=False)
        self._runs.update((r, (np.array(i, "<u4"), t.encode()))
                          for r, i, t in zip(new, encoded, texts, strict=True))
        got = [self._runs[r] for r in runs]
        return (np.concatenate([np.zeros(0, "<u4"), *[g[0] for g in got]]),
                b" ".join([g[1] for g in got if len(g[0])]))

    def encode(self, raw: bytes) -> tuple[bytes, bytes]:
        """(ids, decoded text) of a text whose runs are short."""
        text = raw.decode()
        if (self._fast and _ONLY_PLAIN.fullmatch(text)
                and not any(a in text for a in self._added)):
            joined = "\x01".join([*_PIECE.findall(text.lower()), ""])
            ids = self._ids[self._merger.encode_to_numpy(joined, disallowed_special=())]
            return ids.tobytes(), self._decoded(ids)
        ids, decoded = self._slow(raw)
        return ids.tobytes(), decoded


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """This worker's codec for the tokenizer file ``path``."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        mine_codec = codec(path)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch):
                docs, parts = [], []        # per document its parts, and whether it is a long run
                for text in utf8(part):
                    runs = text.split() if len(text) > LONG else []
                    mine: list = []
                    if any(len(r) > LONG for r in runs):
                        now: list = []
                        for r in runs:
                            if len(r) > LONG and len(r.decode()) > LONG:
                                mine += [(b" ".join(now), False), (r, True)]
                                now = []
                            else:
                                now.append(r)
                        mine.append((b" ".join(now), False))
                    else:
                        mine.append((text, False))
                    docs.append(mine)
                    parts += [p for p, long in mine if not long]
                short = (mine_codec.encode(p) for p in parts)
                rows = []
                for doc, mine in zip(part.column("doc_id").to_pylist(), docs, strict=True):
                    uid += 1
                    if len(mine) == 1:
                        ids, text = next(short)
                        rows.append((uid, doc, 0, DONE, len(ids) // 4, None, None,
                                     hashlib.sha256(ids).digest(),
                                     hashlib.sha256(text).digest()))
                        continue
                    seq = 0
                    for p, long in mine:
                        if not long:
                            ids, text = next(short)
                            rows.append((uid, doc, seq, PART, len(ids) // 4, ids, text.decode(), None,
                                         None))
                            seq += 1
                        else:
                            # one row per leaf; a new tree begins at every PART row
                            for piece in halves(p.decode()):
                                rows.append((uid, doc, seq, PIECE, 0, None, piece, None, None))
                                seq += 1
                yield _batch(rows)
    return run


_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string(),
          pa.binary(), pa.binary())
_NAMES = [c.split()[0] for c in ROWS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


LEAVES = "uid long, doc_id long, seq long, kind int, text string, ids binary, spans binary"


def _leaves(path: str):
    """Encode the pieces of long runs; parts pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library(path)
        for batch in batches:
            ids, spans = batch.column("ids").to_pylist(), [None] * batch.num_rows
            for i, (kind, text) in enumerate(zip(batch.column("kind").to_pylist(),
                                                 batch.column("text").to_pylist(), strict=True)):
                if kind == PIECE:
                    e = encode(tokenizer, text)
                    ids[i] = e.ids.astype("<u4").tobytes()
                    spans[i] = np.stack([e.begin, e.end]).tobytes()
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("uid", "doc_id", "seq", "kind", "text")],
                 pa.array(ids, pa.binary()), pa.array(spans, pa.binary())],
                names=["uid", "doc_id", "seq", "kind", "text", "ids", "spans"])
    return run


def _join(path: str):
    """Concatenate the leaves of each document, sorted by (uid, seq)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library(path)
        uid = doc = None
        leaves: list[Encoded] = []
        ids: list[bytes] = []
        texts: list[str] = []

        def grow():
            if leaves:
                whole = tree(tokenizer, leaves)
                leaves.clear()
                ids.append(whole.ids.astype("<u4").tobytes())
                texts.append(tokenizer.decode(whole.ids.tolist(), skip_special_tokens=False))

        def finished():
            grow()
            i = b"".join(ids)
            row = (uid, doc, 0, DONE, len(i) // 4, None, None, hashlib.sha256(i).digest(),
                   hashlib.sha256(" ".join(t for t in texts if t).encode()).digest())
            ids.clear()
            texts.clear()
            return _batch([row])

        for batch in batches:
            for r in batch.to_pylist():
                if r["uid"] != uid:
                    if uid is not None:
                        yield finished()
                    uid, doc = r["uid"], r["doc_id"]
                if r["kind"] == PART:
                    grow()
                    ids.append(r["ids"])
                    texts.append(r["text"])
                else:
                    span = np.frombuffer(r["spans"], np.int64).reshape(2, -1)
                    leaves.append(Encoded(r["text"], np.frombuffer(r["ids"], "<u4"), *span))
        if uid is not None:
            yield finished()
    return run


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per input row."""
    ship(docs.sparkSession)
    path = path or public_path(VOCABULARY)
    rows = written(documents(docs).mapInArrow(_encode(path), ROWS), "bpe")
    leaves = (rows.where(F.col("kind") != DONE).repartition("uid", "seq")
              .mapInArrow(_leaves(path), LEAVES))
    joined = (leaves.repartition("uid").sortWithinPartitions("uid", "seq")
              .mapInArrow(_join(path), ROWS))
    return rows.where(F.col("kind") == DONE).union(joined).select(
        shown_id(), "n_tokens", F.lower(F.hex("ids_sha")).alias("ids_sha256"),
        F.lower(F.hex("text_sha")).alias("decoded_sha256"))
