"""Order-preserving packing of token streams into windows by dynamic programming.

Documents, each ended by one id, are laid out in ascending id order; a range of
ids is one stream. A stream may be cut at document ends, every sentence end that
is the end of an id (closing quotes and brackets belong to the sentence) and,
where those are further apart than ``HARD_GAP``, between any ids, at growing
penalties. The cuts minimise padding plus penalties:

    f(j) = penalty(j) + min over i with j - i <= window of f(i) + window - (j - i)

whose inner minimum over ``f(i) + i`` moves along a monotone queue, so a stream
takes linear time. A stream is solved in blocks of ``BLOCK_IDS`` ids; the last
window of a block stays open and begins the next one, which bounds memory: cuts
are the cheapest of their block, not of the whole stream.
Each partition's last window alone may be short.

Edge cases: null and empty texts hold only the end id; a document longer than a
window spans several; a null id is the largest; repeated rows are packed once
each; no rows give no pieces.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import documents, ship, shown_id
from strata.llm.tokens import BYTE_BPE, byte_bpe, crc32

WINDOW = 2048
END_ID = 1
BLOCK_IDS = 1 << 20
#: Penalties, in padding ids, of a cut at a sentence's end and anywhere else; a document's end is free.
SENTENCE_CUT, HARD_CUT = 2.0, 12.0
HARD_GAP = 32
#: Sequence numbers: partition * SEQUENCES + number within the partition.
SEQUENCES = 1 << 32

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indexes into ``places`` of the cheapest cuts from the first place to the last.

    ``places`` ascend by at most ``window``; ``penalties`` has the cost of
    ending a window at each place. The first and last index are included.
    """
    c, cost = places.tolist(), penalties.tolist()
    back = [0] * len(c)
    queue: deque = deque()
    value = 0.0
    for j in range(1, len(c)):
        at = c[j]
        v = value + c[j - 1]
        while queue and queue[-1][0] >= v:
            queue.pop()
        queue.append((v, j - 1))
        while c[queue[0][1]] < at - window:
            queue.popleft()
        v, back[j] = queue[0]
        value = v + window - at + cost[j]
    cuts = [len(c) - 1]
    while cuts[-1] > 0:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def cut_places(sentence: np.ndarray, doc_ends: np.ndarray, hard_gap: int = HARD_GAP,
               ) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut (0 and its end included), and the penalties.

    ``sentence`` says for each id whether it ends a sentence; ``doc_ends`` are
    the places just after documents, ascending.
    """
    n = len(sentence)
    soft = np.flatnonzero(sentence) + 1
    kind = np.zeros(n + 1, np.int8)     # 1: sentence end, 2: document end
    kind[soft] = 1
    kind[[0, n]] = 1
    kind[doc_ends] = 2
    places = np.flatnonzero(kind)
    gaps = np.diff(places)
    extra = np.maximum(0, (gaps - 1) // hard_gap)
    hard = (np.repeat(places[:-1], extra)
            + hard_gap * (np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1))
    every = np.concatenate([places, hard])
    penalties = np.concatenate([np.full(len(places), SENTENCE_CUT), np.full(len(hard), HARD_CUT)])
    penalties[:len(places)][kind[places] == 2] = 0
    order = np.argsort(every, kind="stable")
    return every[order], penalties[order]


class Packer:
    """Packs one stream; yields pieces as columns of :data:`SCHEMA`."""

    def __init__(self, ends_sentence: np.ndarray, first_sequence: int, window: int = WINDOW,
                 block: int = BLOCK_IDS) -> None:
        self._table, self._sequence = ends_sentence, first_sequence
        self._window, self._block = window, block
        self._docs: list[tuple[int, int, int]] = []     # id, ids, ids already packed
        self._ids: list[np.ndarray] = []
        self._ends: list[np.ndarray] = []
        self._held = 0

    def add(self, doc_id: int, ids: np.ndarray, ends: np.ndarray | None = None) -> Iterator[dict]:
        """``ends`` says which ids end a sentence; without it the table does."""
        self._docs.append((doc_id, len(ids), 0))
        self._ids.append(ids)
        self._ends.append(self._table[ids] if ends is None else ends)
        self._held += len(ids)
        if self._held >= self._block:
            yield self._solve(False)

    def finish(self) -> Iterator[dict]:
        if self._held:
            yield self._solve(True)

    def _solve(self, last: bool) -> dict:
        ids = np.concatenate(self._ids)
        left = np.array([n - done for _, n, done in self._docs], np.int64)
        doc_ends = np.cumsum(left)
        sentence = np.concatenate(self._ends)
        places, penalties = cut_places(sentence, doc_ends, min(HARD_GAP, self._window))
        cuts = places[best_cuts(places, penalties, self._window)]
        if not last and len(cuts) > 2:
            cuts = cuts[:-1]        # the last window stays open
        end = int(cuts[-1])
        edges = np.union1d(cuts, np.concatenate([[0], doc_ends[doc_ends < end]]))
        at, to = edges[:-1], edges[1:]
        doc = np.searchsorted(doc_ends, at, "right")
        seq = np.searchsorted(cuts, at, "right") - 1
        ids_, total, done = (np.array(x, np.int64) for x in zip(*self._docs, strict=True))
        begun = doc_ends - left
        out = {"doc_id": ids_[doc], "start": at - begun[doc] + done[doc], "length": to - at,
               "ids_crc32": np.array([crc32(ids[a:b]) for a, b in zip(at, to, strict=True)],
                                     np.int64),
               "doc_tokens": total[doc], "sequence_id": self._sequence + seq,
               "offset": at - cuts[seq]}
        self._sequence += len(cuts) - 1
        first = int(np.searchsorted(doc_ends, end, "right"))
        self._docs = self._docs[first:]
        if self._docs:
            d, n, before = self._docs[0]
            self._docs[0] = (d, n, before + max(0, end - int(begun[first])))
        self._ids, self._ends = ([ids[end:]], [sentence[end:]]) if end < len(ids) else ([], [])
        self._held = len(ids) - end
        return out


def _pack(vocabulary: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe = byte_bpe(vocabulary)
        packer = Packer(bpe.ending_sentence(), TaskContext.get().partitionId() * SEQUENCES, window)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                 strict=True):
                ids = bpe.encode(text := text.as_py())
                ends = np.append(bpe.sentence_ends(text, ids), False)
                for piece in packer.add(doc, np.concatenate([ids, end]), ends):
                    yield pa.RecordBatch.from_pydict(piece)
        for piece in packer.finish():
            yield pa.RecordBatch.from_pydict(piece)
    return run


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = BYTE_BPE) -> DataFrame:
    """One row per piece: where in its document, where in which sequence."""
    ship(docs.sparkSession)
    # the hash splits an id (or null) that many rows share
    order = ("doc_id", F.xxhash64("text"))
    ordered = documents(docs).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    made = ordered.mapInArrow(_pack(vocabulary, window), SCHEMA)
    return made.select(shown_id(), *[c for c in made.columns if c != "doc_id"])
