"""Token-id files: independent zstandard frames with a trailing seek table.

A file holds the documents of one range of ids, ascending. Each document is one
or more frames of at most ``FRAME_IDS`` ids (unsigned 32-bit, little-endian);
after the last frame comes a skippable frame with the seek table: per frame its
compressed and plain size and the CRC-32 of its ids, per document its id, ids
and first frame, then the counts and a magic number. A reader takes the table
from the file's end and decompresses only the frames of the documents it wants.

A file has a name of its own for each task attempt and is published by the manifest
alone, without a rename: it names only files of attempts that ended, so what a lost
executor or a second attempt leaves behind is never read. Ids come from the rank form
of the vocabulary (:mod:`strata.llm.tokens`), tested equal to the tokenizers library.

Edge cases: null and empty texts hold only the end id; a null id is the
largest; repeated rows are stored once each; an empty table gives no files.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents, ship, shown_id
from strata.llm.tokens import BYTE_BPE, byte_bpe, crc32
from strata.session import scratch_path

END_ID = 0
FRAME_IDS = 1 << 18
FILE_IDS = 16_000_000
LEVEL = 3
SKIPPABLE = 0x184D2A50
MAGIC = 0x53545231
_FRAME = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("crc", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("n_ids", "<u8"), ("frame", "<u4")])
_TAIL = struct.Struct("<IIII")


class TokenFileError(ValueError):
    """The bytes are no token file, or a frame is not what was written."""


class TokenFileWriter:
    """Appends documents to an open binary file; :meth:`close` writes the seek table."""

    def __init__(self, out, level: int = LEVEL) -> None:
        import zstandard
        self._out, self._zstd = out, zstandard.ZstdCompressor(level=level)
        self._frames: list[tuple] = []
        self._docs: list[tuple] = []
        self.n_ids = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self._docs.append((doc_id, len(ids), len(self._frames)))
        for at in range(0, len(ids), FRAME_IDS):
            plain = ids[at:at + FRAME_IDS].astype("<u4", copy=False).tobytes()
            packed = self._zstd.compress(plain)
            self._frames.append((len(packed), len(plain), crc32(plain)))
            self._out.write(packed)
        self.n_ids += len(ids)

    def close(self) -> None:
        table = (np.array(self._frames, _FRAME).tobytes() + np.array(self._docs, _DOC).tobytes())
        body = table + _TAIL.pack(len(self._frames), len(self._docs), crc32(table), MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class TokenFile:
    """Random access to a token file given as something with ``seek``, ``read``."""

    def __init__(self, file) -> None:
        import zstandard
        self._file, self._zstd = file, zstandard.ZstdDecompressor()
        end = file.seek(0, 2)
        if end < _TAIL.size:
            raise TokenFileError("too short")
        file.seek(end - _TAIL.size)
        n_frames, n_docs, crc, magic = _TAIL.unpack(file.read(_TAIL.size))
        size = n_frames * _FRAME.itemsize + n_docs * _DOC.itemsize
        if magic != MAGIC or end < size + _TAIL.size:
            raise TokenFileError("no seek table")
        file.seek(end - _TAIL.size - size)
        table = file.read(size)
        if crc32(table) != crc:
            raise TokenFileError("damaged seek table")
        self._frames = np.frombuffer(table, _FRAME, n_frames)
        self.docs = np.frombuffer(table, _DOC, n_docs, n_frames * _FRAME.itemsize)
        self._at = np.concatenate([[0], np.cumsum(self._frames["packed"], dtype=np.int64)])

    def ids(self, index: int) -> np.ndarray:
        """Ids of the document at ``index``; only its own frames are decompressed."""
        doc = self.docs[index]
        out, left, frame = [], int(doc["n_ids"]), int(doc["frame"])
        while left > 0:
            f = self._frames[frame]
            self._file.seek(int(self._at[frame]))
            plain = self._zstd.decompress(self._file.read(int(f["packed"])),
                                          max_output_size=int(f["plain"]))
            if crc32(plain) != f["crc"]:
                raise TokenFileError(f"checksum of frame {frame}")
            out.append(np.frombuffer(plain, "<u4"))
            left -= len(out[-1])
            frame += 1
        return np.concatenate(out) if out else np.empty(0, "<u4")

    def find(self, doc_id: int) -> Iterable[int]:
        """Indexes of the documents with this id (they are stored in ascending order)."""
        keys = self.docs["doc_id"]
        return range(int(np.searchsorted(keys, doc_id)),
                     int(np.searchsorted(keys, doc_id, "right")))


def _write(folder: str, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        bpe, part = byte_bpe(vocabulary), TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        end = np.array([END_ID], "<u4")
        writer = out = name = None
        number = 0

        def finished():
            writer.close()
            out.close()
            return pa.RecordBatch.from_pydict(
                {"part": [part], "number": [number], "file": [name],
                 "n_ids": [writer.n_ids]}, schema=_MANIFEST)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                 strict=True):
                if writer is None:
                    name = f"{part:06d}-{number:06d}-{uuid.uuid4().hex}.tok"
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}")
                    writer = TokenFileWriter(out)
                writer.add(doc, np.concatenate([bpe.encode(text.as_py()), end]))
                if writer.n_ids >= FILE_IDS:
                    yield finished()
                    writer, number = None, number + 1
        if writer is not None:
            yield finished()
    return run


_MANIFEST = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()),
                       ("n_ids", pa.int64())])


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = BYTE_BPE) -> list[tuple]:
    """Write the corpus into ``folder``; the manifest: (file, ids before it, its ids) in order.

    ``folder`` is a URI that the executors share. The manifest has one entry per
    file of about ``FILE_IDS`` ids, not per document. It alone says which files count:
    a file that a lost or repeated task left behind has a name of its own and is not in it.
    Rows that share an id, or have none, are ordered by length and a hash of the text, and
    so spread over the range partitions like any others.
    """
    ship(docs.sparkSession)
    order = ["doc_id", F.length("text"), F.xxhash64("text")]
    ordered = (documents(docs).repartitionByRange(*order)
               .sortWithinPartitions(*order, "text"))
    made = ordered.mapInArrow(_write(folder, vocabulary),
                              "part int, number int, file string, n_ids long").collect()
    out, before = [], 0
    for r in sorted(made, key=lambda r: (r["part"], r["number"])):
        out.append((r["file"], before, r["n_ids"]))
        before += r["n_ids"]
    return out


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, before in zip(batch.column("file").to_pylist(),
                                    batch.column("before").to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{file}") as f:
                    tokens = TokenFile(f)
                    counts = tokens.docs["n_ids"].astype(np.int64)
                    for at in range(0, len(counts), 4096):
                        part = range(at, min(at + 4096, len(counts)))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(tokens.docs["doc_id"][at:part.stop]),
                            pa.array(before + np.cumsum(counts[:part.stop])[at:] - counts[at:part.stop]),
                            pa.array(counts[at:part.stop]),
                            pa.array([crc32(tokens.ids(i)) for i in part], pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_tokens(spark: SparkSession, folder: str, manifest: list[tuple]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    ship(spark)
    files = spark.createDataFrame([(f, b) for f, b, _ in manifest], "file string, before long")
    return (files.repartition(max(1, len(manifest)))        # in turn: one file a task
            .mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
            .select(shown_id(), "start", "n_tokens", "ids_crc32"))


def round_trip(docs: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Write token files to the shared scratch folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, folder, vocabulary))
