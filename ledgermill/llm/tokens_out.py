"""Token ids in binary files: independent zstandard frames, a trailing seek table, a checksum per frame.

A file is a series of zstandard frames in the public seekable format: data frames of token ids (little-endian, two
bytes where the vocabulary allows, else four), one frame with the index of documents, and a skippable frame with the
seek table (compressed size, size, low half of XXH64 for each frame). A reader fetches the tail, the index, and only
those frames that hold a wanted document. A document may run over frames; every frame stands alone.

Documents are range-partitioned by id and sorted; a task writes one file under a name of its own and moves it to its
final name, so a repeated task replaces equal bytes. Memory per task: one frame, one text, and 24 bytes per document.

Defined results: a null text is empty and holds the end id only; documents with a null id come first; equal ids are
ordered by text; an empty table makes files without documents; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import gc
import os
import string
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import batches, chunked, decoded, id_and_bytes, slices

# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

SIGNS = string.punctuation.encode()

_MANIFEST = pa.schema([("file", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                   ("file", pa.string())])


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The shared folder as Arrow opens it: file, hdfs, s3, gs."""
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class Encoder:
    """Ids of whole texts by a tokenizers file that drops white space, lower-cases, and splits letters from signs.

    No normaliser reaches across white space, so pieces between ASCII white space are encoded once and remembered; unseen
    pieces are encoded together, with a space between them, and told apart by the offsets. ASCII signs that end a piece
    after a letter are a piece of their own. Texts with a special token in them keep their capitals until then. Of what is
    remembered the older half goes when it is full, but for pieces that were met again since; a piece takes some 200 bytes.
    """

    def __init__(self, path: str, limit: int = 1_200_000, together: int = 4000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.limit, self.together, self.known, self.older = limit, together, {}, {}

    @staticmethod
    def _split(piece: bytes) -> tuple[bytes, bytes] | None:
        """A piece and the signs that end it, if the pre-tokenizer cuts there."""
        word = piece.rstrip(SIGNS)
        if not word or word == piece or b"<|" in piece:  # a special token ends in signs
            return None
        return (word, piece[len(word) :]) if decoded(word)[-1].isalpha() else None

    def _learn(self, pieces: set[bytes]) -> None:
        missing = pieces.difference(self.known)
        if missing and len(self.known) + len(missing) > self.limit // 2:
            self.older, self.known, missing = self.known, {}, pieces
        fresh = missing.difference(self.older)
        self.known.update((p, self.older[p]) for p in missing - fresh)
        parts = {p: found for p in fresh if p[-1] in SIGNS and (found := self._split(p))}
        plain = fresh.difference(parts).union(*parts.values()).difference(self.known)
        for held in chunked(plain, self.together):
            shown = [decoded(p) for p in held]
            found = self.tokenizer.encode(" ".join(shown), add_special_tokens=False)
            starts = np.cumsum([0, *(len(p) + 1 for p in shown)])
            cuts = np.searchsorted([a for a, _ in found.offsets], starts).tolist()
            ids = np.array(found.ids, self.kind).tobytes()
            for k, p in enumerate(held):
                self.known[p] = ids[cuts[k] * self.width : cuts[k + 1] * self.width]
        for p, (word, signs) in parts.items():
            self.known[p] = self.known[word] + self.known[signs]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        collects = gc.isenabled()
        gc.disable()  # millions of objects without cycles are made here, and looked through in vain
        try:
            pieces = [(t if b"<|" in t else t.lower()).split() for t in texts]
            self._learn(set().union(*pieces))
            return [b"".join(map(self.known.__getitem__, p)) for p in pieces]
        finally:
            if collects:
                gc.enable()


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker process: what it has learned serves the next task too."""
    return Encoder(path)


class FrameWriter:
    """Documents to one file. ``out`` needs ``write`` only."""

    def __init__(self, out, width: int, frame_bytes: int, level: int = 3):
        self.out, self.width, self.frame_bytes = out, width, frame_bytes // width * width
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held, self.table, self.index, self.written = bytearray(), [], [], 0

    def _frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.written += len(packed)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((doc_id or 0, len(ids) // self.width, int(doc_id is None)))
        self.held += ids
        while len(self.held) >= self.frame_bytes:
            self._frame(bytes(self.held[: self.frame_bytes]))
            del self.held[: self.frame_bytes]

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        rows = np.array(self.index, "<i8").reshape(-1, 3)
        self._frame(struct.pack("<q", self.width) + rows.T.tobytes())
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.written += 8 + len(entries) + len(footer)


class FrameReader:
    """Random access to one file: the seek table and the index are read first, then only the frames asked for."""

    def __init__(self, source, size: int):
        self.source = source
        tail = self._at(size - 9, 9)
        n, flags, magic = struct.unpack("<IBI", tail)
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums")
        entries = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.entries, self.at = entries, np.concatenate([[0], np.cumsum(entries[:, 0])])
        index = self.frame(n - 1)
        self.width = struct.unpack_from("<q", index)[0]
        self.doc_ids, self.lengths, self.null = np.frombuffer(index, "<i8", offset=8).reshape(3, -1)
        self.kind = np.dtype(f"<u{self.width}")
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.frame_starts = np.concatenate([[0], np.cumsum(entries[: n - 1, 1])])

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, i: int) -> bytes:
        packed, size, checksum = self.entries[i]
        data = zstandard.ZstdDecompressor().decompress(self._at(int(self.at[i]), int(packed)), max_output_size=int(size))
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return data

    def get(self, doc_id: int) -> np.ndarray:
        """The ids of the first document with this id; decompresses the frames that hold it and no others."""
        first = int(self.null.sum())
        k = first + bisect.bisect_left(self.doc_ids[first:], doc_id)
        if k == len(self.doc_ids) or self.doc_ids[k] != doc_id:
            raise KeyError(doc_id)
        begin, end = int(self.starts[k]) * self.width, int(self.starts[k + 1]) * self.width
        i = int(np.searchsorted(self.frame_starts, begin, "right")) - 1
        base, data = int(self.frame_starts[i]), bytearray()
        while i < len(self.entries) - 1 and self.frame_starts[i] < end:
            data += self.frame(i)
            i += 1
        return np.frombuffer(bytes(data[begin - base : end - base]), self.kind)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, tokens before it in the file, ids) of every document, one frame in memory beside the document."""
        held, i = bytearray(), 0
        for k, n in enumerate(self.lengths.tolist()):
            while len(held) < n * self.width:
                held += self.frame(i)
                i += 1
            ids = np.frombuffer(bytes(held[: n * self.width]), self.kind)
            del held[: n * self.width]
            yield (None if self.null[k] else int(self.doc_ids[k])), int(self.starts[k]), ids


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, frame_bytes: int = 1 << 18) -> DataFrame:
    """Encode and write all documents in order of doc_id; returns the manifest, one row per file."""

    def write(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        name = f"tokens-{TaskContext.get().partitionId():06d}.zst"
        attempt = f"{root}/_{uuid.uuid4().hex}"
        own = encoder(tokenizer)
        end, tokens = np.array([end_id], own.kind).tobytes(), 0
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(attempt) as out:
            writer = FrameWriter(out, own.width, frame_bytes)
            for batch in (s for part in rows for s in slices(part, 2 << 20)):
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.encode(batch.column("text").to_pylist())):
                    writer.add(doc_id, ids + end)
                    tokens += len(ids) // own.width + 1
            writer.close()
        fs.move(attempt, f"{root}/{name}")
        yield batches({"file": [name], "documents": [len(writer.index)], "tokens": [tokens], "bytes": [writer.written]}, _MANIFEST)

    spark = docs.sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = id_and_bytes(docs).repartitionByRange(files, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, "file string, documents long, tokens long, bytes long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as it is in the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file."""

    def read(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        for batch in rows:
            for file, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                with fs.open_input_file(f"{root}/{file}") as source:
                    found = {f.name: [] for f in _READ}
                    for doc_id, start, ids in FrameReader(source, source.size()).documents():
                        row = (doc_id, before + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), file)
                        for column, value in zip(found.values(), row):
                            column.append(value)
                        if len(found["doc_id"]) == 8192:
                            yield batches(found, _READ)
                            found = {f.name: [] for f in _READ}
                    yield batches(found, _READ)

    manifest = spark.read.parquet(f"{folder}/manifest")
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.select("file", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    return placed.repartition(max(1, manifest.count())).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string"
    )
