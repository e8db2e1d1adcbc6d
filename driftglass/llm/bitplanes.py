"""Token-id files in a bit-plane layout.

Ids are cut into blocks of a fixed number of ids. A block is transposed into byte planes (first all low bytes, then all
second bytes, ...) or bit planes, and every plane is compressed by itself with zstandard. The footer holds the chunk
index (offset and size of every plane, ids of every block), the document ids and their id counts, so any document can be
read by decoding only the blocks it touches.

Documents are written in ascending order of doc_id (null first; equal ids by text) over range-partitioned files. A task
writes under a name of its own; only files of finished tasks get into the manifest, so a retried task leaves no trace in
the result; files of attempts that did not finish are deleted.

Defined cases: null and empty texts are the end id alone; an empty table gives no files and an empty result; repeated
rows are written each; extra columns are not read; a very long text runs over as many blocks as it needs.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.shared import batch, drop_others, keep, shared_dir, tidied
from driftglass.llm.tokens import byte_bpe_path, encoder

MAGIC = b"DGPLANE1"
MANIFEST = "part long, file string, n_docs long, n_ids long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def split_planes(ids: np.ndarray, bits: bool) -> np.ndarray:
    """uint32 ids to planes, one per row: 4 byte planes, or 32 bit planes of packed bits."""
    by_byte = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if not bits:
        return np.ascontiguousarray(by_byte)
    return np.packbits(np.unpackbits(np.ascontiguousarray(by_byte)[:, :, None], axis=2, bitorder="little").transpose(0, 2, 1).reshape(32, -1), axis=1)


def join_planes(planes: np.ndarray, n: int, bits: bool) -> np.ndarray:
    if bits:
        each = np.unpackbits(planes, axis=1, count=n).reshape(4, 8, n).transpose(0, 2, 1)
        planes = np.packbits(each, axis=2, bitorder="little")[:, :, 0]
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


class PlaneWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, out, block_ids: int = 65_536, bits: bool = False, level: int = 3):
        self.out, self.block_bytes, self.bits = out, 4 * block_ids, bits
        self.zip = zstandard.ZstdCompressor(level=level)
        self.at, self.waiting, self.size = len(MAGIC), [], 0
        self.index: list[list[int]] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, blob: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(blob) // 4)
        self.waiting.append(blob)
        self.size += len(blob)
        if self.size >= self.block_bytes:
            whole = b"".join(self.waiting)
            cut = len(whole) - len(whole) % self.block_bytes
            for k in range(0, cut, self.block_bytes):
                self._block(whole[k : k + self.block_bytes])
            self.waiting, self.size = [whole[cut:]], len(whole) - cut

    def _block(self, raw: bytes) -> None:
        sizes = []
        for plane in split_planes(np.frombuffer(raw, "<u4"), self.bits):
            packed = self.zip.compress(plane.tobytes())
            self.out.write(packed)
            sizes.append(len(packed))
        self.index.append([self.at, len(raw) // 4, *sizes])
        self.at += sum(sizes)

    def close(self) -> int:
        """Write the footer; the ids of the whole file."""
        if self.size:
            self._block(b"".join(self.waiting))
        null = [k for k, d in enumerate(self.docs) if d is None]
        head = self.zip.compress(json.dumps({"bits": self.bits, "index": self.index, "nulls": null}).encode())
        ids = self.zip.compress(np.array([d or 0 for d in self.docs], "<i8").tobytes())
        counts = self.zip.compress(np.array(self.counts, "<i8").tobytes())
        self.out.write(head + ids + counts + struct.pack("<QQQ", len(head), len(ids), len(counts)) + MAGIC)
        return sum(self.counts)


def read_docs(f) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids as little-endian bytes) of every document of an open, seekable file; one block in memory at a time."""
    unzip = zstandard.ZstdDecompressor()
    f.seek(0, 2)
    end = f.tell()
    f.seek(end - 24 - len(MAGIC))
    tail = f.read(24 + len(MAGIC))
    if tail[24:] != MAGIC:
        raise ValueError("not a plane file")
    sizes = struct.unpack("<QQQ", tail[:24])
    f.seek(end - 24 - len(MAGIC) - sum(sizes))
    head = json.loads(unzip.decompress(f.read(sizes[0])))
    docs = np.frombuffer(unzip.decompress(f.read(sizes[1])), "<i8").tolist()
    counts = np.frombuffer(unzip.decompress(f.read(sizes[2])), "<i8").tolist()
    for k in head["nulls"]:
        docs[k] = None

    def blocks() -> Iterator[bytes]:
        for at, n, *planes in head["index"]:
            f.seek(at)
            raw = f.read(sum(planes))
            rows, here = [], 0
            for size in planes:
                rows.append(np.frombuffer(unzip.decompress(raw[here : here + size]), np.uint8))
                here += size
            yield join_planes(np.stack(rows), n, head["bits"]).tobytes()

    source, buffer, at = blocks(), b"", 0
    for doc, n in zip(docs, counts, strict=True):
        while len(buffer) - at < 4 * n:
            buffer, at = buffer[at:] + next(source), 0
        yield doc, buffer[at : at + 4 * n]
        at += 4 * n


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, block_ids: int, bits: bool) -> Iterator[pa.RecordBatch]:
    enc, end, part = encoder(path), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
    store, base = _open(folder)
    name, writer, out = f"part-{part:06d}-{uuid.uuid4().hex}.planes", None, None
    for b in batches:
        for d, own in zip(b.column(0).to_pylist(), enc.encode_many(b.column(1).to_pylist()), strict=True):
            if writer is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}")
                writer = PlaneWriter(out, block_ids, bits)
            writer.add(d, own + end)
    if writer is not None:
        n = writer.close()
        out.close()
        yield batch(part=pa.array([part], pa.int64()), file=pa.array([f"{folder}/{name}"]), n_docs=pa.array([len(writer.docs)], pa.int64()), n_ids=pa.array([n], pa.int64()))


def write_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0, block_ids: int = 65_536, bits: bool = False) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into plane files below ``folder``; returns the stored manifest, a row per file."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(tidied(partial(_write, folder=f"{folder}/planes", path=tokenizer or byte_bpe_path(), end_id=end_id, block_ids=block_ids, bits=bits)), MANIFEST)
    manifest = keep(files, f"{folder}/manifest")
    drop_others(docs.sparkSession, f"{folder}/planes", {r.file for r in manifest.select("file").collect()})  # a row per file
    return manifest


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            store, at = _open(uri)
            doc, begin, n, crc = [], [], [], []
            with store.open_input_file(at) as f:
                for d, blob in read_docs(f):
                    doc.append(d), begin.append(start), n.append(len(blob) // 4), crc.append(zlib.crc32(blob))
                    start += len(blob) // 4
            yield batch(doc_id=pa.array(doc, pa.int64()), start=pa.array(begin, pa.int64()), n_tokens=pa.array(n, pa.int64()), ids_crc32=pa.array(crc, pa.int64()))


def read_files(manifest: DataFrame) -> DataFrame:
    """Digest of every document, read from the files of a manifest (one row per file goes over the driver)."""
    spark, rows, start = manifest.sparkSession, [], 0
    for _, uri, _, n in sorted(manifest.collect()):
        rows.append((uri, start))
        start += n
    tasks = spark.createDataFrame(rows, "file string, start long")
    return tasks.repartition(max(1, len(rows))).mapInArrow(tidied(_read), DOCS)


def round_trip(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` and read the files back."""
    return read_files(write_files(docs, folder or shared_dir(docs.sparkSession), **options))
