"""Word blocks, and key counts that blocks ask for and get back.

A block holds some thousand documents as arrays of local word numbers plus one 64-bit hash per distinct word. Corpus
statistics over blocks go through ``ask``: every block sends its distinct keys, dealt by hash over buckets, and each
bucket answers every block in the order asked. So a key crosses the network once per block instead of once per
occurrence, a frequent key weighs no more than a rare one, and nothing is broadcast or collected.

Words are those of ``bytes.split`` after ``bytes.lower``: runs of bytes outside 0x09-0x0D and 0x20, A-Z lower-cased.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.shared import batch, tidied

BLOCK = "block string, docs array<bigint>, folds array<bigint>, ends binary, words binary, vocab binary"
CHUNK = 1 << 22
GAPS = b" \t\n\r\x0b\x0c"


def word_runs(raw: bytes) -> Iterator[list[bytes]]:
    """Lists of words of a lower-cased text, a few megabytes of it at a time."""
    if len(raw) <= CHUNK:
        yield raw.split()
        return
    at = 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw) and raw[end] not in GAPS:
            end += 1
        yield raw[at:end].split()
        at = end


def _block(docs, folds, parts, ends, vocab) -> pa.RecordBatch:
    words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))
    return batch(
        block=pa.array([uuid.uuid4().hex]),
        docs=pa.array([docs], pa.list_(pa.int64())),
        folds=pa.array([folds], pa.list_(pa.int64())),
        ends=pa.array([np.array(ends, "<i8").tobytes()], pa.binary()),
        words=pa.array([words.astype("<i4").tobytes()], pa.binary()),
        vocab=pa.array([hashes.tobytes()], pa.binary()),
    )


def _blocks(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    docs, folds, parts, ends, size = [], [], [], [], 0
    number = defaultdict(count().__next__)
    for b in batches:
        for d, fold, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            raw = (text.as_py() or "").encode().lower()
            for run in word_runs(raw):
                parts.append(np.fromiter(map(number.__getitem__, run), np.int32, len(run)))
                size += len(run)
            docs.append(d), folds.append(fold), ends.append(size)
            if size >= words:
                yield _block(docs, folds, parts, ends, number)
                docs, folds, parts, ends, size = [], [], [], [], 0
                number = defaultdict(count().__next__)
    if docs:
        yield _block(docs, folds, parts, ends, number)


def word_blocks(docs: DataFrame, fold=None, words: int = 1_000_000) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text) with an optional integer column expression per document. Store before use."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.lit(None) if fold is None else fold).cast("long").alias("fold"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidied(partial(_blocks, words=words)), BLOCK)


class Block:
    """One stored block with numpy views."""

    def __init__(self, row: dict):
        self.block, self.docs, self.folds = row["block"], row["docs"], row["folds"]
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.words = np.frombuffer(row["words"], "<i4")
        self.vocab = np.frombuffer(row["vocab"], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads the low bits of sums and products over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: a block is large, so never a list of all rows of a batch."""
    for b in batches:
        for k in range(b.num_rows):
            yield {name: b.column(i)[k].as_py() for i, name in enumerate(b.schema.names)}


def dealt(block: str, order: np.ndarray, buckets: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per bucket with the parts of ``columns`` (already in ``order``) as bytes, in slices of some hundred buckets."""
    if not len(order):
        return
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(buckets)]])
    for k in range(0, len(begin), 256):
        pairs = list(zip(begin[k : k + 256].tolist(), end[k : k + 256].tolist(), strict=True))
        yield batch(
            bucket=pa.array(buckets[begin[k : k + 256]].astype(np.int32), pa.int32()),
            block=pa.array([block] * len(pairs)),
            **{name: pa.array([v[i:j].tobytes() for i, j in pairs], pa.binary()) for name, v in columns.items()},
        )


def bucket_count(df: DataFrame, least: int = 64) -> int:
    """Buckets follow the cluster's shuffle partitions, a few per partition, so that they even out."""
    return max(least, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def by_bucket(rows: Iterator[dict]) -> Iterator[tuple[int, list[dict]]]:
    """Groups of rows with equal bucket from a partition sorted by bucket."""
    held: list[dict] = []
    for row in rows:
        if held and held[0]["bucket"] != row["bucket"]:
            yield held[0]["bucket"], held
            held = []
        held.append(row)
    if held:
        yield held[0]["bucket"], held
