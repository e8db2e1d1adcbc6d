"""Best-fit packing of token pieces into sequences: pattern packing by non-negative least squares.

The plan is made from the length histogram alone (at most ``capacity`` numbers, whatever the corpus):

1. enumerate patterns of one, two or three lengths that fill a sequence exactly;
2. fit non-negative repeat counts of the patterns to the histogram by weighted least squares (accelerated projected
   gradient; a column has at most three entries, so a step is two gathers and a bincount);
3. round the counts so that no length is used more often than it occurs;
4. pack what is left by best fit, longest first, on (length, count) runs.

Pieces then get a rank among the pieces of their length, from counts of (length, salt) groups, and a range join with the
plan (a few thousand runs, bounded by the capacity) turns ranks into sequence ids and offsets. A length gets as many salts
as its pieces need, so the largest sort is bounded whatever the corpus and however many pieces share a length.

Defined cases: null and empty texts are the end id alone; equal rows are packed each; a document id may be null; extra
columns of the input are not read; an empty table gives an empty result; a very long text becomes as many pieces as it
needs, one text at a time in memory.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftglass.llm.shared import batch, keep, shared_dir, tidied
from driftglass.llm.tokens import byte_bpe_path, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces ranked together: few in a small corpus, so that its tasks even out; at most MOST_RANKED.
LEAST_RANKED, MOST_RANKED, BROADCAST_ROWS = 1 << 10, 1 << 18, 1 << 18


def salts_for(n: int) -> int:
    """Groups to split ``n`` pieces of one length into."""
    return max(1, min(64, -(-n // LEAST_RANKED)), -(-n // MOST_RANKED))


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, ids: bool) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(path), np.array([end_id], "<u4").tobytes()
    for b in batches:
        doc, piece, start, length, crc, raw = [], [], [], [], [], []
        for d, own in zip(b.column(0).to_pylist(), enc.encode_many(b.column(1).to_pylist()), strict=True):
            blob = own + end
            n = len(blob) // 4
            at = 0
            for k in range(-(-n // capacity)):
                # the first piece takes what does not fill a sequence
                size = (n - 1) % capacity + 1 if k == 0 else capacity
                part = blob[4 * at : 4 * (at + size)]
                doc.append(d), piece.append(k), start.append(at), length.append(size), crc.append(zlib.crc32(part))
                if ids:
                    raw.append(part)
                at += size
        cols = {"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
        yield batch(**cols, **({"ids": pa.array(raw, pa.binary())} if ids else {}))


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids per document; with ``ids`` also the ids, as little-endian bytes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidied(partial(_cut, path=tokenizer or byte_bpe_path(), capacity=capacity, end_id=end_id, ids=ids)), PIECES + (", ids binary" if ids else ""))


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to three occurring lengths (0: unused slot), descending, that add up to ``capacity``."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    found = [np.array([[capacity, 0, 0]])] if have[capacity] else []
    a = np.arange(1, capacity)
    two = np.stack([a, capacity - a, np.zeros_like(a)], 1)
    found.append(two[(two[:, 0] >= two[:, 1]) & have[two[:, 0]] & have[two[:, 1]]])
    x, y = np.meshgrid(lengths, lengths, indexing="ij")
    z = capacity - x - y
    ok = (x >= y) & (y >= z) & (z > 0)
    x, y, z = x[ok], y[ok], z[ok]
    three = np.stack([x, y, z], 1)
    found.append(three[have[z]])
    return np.concatenate(found).astype(np.int64)


def fit_patterns(pats: np.ndarray, hist: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative repeat counts x that minimise sum_l w_l ((A x)_l - hist_l)^2, w_l growing with the length."""
    n = len(hist)
    if not len(pats):
        return np.zeros(0)
    weight = np.arange(n) / (n - 1.0)
    weight[0] = 0
    # the step size is bounded by the largest row sum of A'WA
    use = np.bincount(pats.ravel(), minlength=n).astype(float)
    row = (weight * use)[pats].sum(1)
    step = 1.0 / max(row.max() * 3, 1e-9)
    x = np.zeros(len(pats))
    y, t = x.copy(), 1.0
    for _ in range(steps):
        off = np.bincount(pats.ravel(), np.repeat(y, 3), minlength=n) - hist
        new = np.maximum(0, y - step * (weight * off)[pats].sum(1))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(hist: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequence layouts and how often each is used; uses up the histogram exactly."""
    left = hist.astype(np.int64).copy()
    runs: list[tuple[tuple[int, ...], int]] = []
    lengths = np.nonzero(left)[0]
    pats = patterns(lengths, capacity)
    fitted = fit_patterns(pats, hist.astype(float))
    order = np.argsort(-fitted, kind="stable")
    for k in order[: int((fitted > 0.5).sum())]:
        slots = [int(v) for v in pats[k] if v]
        often = int(round(fitted[k]))
        for v in set(slots):
            often = min(often, int(left[v]) // slots.count(v))
        if often > 0:
            runs.append((tuple(slots), often))
            for v in slots:
                left[v] -= often
    return runs + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: equal sequences are one run, so the work does not grow with the pieces."""
    bins: dict[int, list[list]] = {}
    spaces: list[int] = []

    def put(space: int, slots: tuple[int, ...], often: int) -> None:
        if space not in bins:
            bins[space] = []
            insort(spaces, space)
        bins[space].append([slots, often])

    for v in range(capacity, 0, -1):
        count = int(left[v])
        while count:
            k = bisect_left(spaces, v)
            if k == len(spaces):
                space, slots, often = capacity, (), count
            else:
                space = spaces[k]
                slots, often = bins[space].pop()
                if not bins[space]:
                    del bins[space], spaces[k]
            each = space // v
            full, rest = divmod(count, each)
            if full >= often:
                full, rest, unused = often, 0, 0
            else:
                unused = often - full - (rest > 0)
            if not slots:
                unused = 0
            if full:
                put(space - each * v, slots + (v,) * each, full)
            if rest:
                put(space - rest * v, slots + (v,) * rest, 1)
            if unused > 0:
                put(space, slots, unused)
            count -= full * each + rest
    return [(slots, often) for space in spaces for slots, often in bins[space]]


def slot_rows(runs: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) for every slot of every run."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for slots, often in runs:
        at = 0
        for v in slots:
            r = rank.get(v, 0)
            rows.append((v, r, r + often, sequence, at))
            rank[v] = r + often
            at += v
        sequence += often
    return rows


def pack_pieces(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces (it is read three times, twice for lengths alone).

    ``pieces`` needs doc_id, piece and length (1 to ``capacity``); all its columns are kept.
    """
    spark = pieces.sparkSession
    hist = np.zeros(capacity + 1, np.int64)
    for v, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        hist[v] = n
    slots = spark.createDataFrame(slot_rows(plan(hist, capacity)), "_length long, _from long, _to long, _sequence long, _offset long")
    salts = spark.createDataFrame([(v, salts_for(n)) for v, n in enumerate(hist.tolist()) if n], "length long, _salts int")
    salted = pieces.join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_salts"))).drop("_salts")
    of_length = Window.partitionBy("length").orderBy("_salt")
    bases = salted.groupBy("length", "_salt").count().withColumn("_base", F.sum("count").over(of_length) - F.col("count")).drop("count")
    if sum(salts_for(n) for n in hist.tolist() if n) <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    same = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("_nth", F.row_number().over(same) - 1)
    ranked = ranked.join(bases, ["length", "_salt"]).withColumn("_rank", F.col("_base") + F.col("_nth"))
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return placed.select(*pieces.columns, (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), F.col("_offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text): one row per piece with its place."""
    pieces = keep(cut_pieces(docs, tokenizer, capacity, end_id, ids), f"{shared_dir(docs.sparkSession)}/pieces")
    return pack_pieces(pieces, capacity)
