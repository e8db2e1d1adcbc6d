"""Quality by nearest neighbours in a latent semantic space.

Terms are words (A-Z lower-cased), word shapes (letters and digits each made one character) and runs of one word. Hashed
term weights (1 + log tf) * idf of at most ``per_class`` labelled documents of either class give a truncated singular
value decomposition, by randomised range finding. The labelled documents' unit vectors are broadcast (their number is
bounded by ``per_class``); every document is projected and multiplied with all of them, block by block; the ``k`` nearest
vote with their cosine, and votes are scaled to the class shares of all labels.

Defined cases: null and empty texts, and texts with no positive cosine, score the share of label 1; without labels every
score is 0.5; repeated rows are scored each; a null doc_id is in neither fold (held_out is null); extra columns are not
read; an empty table gives an empty result; a very long text is counted a few megabytes at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.blocks import word_runs
from driftglass.llm.sample import labelled_sample
from driftglass.llm.shared import batch, crc_remainder, tidied
from driftglass.llm.toxicity import learns

TERMS, DIMENSIONS, BLOCK = 8192, 64, 512
#: Letters (and every byte of longer characters) to "a", digits to "0"; all else stays.
SHAPE = bytes(ord("a") if chr(b).isalpha() and b < 128 or b >= 128 else ord("0") if 48 <= b < 58 else b for b in range(256))


@lru_cache(maxsize=200_000)
def _slot(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) % TERMS


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, 1 + log counts) of a whole text, shares of kinds made alike."""
    words: Counter = Counter()
    shapes: Counter = Counter()
    runs, n, last = 0, 0, None
    for part in word_runs((text or "").encode().lower()):
        words.update(part)
        shapes.update(b" ".join(part).translate(SHAPE).split())
        runs += sum(map(bytes.__eq__, part[1:], part)) + (part[0] == last if part else 0)
        n += len(part)
        last = part[-1] if part else last
    if not n:
        return np.zeros(0, np.int64), np.zeros(0)
    slots = np.fromiter((_slot(w) for w in words), np.int64, len(words))
    first = 1 + np.log(np.fromiter(words.values(), float, len(words)))
    other = np.fromiter((_slot(b"\0" + s) for s in shapes), np.int64, len(shapes))
    second = 1 + np.log(np.fromiter(shapes.values(), float, len(shapes)))
    first /= np.sqrt((first**2).sum())
    second /= np.sqrt((second**2).sum())
    same = np.array([_slot(b"\0=")]), np.array([2.0 * runs / n])
    return np.concatenate([slots, other, same[0]]), np.concatenate([first, second, same[1]])



def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [terms(t.as_py()) for t in b.column(0)]
        yield batch(slots=pa.array([s.astype("<i4").tobytes() for s, _ in got], pa.binary()), weights=pa.array([w.astype("<f4").tobytes() for _, w in got], pa.binary()), label=b.column(1))


class Space:
    """idf-weighted projection and the labelled unit vectors."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, int]], totals: dict[int, int], k: int):
        self.k = k
        self.share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
        self.labels = np.array([v for *_, v in rows], float)
        a = np.zeros((len(rows), TERMS), np.float32)
        for r, (slots, weights, _) in zip(a, rows, strict=True):
            np.add.at(r, slots, weights)
        idf = np.log((1 + len(rows)) / (1 + (a > 0).sum(0))) + 1
        a *= idf.astype(np.float32)
        rng = np.random.default_rng(7)
        want = min(DIMENSIONS + 16, max(1, min(a.shape)))
        q = a @ rng.standard_normal((TERMS, want), np.float32) if len(rows) else np.zeros((0, 1), np.float32)
        for _ in range(3):
            q, _ = np.linalg.qr(q)
            q = a @ (a.T @ q)
        q, _ = np.linalg.qr(q)
        _, _, vt = np.linalg.svd(q.T @ a, full_matrices=False)
        self.project = (vt[:DIMENSIONS].T * idf[:, None]).astype(np.float32)
        self.vectors = self.unit(a @ vt[:DIMENSIONS].T)
        ones = self.labels.mean() if len(rows) else 0.5
        # a vote counts for as many labels as its class has per sampled document
        self.votes = np.where(self.labels == 1, self.share / max(ones, 1e-9), (1 - self.share) / max(1 - ones, 1e-9))

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        size = np.sqrt((x * x).sum(1, keepdims=True))
        return (x / np.where(size > 0, size, 1)).astype(np.float32)

    def vector(self, text: str | None) -> np.ndarray:
        slots, weights = terms(text)
        return weights.astype(np.float32) @ self.project[slots] if len(slots) else np.zeros(self.project.shape[1], np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Votes of the nearest labelled vectors, for a block of texts."""
        if not len(self.labels):
            return np.full(len(texts), self.share)
        cosine = self.unit(np.stack([self.vector(t) for t in texts])) @ self.vectors.T
        k = min(self.k, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(float) ** 2 * self.votes[near]
        total = weight.sum(1)
        return np.where(total > 0, (weight * self.labels[near]).sum(1) / np.where(total > 0, total, 1), self.share)


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "quality", per_class: int = 2000, k: int = 25) -> Space:
    sample, totals = labelled_sample(docs, labels, label, learn, per_class)
    rows = sample.mapInArrow(tidied(_collect), "slots binary, weights binary, label int").collect()
    return Space([(np.frombuffer(r.slots, "<i4"), np.frombuffer(r.weights, "<f4"), r.label) for r in rows], totals, k)


def _score(batches: Iterator[pa.RecordBatch], space) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(b.num_columns - 1)
        parts = [space.value.score([t.as_py() for t in texts[at : at + BLOCK]]) for at in range(0, b.num_rows, BLOCK)]
        scores = np.concatenate(parts) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.clip(scores, 0, 1), pa.float64())], names=[*b.schema.names[:-1], "score"])


def predict(docs: DataFrame, labels: DataFrame, per_class: int = 2000, k: int = 25) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    space = docs.sparkSession.sparkContext.broadcast(train(docs, labels, learns(3, 1), per_class=per_class, k=k))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_remainder("doc_id", 3) == 1).alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(tidied(partial(_score, space=space)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
