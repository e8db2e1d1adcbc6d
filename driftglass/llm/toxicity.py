"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is the rates of its n-grams of 3 to 5 characters (lower-cased, blanks included, so that they see the edges of
words), occurrences a thousand n-grams; a text of under ``FLOOR`` n-grams counts as one of FLOOR. For every n-gram, r is the log ratio of its smoothed document shares in toxic and other
texts. A logistic regression is fitted on rates times r, on at most ``per_class`` labelled documents of either class; its
weights times r are one small table by the n-grams' 64-bit hashes, shipped to every task. Whole texts are scored, long ones piece by
piece; as rates don't grow with the text, its length alone moves no score.

Defined cases: null and empty texts score by the intercept alone; without labels of both classes every score is the share
of toxic labels (0 without any); repeated rows are scored each; a null doc_id is in neither fold (held_out is null);
extra columns are not read; an empty table gives an empty result; ``reject`` keeps every column as it is.

Whole rows go through the workers of ``reject``, so it stores what it keeps: a caller's write would send them in batches of
the session's size, 10,000 rows by default, each held several times by the executor and the worker at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.blocks import mix
from driftglass.llm.sample import labelled_sample, prior_shift
from driftglass.llm.shared import batch, crc_remainder, drop_folder, keep, shared_dir, tidied

ORDERS, PIECE, FLOOR, SLOT_BITS, FEW = (3, 4, 5), 1 << 18, 300, 20, 128


def points_of(text: str | None) -> np.ndarray:
    """Code points of a lower-cased text."""
    return np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")


def _keys(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n characters."""
    if len(points) < n:
        return np.zeros(0, np.int64)
    x = points.astype(np.uint64)
    word = np.full(len(x) - n + 1, n, np.uint64)
    for k in range(n):
        word = word * np.uint64(0x9E3779B97F4A7C15) + x[k : len(x) - n + 1 + k]
    return mix(word).view(np.int64)


def gram_ids(points: np.ndarray) -> np.ndarray:
    """Keys of the n-grams of all ORDERS, repeats included."""
    return np.concatenate([_keys(points, n) for n in ORDERS])


def pieces(text: str | None) -> Iterator[np.ndarray]:
    """Keys of the n-grams of a whole text, each occurrence once, by stretches of the text."""
    points = points_of(text)
    for at in range(0, len(points), PIECE):
        yield np.concatenate([_keys(points[at : at + PIECE + n - 1], n) for n in ORDERS])


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct n-gram keys of a whole text and how often each occurs."""
    ids, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for piece in pieces(text):
        more, n = np.unique(piece, return_counts=True)
        if len(ids):
            more, inverse = np.unique(np.concatenate([ids, more]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([counts, n]), minlength=len(more)).astype(np.int64)
        ids, counts = more, n
    return ids, counts


def features(text: str | None) -> np.ndarray:
    """Ascending distinct n-gram keys of a whole text."""
    return counted(text)[0]


def per_thousand(n_grams):
    return 1000 / np.maximum(n_grams, FLOOR)


class Lookup:
    """Places of keys in an ascending array. A table of their leading bits sorts out most other keys."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.there = np.zeros(1 << SLOT_BITS, bool)
        self.there[self._slots(ids)] = True

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices of ``keys`` that are there, their places)."""
        at = np.flatnonzero(self.there[self._slots(keys)])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.ids, keys[at]), len(self.ids) - 1)
        same = self.ids[place] == keys[at]
        return at[same], place[same]


@dataclass
class Model:
    ids: np.ndarray
    weights: np.ndarray
    intercept: float

    @cached_property
    def lookup(self) -> Lookup:
        return Lookup(self.ids)

    def score(self, text: str | None) -> float:
        total, n = 0.0, 0
        for piece in pieces(text):
            total += float(self.weights[self.lookup.find(piece)[1]].sum(dtype=np.float64))
            n += len(piece)
        z = total * float(per_thousand(n)) + self.intercept
        return 1 / (1 + math.exp(-min(z, 700.0))) if z > -700 else 0.0


def _collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, FEW):  # a document's n-grams take some 60 kB
            b = whole.slice(at, FEW)
            rows = [counted(t.as_py()) for t in b.column(0)]
            yield batch(ids=pa.array([i.tobytes() for i, _ in rows], pa.binary()), counts=pa.array([n.astype(np.int32).tobytes() for _, n in rows], pa.binary()), label=b.column(1))


def _documents_with(ids: list[np.ndarray], labels: list[int]) -> pa.RecordBatch:
    there, inverse = np.unique(np.concatenate(ids), return_inverse=True)
    toxic = np.bincount(inverse, np.repeat(labels, [len(i) for i in ids]), minlength=len(there)).astype(np.int64)
    return batch(id=pa.array(there), c0=pa.array(np.bincount(inverse, minlength=len(there)) - toxic), c1=pa.array(toxic))


def _count(batches: Iterator[pa.RecordBatch], most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    ids, labels, n = [], [], 0
    for b in batches:
        for x, v in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            ids.append(np.frombuffer(x.as_py(), np.int64))
            labels.append(v)
            n += len(ids[-1])
            if n >= most:
                yield _documents_with(ids, labels)
                ids, labels, n = [], [], 0
    if ids:
        yield _documents_with(ids, labels)


def telling_grams(features: DataFrame, n0: int, n1: int, least: int = 3, deviations: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys and log ratios of the n-grams that tell the classes apart, in either direction.

    Those are in at least ``least`` sample documents, with a log ratio that is ``deviations`` standard errors from none.
    """
    counts = features.select("ids", "label").mapInArrow(tidied(_count), "id long, c0 long, c1 long").groupBy("id").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    ratio = F.ln((F.col("c1") + 0.5) / (n1 + 1)) - F.ln((F.col("c0") + 0.5) / (n0 + 1))
    error = F.sqrt(1 / (F.col("c1") + 0.5) + 1 / (F.col("c0") + 0.5))
    found = counts.withColumn("ratio", ratio).where((F.col("c0") + F.col("c1") >= least) & (F.abs("ratio") >= deviations * error))
    rows = sorted((r.id, r.ratio) for r in found.select("id", "ratio").collect())  # thousands: the sample is bounded
    return np.array([i for i, _ in rows], np.int64), np.array([r for _, r in rows], float)


def _keep_telling(batches: Iterator[pa.RecordBatch], telling: np.ndarray) -> Iterator[pa.RecordBatch]:
    lookup = Lookup(telling)
    for b in (whole.slice(at, FEW) for whole in batches for at in range(0, whole.num_rows, FEW)):
        places, rates = [], []
        for ids, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            n = np.frombuffer(counts, np.int32)
            at, place = lookup.find(np.frombuffer(ids, np.int64))
            places.append(place.astype(np.int32).tobytes())
            rates.append((n[at] * per_thousand(int(n.sum()))).astype(np.float32).tobytes())
        yield batch(places=pa.array(places, pa.binary()), rates=pa.array(rates, pa.binary()), label=b.column(2))


def fit(rows: Iterable[tuple[np.ndarray, np.ndarray, int]], ids: np.ndarray, ratio: np.ndarray, shift: float = 0.0, strength: float = 1.0, steps: int = 120) -> Model:
    """Logistic regression on the rates of n-grams times their ratios. ``rows``: places in ``ids``, rates, label."""
    size, rows, blocks, y = len(ids), iter(rows), [], []
    while some := list(islice(rows, 256)):  # the driver holds 8 bytes an n-gram, and the passing arrays of one block
        place = np.concatenate([p for p, _, _ in some])
        value = np.concatenate([r for _, r, _ in some]) * ratio[place].astype(np.float32)
        blocks.append((slice(len(y), len(y) + len(some)), place, value, [len(p) for p, _, _ in some]))
        y += [v for *_, v in some]
    y = np.array(y, float)
    # full-batch Adam on the regularised log loss
    w, b = np.zeros(size), 0.0
    m, s = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        g = np.append(strength * w / len(y), 0.0)
        for at, place, value, lengths in blocks:
            owner = np.repeat(np.arange(len(lengths)), lengths)
            z = np.bincount(owner, w[place] * value, minlength=len(lengths)) + b
            off = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[at]) / len(y)
            g[:-1] += np.bincount(place, value * off[owner], minlength=size)
            g[-1] += off.sum()
        m = 0.9 * m + 0.1 * g
        s = 0.99 * s + 0.01 * g * g
        move = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(ids, w * ratio, float(b + shift))


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic", per_class: int = 4000) -> Model:
    """Fit on a bounded sample. Only telling n-grams of its documents come to the driver, a few kilobytes each."""
    sample, totals = labelled_sample(docs, labels, label, learn, per_class)
    folder = shared_dir(docs.sparkSession)
    features = keep(sample.mapInArrow(tidied(_collect_features), "ids binary, counts binary, label int"), f"{folder}/features")
    n = {r["label"]: r["count"] for r in features.groupBy("label").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        share = totals.get(1, 0) / max(1, sum(totals.values()))
        return Model(np.zeros(0, np.int64), np.zeros(0), math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    ids, ratio = telling_grams(features, n0, n1)
    rows = features.mapInArrow(tidied(partial(_keep_telling, telling=ids)), "places binary, rates binary, label int").toLocalIterator()  # a part at a time
    model = fit(((np.frombuffer(r.places, np.int32), np.frombuffer(r.rates, np.float32), r.label) for r in rows), ids, ratio, prior_shift(totals, n0, n1))
    drop_folder(docs.sparkSession, f"{folder}/features")
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        scores = [model.score(t.as_py()) for t in b.column(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], names=[*b.schema.names[:-1], "score"])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with score."""
    kept = [c for c in docs.columns if c not in ("text", "score")]
    schema = docs.select(*kept).schema.add("score", "double")
    return docs.select(*kept, F.col("text").cast("string").alias("text")).mapInArrow(tidied(partial(_score, model=model)), schema)


def learns(modulus: int, held: int):
    return crc_remainder("doc_id", modulus) != held


def predict(docs: DataFrame, labels: DataFrame, per_class: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(docs, labels, learns(5, 0), per_class=per_class)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return score_documents(rows, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _reject(batches: Iterator[pa.RecordBatch], model: Model, at: int) -> Iterator[pa.RecordBatch]:
    for b in (whole.slice(first, FEW) for whole in batches for first in range(0, whole.num_rows, FEW)):
        yield b.filter(pa.array([model.score(t.as_py()) < 0.5 for t in b.column(at)], pa.bool_()))


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model doesn't predict toxic, as they are: a stage table."""
    left = docs.mapInArrow(tidied(partial(_reject, model=model, at=docs.columns.index("text"))), docs.schema)
    return keep(left, f"{shared_dir(docs.sparkSession)}/left")
