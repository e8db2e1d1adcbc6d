"""Language identification by cross-parsing.

For every language a suffix automaton is built from a bounded sample of its texts. A text is parsed into the longest
phrases that occur in the sample: from the root, one transition a character, a new phrase where none is left; a character
the sample doesn't have is a phrase of its own. The language with the fewest phrases, each weighed by the logarithm of its
sample's size, wins; ties go to the lesser name.

Characters are classes: the letters of a language's sample, lower-cased, one class for every other letter and one for all
else. Texts are parsed whole. A numpy step moves thousands of stretches of ``STRETCH`` characters on at once, each as if a
phrase began with it. The parse of the stretch before then goes on into it until both begin a phrase at one character:
from there they are the same. Where they never do, the parse goes on character by character.

Defined cases: null texts and texts without letters are ``und`` with score 0, and so is everything if there is nothing to
learn from; repeated rows are judged each; a null doc_id is in neither fold and teaches nothing; extra columns are not
read; an empty table gives an empty result; a very long text is parsed like any other, one a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.shared import batch, crc_remainder, tidied

STRETCH, BATCH_CHARS, POINTS = 256, 4 << 20, 0x110000
#: Bytes of the dense tables of all languages together; languages beyond their share are kept as sorted transitions.
DENSE_BYTES = 256 << 20


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``codes``; state 1 is the root, 0 is none."""
    goto: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in codes:
        new = len(goto)
        goto.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p and c not in goto[p]:
            goto[p][c] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = goto[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(goto)
                goto.append(dict(goto[q])), link.append(link[q]), length.append(length[p] + 1)
                while p and goto[p].get(c) == q:
                    goto[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return goto


class Dense:
    """Transitions as one table, states as row offsets: one addition and one take a step."""

    def __init__(self, goto: list[dict[int, int]], width: int):
        table = np.zeros((len(goto), width), np.int32)
        for state, out in enumerate(goto):
            for c, to in out.items():
                table[state, c] = to * width
        self.table, self.root = table.ravel(), width

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        return self.table[state + c]

    def step_one(self, state: int, c: int) -> int:
        return int(self.table[state + c])


class Sparse:
    """Transitions sorted by state and class, for large alphabets: a few bytes a transition."""

    def __init__(self, goto: list[dict[int, int]], width: int):
        rows = sorted((state * width + c, to * width) for state, out in enumerate(goto) for c, to in out.items())
        self.keys = np.array([k for k, _ in rows], np.int64)
        self.to = np.array([t for _, t in rows], np.int64)
        self.root = width

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) + c
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], 0)

    def step_one(self, state: int, c: int) -> int:
        at = int(np.searchsorted(self.keys, state + c))
        return int(self.to[at]) if at < len(self.keys) and self.keys[at] == state + c else 0


@lru_cache(maxsize=1)
def letter_flags() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(p).isalpha() for p in range(POINTS)), bool, POINTS)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


class Language:
    """One automaton over the letters of its own sample. Classes: 0 no letter, 1 a letter the sample doesn't have, then its own."""

    def __init__(self, sample: str, dense_bytes: int):
        points = points_of(sample)
        self.letters = np.unique(points[letter_flags()[points]])
        codes = self.codes(points)
        goto, width = suffix_automaton(codes.tolist()), len(self.letters) + 2
        small = 4 * len(goto) * width <= min(dense_bytes, 1 << 31)
        self.automaton = Dense(goto, width) if small else Sparse(goto, width)
        self.weight = float(np.log2(max(2, len(codes))))

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Classes by a table over the code points that occur: few, with many of each."""
        if not len(points):
            return np.zeros(0, np.int32)
        there = np.zeros(int(points.max()) + 1, bool)
        there[points] = True
        names = np.flatnonzero(there)
        own = np.minimum(np.searchsorted(self.letters, names), max(0, len(self.letters) - 1))
        known = self.letters[own] == names if len(self.letters) else np.zeros(len(names), bool)
        table = np.zeros(len(there), np.int32)
        table[names] = np.where(known, own + 2, letter_flags()[names])
        return table[points]

    def phrases(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of every text of ``codes``, texts one after another up to ``ends``."""
        step, root = self.automaton.step, self.automaton.root
        sizes = np.diff(np.concatenate([[0], ends]))
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(ends)), pieces)
        first = np.cumsum(pieces) - pieces
        begin = (ends - sizes)[owner] + (np.arange(len(owner)) - first[owner]) * STRETCH
        stop = np.minimum(begin + STRETCH, ends[owner])
        n = len(owner)
        starts = np.zeros(len(codes) + 1, np.int32)  # where a phrase begins, if one begins with each stretch
        state = np.full(n, 0, np.int64)
        order = np.argsort(begin - stop, kind="stable")  # the stretches still running are always a front part
        live = np.searchsorted((begin - stop)[order], -np.arange(1, STRETCH + 1), side="right")
        for t in range(STRETCH):
            on = order[: live[t]]
            if not len(on):
                break
            at = begin[on] + t
            c = codes[at]
            to = step(state[on], c) if t else np.zeros(len(on), np.int64)
            fresh = np.flatnonzero(to == 0)
            starts[at[fresh]] = 1
            to[fresh] = step(np.full(len(fresh), root), c[fresh])
            state[on] = to
        # the parse of each stretch goes on into the next one of its text, until both begin a phrase at one place
        has_next = np.flatnonzero(owner[1:] == owner[:-1]) if n else np.zeros(0, np.int64)
        more = np.zeros(n, np.int64)  # phrases that begin in stretch k by the parse of stretch k - 1, before the two meet
        meet = np.full(n, -1, np.int64)
        on, going = has_next + 1, state[has_next]
        after = np.zeros(n, np.int64)
        for t in range(STRETCH):
            inside = begin[on] + t < stop[on]
            after[on[~inside]] = going[~inside]
            on, going = on[inside], going[inside]
            if not len(on):
                break
            at = begin[on] + t
            c = codes[at]
            to = step(going, c)
            fresh = to == 0
            met = fresh & (starts[at] == 1)
            meet[on[met]] = at[met]
            more[on[fresh & ~met]] += 1
            again = np.flatnonzero(fresh & ~met)
            to[again] = step(np.full(len(again), root), c[again])
            on, going = on[~met], to[~met]
        after[on] = going
        total = np.concatenate([[0], np.cumsum(starts)])
        lead = np.zeros(n, bool)
        lead[first[pieces > 0]] = True
        meet[lead] = begin[lead]
        own = more + np.where(meet >= 0, total[stop] - total[np.maximum(meet, 0)], 0)
        out = np.bincount(owner, own, minlength=len(ends)).astype(np.int64)
        done = -1
        for k in np.flatnonzero(meet < 0).tolist():
            # stretches that the parse ran through without meeting: what follows is not what was assumed
            if k <= done:
                continue
            s, p, j, doc = int(after[k]), int(stop[k]), k + 1, int(owner[k])
            while j < n and owner[j] == doc:
                out[doc] -= int(own[j])
                found = -1
                while p < stop[j]:
                    c = int(codes[p])
                    to = self.automaton.step_one(s, c)
                    if not to:
                        if starts[p]:
                            found = p
                            break
                        out[doc] += 1
                        to = self.automaton.step_one(root, c)
                    s, p = to, p + 1
                if found >= 0:
                    out[doc] += int(total[stop[j]] - total[found])
                    break
                j += 1
            done = j  # stretch j is settled, and the next one was entered by its own parse
        return out


class Parser:
    """All languages, by name."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        share = DENSE_BYTES // max(1, len(samples))
        self.parsers = [Language(samples[name], share) for name in self.languages]

    def phrases(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrase counts, a row per text and a column per language."""
        return np.stack([p.phrases(p.codes(points), ends) for p in self.parsers], 1)

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        each = [points_of(t or "") for t in texts]
        points, ends = np.concatenate(each), np.cumsum([len(p) for p in each])
        cost = self.phrases(points, ends) * np.array([p.weight for p in self.parsers])
        letters = np.concatenate([[0], np.cumsum(letter_flags()[points])])
        has = letters[ends] > letters[ends - np.array([len(p) for p in each])]
        names, scores = [], []
        for some, row in zip(has.tolist(), cost, strict=True):
            if not some:
                names.append("und"), scores.append(0.0)
                continue
            k = int(row.argmin())
            rest = np.delete(row, k)
            names.append(self.languages[k])
            scores.append(float(1 - row[k] / rest.min()) if len(rest) and rest.min() > 0 else 1.0)
        return names, scores


def train(docs: DataFrame, learn, chars: int = 25_600, pieces: int = 64) -> Parser:
    """At most ``chars`` characters per language: an excerpt of ``chars / pieces`` at a hashed place of each of at most
    ``pieces`` documents, those with the least hash of their text in its salt. Equal texts are one document.

    Languages are the distinct values learned from; their samples come to the driver.
    """
    share = max(1, chars // pieces)
    text = F.col("text").cast("string")
    rows = docs.where(learn).where("lang is not null and text is not null").select("lang", F.xxhash64(text).alias("h"), text.alias("text"))
    place = F.pmod(F.xxhash64("h", F.lit(5)), F.greatest(F.lit(1), F.length("text") - share + 1)) + 1
    rows = rows.where(F.length("text") > 0).select("lang", "h", F.expr("text").substr(place.cast("int"), F.lit(share)).alias("text"))
    rows = rows.groupBy("lang", F.pmod("h", F.lit(pieces)).alias("salt")).agg(F.min_by("text", F.struct("h", "text")).alias("text"))
    samples: dict[str, list[str]] = {}
    for r in rows.orderBy("lang", "salt").collect():
        samples.setdefault(r.lang, []).append(r.text)
    return Parser({name: "\n".join(parts) for name, parts in samples.items()})


def _judge(batches: Iterator[pa.RecordBatch], parser) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names, scores, held, size = [], [], [], 0
        for text in b.column(b.num_columns - 1):
            held.append(text.as_py())
            size += len(held[-1] or "")
            if size >= BATCH_CHARS:
                got = parser.value.judge(held)
                names += got[0]
                scores += got[1]
                held, size = [], 0
        if held:
            got = parser.value.judge(held)
            names += got[0]
            scores += got[1]
        yield batch(doc_id=b.column(0), held_out=b.column(1), lang_pred=pa.array(names, pa.string()), score=pa.array(scores, pa.float64()))


def _unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield batch(doc_id=b.column(0), held_out=b.column(1), lang_pred=pa.array(["und"] * b.num_rows, pa.string()), score=pa.array([0.0] * b.num_rows, pa.float64()))


def predict(docs: DataFrame, chars: int = 25_600) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    remainder = crc_remainder("doc_id", 3)
    parser = train(docs, remainder != 1, chars)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder == 1).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    if not parser.languages:
        return rows.mapInArrow(tidied(_unknown), schema)
    return rows.mapInArrow(tidied(partial(_judge, parser=docs.sparkSession.sparkContext.broadcast(parser))), schema)
