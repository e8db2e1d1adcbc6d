"""Katz backoff language model (bigrams, unigrams, unknown) with Good-Turing discounts.

Tokens are words and one end per text; the context of the first token is the text's beginning. With training counts c:

    P(w | v) = d(c(v w)) c(v w) / c(v)        if the pair was seen
             = alpha(v) P(w)                  otherwise, alpha(v) = (1 - seen mass of v) / (1 - sum of P over w seen after v)
    P(w)     = d(c(w)) c(w) / N               if the word was seen; what is left is the probability of an unknown word

so both levels add up to exactly 1 over the known words, the end and "unknown". d is Katz's Good-Turing discount for
counts up to 5 (where the counts of counts allow it, else (r - 0.5) / r) and TAIL beyond, so no context is without mass.

Counts of all training texts meet in hash buckets and are stored there as tables, partitioned by kind. Blocks of texts
ask for the counts of their distinct words, then of their distinct pairs; buckets answer in the order asked. A context
with many tokens is dealt over as many buckets as its share of the text asks for, and its sums are added up by the block.
Nothing is broadcast but the two discount vectors. Counts are 64 bits wide throughout.

Defined cases: null and empty texts are one end token; a null doc_id is in neither fold and teaches nothing; without
training texts every token is unknown (P = 1 each); repeated rows are counted and scored each; extra columns are not read;
an empty table gives an empty result; a very long text is a block of its own, read a few megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.blocks import Block, bucket_count, by_bucket, dealt, mix, rows_of, word_blocks
from driftglass.llm.shared import batch, crc_remainder, keep, keep_bucketed, shared_dir, tidied

LARGEST, TAIL = 5, 0.999
END, BEGIN = np.uint64(0xE0D), np.uint64(0xBE6)
LOW48 = np.uint64((1 << 48) - 1)


def discounts(n: list[float]) -> np.ndarray:
    """d(0) .. d(LARGEST) and d beyond, from n[r] = number of types with count r, r up to LARGEST + 1."""
    d = np.array([0.0, *((r - 0.5) / r for r in range(1, LARGEST + 1)), TAIL])
    if n[1] and all(n[r] for r in range(1, LARGEST + 2)):
        cut = (LARGEST + 1) * n[LARGEST + 1] / n[1]
        katz = [((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) for r in range(1, LARGEST + 1)] if cut < 1 else [0.0]
        if len(katz) == LARGEST and all(0 < x < 1 for x in katz):
            d[1:-1] = katz
    return d


def discounted(d: np.ndarray, c: np.ndarray) -> np.ndarray:
    return d[np.minimum(c, LARGEST + 1).astype(np.int64)] * c


class Words:
    """Unigram level: n training tokens, types types, discounts d."""

    def __init__(self, total: int, types: int, counts_of: list[float], seen_mass: float):
        self.total, self.types, self.d = total, types, discounts(counts_of)
        self.unknown = 1.0 if not total else 1 - seen_mass

    def probability(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(self.d, c) / max(1, self.total), self.unknown)


def pressed(x: np.ndarray) -> bytes:
    """Counts as compressed byte planes, as many as the largest needs: most high bytes are zero."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width])
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpressed(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.reshape(-1).view("<u8").astype(np.int64)


def _learns(block: Block) -> np.ndarray:
    return np.array([f is not None and f != 1 for f in block.folds], bool)


class Pairs:
    """Tokens and distinct pairs of a block. Word numbers: the vocabulary, then the end, then the beginning."""

    def __init__(self, block: Block):
        self.keys = np.append(block.vocab, [END, BEGIN])
        n = len(block.vocab)
        sizes = block.ends - block.starts
        docs = len(sizes)
        self.owner = np.repeat(np.arange(docs, dtype=np.int32), sizes + 1)
        last = np.cumsum(sizes + 1) - 1
        self.token = np.full(len(self.owner), n, np.int32)
        inner = np.ones(len(self.owner), bool)
        inner[last] = False
        self.token[inner] = block.words
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[np.concatenate([[0], last[:-1] + 1])] = n + 1
        self.before = before
        self.learns = _learns(block)[self.owner]
        self.width = n + 2

    def distinct(self) -> None:
        codes, pair = np.unique(self.before.astype(np.int64) * self.width + self.token, return_inverse=True)
        self.pair = pair.astype(np.int32)
        del self.before, pair
        self.v, self.w = (codes // self.width).astype(np.int32), (codes % self.width).astype(np.int32)
        self.often = np.bincount(self.pair[self.learns], minlength=len(codes))

    def ordered(self, counts: np.ndarray, total: int, buckets: int) -> None:
        """Order of the distinct pairs by bucket, context and word key; ``counts`` are of the words, with the beginning."""
        v, w = self.keys[self.v], mix(self.keys[self.w]) & LOW48
        salts = salts_of(counts, total, buckets)
        bucket = _bucket(v, mix(w) % salts[self.v], buckets)
        order = np.lexsort((w, v, bucket))
        self.order, bucket, v, self.wkey = order, bucket[order], v[order], w[order]
        lead = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (bucket[1:] != bucket[:-1])])) if len(order) else np.zeros(0, np.int64)
        # a context dealt over salts asks all its buckets, with no pairs where it has none: its sums lie in all of them
        contexts = np.unique(self.v)
        hot = contexts[salts[contexts] > 1]
        spread = np.repeat(hot, salts[hot].astype(np.int64))
        nth = np.concatenate([np.arange(n, dtype=np.uint64) for n in salts[hot].tolist()]) if len(hot) else np.zeros(0, np.uint64)
        at = np.concatenate([bucket[lead], _bucket(self.keys[spread], nth, buckets)])
        of = np.concatenate([self.v[order[lead]], spread])
        size = np.concatenate([np.diff(np.append(lead, len(order))), np.zeros(len(spread), np.int64)])
        by = np.lexsort((self.keys[of], at))
        at, of, size = at[by], of[by], size[by]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (of[1:] != of[:-1])]))
        #: groups of pairs with one context in one bucket
        self.group_bucket, self.group_context, self.group_size = at[new], of[new], np.add.reduceat(size, new)
        self.group_hot = np.isin(self.group_context, hot)


def salts_of(counts: np.ndarray, total: int, buckets: int) -> np.ndarray:
    """Over how many buckets each context is dealt: a quarter of a bucket's even share of the tokens goes to each."""
    share = counts.astype(float) * (4 * buckets) / max(1, total)
    return np.clip(np.ceil(share), 1, buckets).astype(np.uint64)


def _bucket(v: np.ndarray, salt: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(v + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)


def _ask_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        pairs = Pairs(Block(row))
        keys = pairs.keys[:-1]
        often = np.bincount(pairs.token[pairs.learns], minlength=len(keys))
        bucket = keys % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        yield from dealt(row["block"], order, bucket[order], keys=keys[order], often=often[order].astype("<u4"))


def _count_of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, LARGEST + 2), minlength=LARGEST + 3)[: LARGEST + 2].tolist()


STATS = "total long, types long, counts_of array<bigint>, small long"
TABLE = "kind string, bucket int, block string, counts binary, keys binary, lens binary, groups binary, sums binary, " + STATS


def _table_row(kind: str, bucket: int, rows: int, **columns) -> pa.RecordBatch:
    binary = ("counts", "keys", "lens", "groups", "sums")
    out = {"kind": pa.array([kind] * rows), "bucket": pa.array([bucket] * rows, pa.int32()), "block": pa.array(columns.get("block", [None] * rows), pa.string())}
    out |= {c: pa.array(columns.get(c, [None] * rows), pa.binary()) for c in binary}
    out |= {c: pa.array(columns.get(c, [None] * rows), pa.int64()) for c in ("total", "types")}
    out["counts_of"] = pa.array(columns.get("counts_of", [None] * rows), pa.list_(pa.int64()))
    out["small"] = pa.array(columns.get("small", [None] * rows), pa.int64())
    return batch(**out)


def _tell_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in by_bucket(rows_of(batches)):
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        names, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate([np.frombuffer(r["often"], "<u4") for r in rows]), minlength=len(names)).astype(np.int64)
        parts = np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])
        yield _table_row("answer", bucket, len(rows), block=[r["block"] for r in rows], counts=[pressed(p) for p in parts])
        seen = total > 0
        small = total[total <= LARGEST]
        yield _table_row("table", bucket, 1, keys=[names[seen].tobytes()], counts=[total[seen].astype("<i8").tobytes()])
        yield _table_row("stats", bucket, 1, total=[int(total.sum())], types=[int(seen.sum())], counts_of=[_count_of_counts(total)], small=[int(small.sum())])


def word_counts(row: dict, pairs: Pairs, buckets: int) -> np.ndarray:
    """Training counts of the words of a block, the end, and the beginning as a context."""
    keys = pairs.keys[:-1]
    order = np.argsort(keys % np.uint64(buckets), kind="stable")
    got = np.concatenate([unpressed(x["counts"]) for x in sorted(row["words_told"], key=lambda x: x["bucket"])])
    counts = np.empty(len(keys) + 1, np.int64)
    counts[order] = got
    counts[-1] = counts[-2]  # as many beginnings as ends
    return counts


def _ask_pairs(batches: Iterator[pa.RecordBatch], buckets: int, words: Words, turn: int, turns: int) -> Iterator[pa.RecordBatch]:
    """A row per bucket whose number leaves ``turn`` when divided by ``turns``."""
    for row in rows_of(batches):
        pairs = Pairs(Block(row))
        counts = word_counts(row, pairs, buckets)
        pairs.distinct()
        pairs.ordered(counts, words.total, buckets)
        order, held = pairs.order, []
        often, known = pairs.often[order], counts[pairs.w[order]]
        low, high = (pairs.wkey & np.uint64(0xFFFFFFFF)).astype("<u4"), (pairs.wkey >> np.uint64(32)).astype("<u2")
        vs, lens, hot = pairs.keys[pairs.group_context], pairs.group_size.astype("<u4"), pairs.group_hot.astype(np.uint8)
        cuts = np.flatnonzero(np.diff(pairs.group_bucket)) + 1
        ends = np.concatenate([[0], np.cumsum(pairs.group_size)])
        for g, h in zip(np.concatenate([[0], cuts]).tolist(), np.append(cuts, len(lens)).tolist(), strict=True):
            i, j = ends[g], ends[h]
            if pairs.group_bucket[g] % turns == turn:
                held.append((int(pairs.group_bucket[g]), *(x[g:h].tobytes() for x in (vs, lens, hot)), *(x[i:j].tobytes() for x in (low, high)), *(pressed(x[i:j]) for x in (often, known))))
            if len(held) == 128 or (held and h == len(lens)):
                c = list(zip(*held, strict=True))
                names = ("vs", "lens", "hot", "low", "high", "often", "known")
                yield batch(bucket=pa.array(c[0], pa.int32()), block=pa.array([row["block"]] * len(held)), **{n: pa.array(x, pa.binary()) for n, x in zip(names, c[1:], strict=True)})
                held = []


ASKED_PAIRS = "bucket int, block string, vs binary, lens binary, hot binary, low binary, high binary, often binary, known binary"


def _six(w: np.ndarray) -> bytes:
    """48-bit keys as six bytes each."""
    return np.ascontiguousarray(w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _tell_pairs(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[pa.RecordBatch]:
    for bucket, rows in by_bucket(rows_of(batches)):
        def joined(name: str, kind: str) -> np.ndarray:
            return np.concatenate([np.frombuffer(r[name], kind) for r in rows])

        def counted(name: str) -> np.ndarray:
            return np.concatenate([unpressed(r[name]) for r in rows])

        vs, lens, hot = joined("vs", np.uint64), joined("lens", "<u4").astype(np.int64), joined("hot", np.uint8)
        w = joined("low", "<u4").astype(np.uint64) | (joined("high", "<u2").astype(np.uint64) << np.uint64(32))
        group = np.repeat(np.arange(len(vs)), lens)
        contexts, context = np.unique(vs, return_inverse=True)
        key = mix(vs[group] ^ (w * np.uint64(0x9E3779B97F4A7C15)))
        names, first, at = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(at, counted("often"), minlength=len(names)).astype(np.int64)
        # per context: how many pairs of each small count, and the unigram mass of the words seen after it
        of = context[group[first]]
        seen = total > 0
        small = np.zeros((len(contexts), LARGEST), np.int64)
        for r in range(1, LARGEST + 1):
            small[:, r - 1] = np.bincount(of[total == r], minlength=len(contexts))
        mass = np.bincount(of[seen], words.probability(counted("known")[first][seen]), minlength=len(contexts))
        told = total[at]
        lack = np.bincount(group, told == 0, minlength=len(vs)) > 0
        wanted = lack | (hot > 0)
        g0 = np.cumsum([0, *(len(r["vs"]) // 8 for r in rows)])
        e0 = np.cumsum([0, *(len(r["low"]) // 4 for r in rows)])
        counts, groups, sums = [], [], []
        for k in range(len(rows)):
            own = np.flatnonzero(wanted[g0[k] : g0[k + 1]])
            c = context[g0[k] : g0[k + 1]][own]
            counts.append(pressed(told[e0[k] : e0[k + 1]]))
            groups.append(own.astype("<u4").tobytes())
            sums.append(np.column_stack([small[c].astype(float), mass[c]]).astype("<f8").tobytes())
        yield _table_row("answer", bucket, len(rows), block=[r["block"] for r in rows], counts=counts, groups=groups, sums=sums)
        by = np.lexsort((w[first][seen], of[seen]))
        lens_out = np.bincount(of[seen], minlength=len(contexts))
        yield _table_row("table", bucket, 1, keys=[contexts.tobytes() + _six(w[first][seen][by])], lens=[lens_out.astype("<u4").tobytes()], counts=[pressed(total[seen][by])])
        yield _table_row("stats", bucket, 1, total=[int(total.sum())], types=[int(seen.sum())], counts_of=[_count_of_counts(total)])


def _score(batches: Iterator[pa.RecordBatch], buckets: int, words: Words, pair_discounts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        block = Block(row)
        pairs = Pairs(block)
        counts = word_counts(row, pairs, buckets)
        pairs.distinct()
        pairs.ordered(counts, words.total, buckets)
        told = sorted(row["pairs_told"], key=lambda x: x["bucket"])
        seen = np.empty(len(pairs.order), np.int64)
        seen[pairs.order] = np.concatenate([unpressed(x["counts"]) for x in told])
        # sums of contexts, added up over their buckets
        sums = np.zeros((pairs.width, LARGEST + 1))
        starts = np.flatnonzero(np.concatenate([[True], np.diff(pairs.group_bucket) != 0]))
        for x, start in zip(told, starts.tolist(), strict=True):
            own = np.frombuffer(x["groups"], "<u4").astype(np.int64) + start
            np.add.at(sums, pairs.group_context[own], np.frombuffer(x["sums"], "<f8").reshape(-1, LARGEST + 1))
        context = counts.astype(float)
        r = np.arange(1, LARGEST + 1)
        few = sums[:, :-1] @ r
        mass = sums[:, :-1] @ (r * pair_discounts[1:-1]) + TAIL * (context - few)
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(context > 0, (1 - mass / context) / (1 - sums[:, -1]), 1.0)
        single = words.probability(counts[:-1])
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(seen > 0, discounted(pair_discounts, seen) / context[pairs.v], alpha[pairs.v] * single[pairs.w])
        c = counts[pairs.token]
        base = np.log10((c + 0.5) / (words.total + 0.5 * (words.types + 1)))
        n = len(block.docs)
        yield batch(
            doc_id=pa.array(block.docs, pa.int64()),
            held_out=pa.array([None if f is None else f == 1 for f in block.folds], pa.bool_()),
            n_tokens=pa.array(np.bincount(pairs.owner, minlength=n)),
            n_known=pa.array(np.bincount(pairs.owner, c > 0, minlength=n).astype(np.int64)),
            train_tokens=pa.array([words.total] * n, pa.int64()),
            base_score=pa.array(np.bincount(pairs.owner, base, minlength=n)),
            score=pa.array(np.bincount(pairs.owner, np.log10(p)[pairs.pair], minlength=n)),
        )


def _stats(told: DataFrame) -> tuple[int, int, list[int], int]:
    """Corpus totals of a stored level (one row)."""
    each = [F.coalesce(F.sum(F.get("counts_of", F.lit(r))), F.lit(0)) for r in range(LARGEST + 2)]
    row = told.where("kind = 'stats'").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0)), F.coalesce(F.sum("small"), F.lit(0)), *each).first()
    return row[0], row[1], list(row[3:]), row[2]


def score_documents(docs: DataFrame, block_words: int = 1_250_000, turns: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Pairs are asked in ``turns`` shares of the buckets, one after the other, so that only a share is shuffled at a time.
    """
    folder, buckets = shared_dir(docs.sparkSession), bucket_count(docs)
    blocks = keep_bucketed(word_blocks(docs, crc_remainder("doc_id", 5), block_words), f"{folder}/blocks", "block")

    asked = blocks.mapInArrow(tidied(partial(_ask_words, buckets=buckets)), "bucket int, block string, keys binary, often binary")
    told = keep(asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(_tell_words), TABLE), f"{folder}/words", partition_by=["kind"])
    total, types, counts_of, few = _stats(told)
    d = discounts(counts_of)
    seen = sum(d[r] * r * counts_of[r] for r in range(1, LARGEST + 1)) + TAIL * (total - few)
    words = Words(total, types, counts_of, seen / max(1, total))
    words_told = told.where("kind = 'answer'").groupBy("block").agg(F.collect_list(F.struct("bucket", "counts")).alias("words_told"))
    known = blocks.join(words_told, "block")

    shares = []
    for turn in range(turns):
        asked = known.mapInArrow(tidied(partial(_ask_pairs, buckets=buckets, words=words, turn=turn, turns=turns)), ASKED_PAIRS)
        answered = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(partial(_tell_pairs, words=words)), TABLE)
        shares.append(keep(answered, f"{folder}/pairs-{turn}", partition_by=["kind"]))
    told = reduce(DataFrame.unionByName, shares)
    pair_discounts = discounts(_stats(told)[2])
    pairs_told = told.where("kind = 'answer'").groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "groups", "sums")).alias("pairs_told"))
    scored = known.join(pairs_told, "block").mapInArrow(tidied(partial(_score, buckets=buckets, words=words, pair_discounts=pair_discounts)), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored
