import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from driftglass.llm import katz


def learns(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 != 1


def tokens(text):
    return [*(text or "").encode().lower().split(), "END"]


def brute(rows):
    uni, bi = Counter(), Counter()
    for d, t in rows:
        if learns(d):
            w = tokens(t)
            uni.update(w)
            bi.update(zip(["BEGIN", *w], w))
    n, v = sum(uni.values()), len(uni)
    of = lambda c: [0, *(sum(x == r for x in c.values()) for r in range(1, 7))]
    d1, d2 = katz.discounts(of(uni)), katz.discounts(of(bi))
    disc = lambda d, c: d[min(c, 6)] * c
    unknown = 1 - sum(disc(d1, c) for c in uni.values()) / n if n else 1.0
    p1 = lambda w: disc(d1, uni[w]) / n if uni[w] else unknown
    after, context = {}, Counter()
    for (a, b), c in bi.items():
        after.setdefault(a, {})[b] = c
        context[a] += c

    def p2(a, w):
        if c := bi[(a, w)]:
            return disc(d2, c) / context[a]
        if not context[a]:
            return p1(w)
        return (1 - sum(disc(d2, c) for c in after[a].values()) / context[a]) / (1 - sum(p1(x) for x in after[a])) * p1(w)

    for a in list(after)[:40]:
        assert sum(p2(a, w) for w in uni) + p2(a, "never seen") == pytest.approx(1, abs=1e-9)
    out = []
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = sum(math.log10(p2(a, x)) for a, x in zip(["BEGIN", *w], w))
        held = None if d is None else not learns(d)
        out.append((str(d), held, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return sorted(out, key=str)


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(4000)]
    rows = [(k, rng.choice([" ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(60)))) for k in range(n)]
    return rows + [(3, None), (None, "w1 w2 w1"), (4, ""), (4, "W1 w1 É é"), (4, "W1 w1 É é"), (7, "w1 " * 3000)]


@pytest.mark.parametrize("block_words", [200, 2_500_000])
def test_against_brute_force(spark, block_words):
    rows = made(1, 150)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, block string").repartition(3)
    got = sorted(((str(r.doc_id), *r[1:]) for r in katz.score_documents(docs, block_words).collect()), key=lambda r: str(r[:5]) + f"{r[6]:.6f}")
    want = sorted(brute(rows), key=lambda r: str(r[:5]) + f"{r[6]:.6f}")
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_no_training_text_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = katz.score_documents(docs).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3] and all(r.score == 0 and r.train_tokens == 0 for r in got)
    assert katz.score_documents(docs.limit(0)).count() == 0


def test_discounts():
    d = katz.discounts([0, 1000, 300, 150, 90, 60, 45])
    assert (np.diff(d[1:]) > 0).all() and 0 < d[1] < 1
    assert katz.discounts([0, 1, 0, 0, 0, 0, 0])[1] == 0.5


def test_counts_beyond_32_bits():
    x = np.array([0, 1, 255, 2**32 - 1, 2**32, 7 * 2**40], np.int64)
    assert (katz.unpressed(katz.pressed(x)) == x).all() and len(katz.unpressed(katz.pressed(x[:0]))) == 0
    keys, often = np.array([5, 9], np.uint64).tobytes(), np.array([4_000_000_000, 3], "<u4").tobytes()
    asked = pa.RecordBatch.from_pylist([{"bucket": 1, "block": f"b{k}", "keys": keys, "often": often} for k in range(3)])
    told = [r for b in katz._tell_words(iter([asked])) for r in b.to_pylist()]
    assert [katz.unpressed(r["counts"]).tolist() for r in told if r["kind"] == "answer"] == [[12_000_000_000, 9]] * 3
    assert [r["total"] for r in told if r["kind"] == "stats"] == [12_000_000_009]


def test_pair_counts_beyond_32_bits():
    ask = {"bucket": 0, "vs": np.array([7], np.uint64).tobytes(), "lens": np.array([1], "<u4").tobytes(), "hot": b"\1", "low": np.array([3], "<u4").tobytes(), "high": np.array([0], "<u2").tobytes()}
    ask |= {"often": katz.pressed(np.array([3_000_000_000])), "known": katz.pressed(np.array([9_000_000_000]))}
    words = katz.Words(10_000_000_000, 2, [0] * 7, 0.9)
    told = [r for b in katz._tell_pairs(iter([pa.RecordBatch.from_pylist([{**ask, "block": f"b{k}"} for k in range(3)])]), words) for r in b.to_pylist()]
    assert [katz.unpressed(r["counts"]).tolist() for r in told if r["kind"] == "answer"] == [[9_000_000_000]] * 3
    assert [katz.unpressed(r["counts"]).tolist() for r in told if r["kind"] == "table"] == [[9_000_000_000]]


def test_salts_follow_the_share():
    assert katz.salts_of(np.array([0, 1, 10, 500, 1000]), 1000, 64).tolist() == [1, 1, 3, 64, 64]
