import hashlib
import random

import numpy as np
import pytest

from driftglass.llm import registry, suffix
from driftglass.llm.anchors import sliding_min, window_anchors


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    for n in (1, 2, 9, 50, 700):
        raw = rng.integers(0, 2 if seed < 4 else 200, n).astype(np.uint8)
        if seed == 5 and n > 20:
            raw = np.tile(raw[:10], n // 10)
        order, rank = suffix.suffix_array(raw)
        b = raw.tobytes()
        want = sorted(range(len(b)), key=lambda i: b[i:])
        assert order.tolist() == want
        lcp = suffix.common_prefixes(raw, order, rank)
        for r in range(1, len(b)):
            x, y = b[want[r - 1] :], b[want[r] :]
            m = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert lcp[r] == m


def test_anchors_depend_on_content_only():
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 3, 5000).astype(np.uint8)
    ends = np.array([700, 700, 2000, 2030, 5000])
    h, lo, hi = window_anchors(raw, ends, 40, 20)
    covered = [s for a, b in zip(lo, hi) for s in range(a, b + 1)]
    starts = [0, 700, 700, 2000, 2030]
    assert covered == [s for a, e in zip(starts, ends) for s in range(a, e - 40 + 1)]
    seen = {}
    for x, a, b in zip(h, lo, hi):
        for s in range(a, b + 1):
            assert seen.setdefault(raw[s : s + 40].tobytes(), x) == x
    x = rng.integers(0, 99, 50)
    for w in (1, 2, 3, 7, 8, 50):
        assert sliding_min(x, w).tolist() == [x[k : k + w].min() for k in range(len(x) - w + 1)]


def brute(rows, span):
    at = {}
    texts = [(t or "").encode() for _, t in rows]
    for k, b in enumerate(texts):
        for s in range(len(b) - span + 1):
            at.setdefault(b[s : s + span], []).append((k, s))
    gone = [np.zeros(len(b), bool) for b in texts]
    for places in at.values():
        if len(places) > 1:
            for k, s in places:
                gone[k][s : s + span] = True
    out = []
    for (d, _), b, g in zip(rows, texts, gone):
        kept = bytes(np.frombuffer(b, np.uint8)[~g])
        out.append((d, len(b), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice(["aé", "b", "cc", "the", "of", "x"]) + str(rng.randrange(30))
    passage = [" ".join(word() for _ in range(rng.randrange(5, 40))) for _ in range(6)]
    rows = []
    for k in range(n):
        parts = [" ".join(word() for _ in range(rng.randrange(30)))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passage), " ".join(word() for _ in range(rng.randrange(12)))]
        rows.append((k, " ".join(parts)))
    rows += [(n + k, rows[rng.randrange(n)][1]) for k in range(6)]
    return rows + [(3, None), (None, ""), (4, "ab" * 300), (4, "ab" * 300), (5, "short"), (None, "z" * 41), (6, "q" * 40)]


@pytest.mark.parametrize("group", [4096, 3])
def test_against_brute_force(spark, group):
    rows = made(group, 70)
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, t1 int, n_spans string").repartition(3)
    got = suffix.remove_repeats(docs, 40, 20, group).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 40)


def test_empty(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_by_words_or_bytes():
    raw = b"one two three four " + b"x" * 30 + b" five six"
    spans = [(0, 8), (4, 18), (19, 49), (53, 58)]
    assert suffix.runs_to_remove(raw, spans, 0, 0) == [(0, 18), (19, 49), (53, 58)]
    assert suffix.runs_to_remove(raw, spans, 4, 30) == [(0, 18), (19, 49)]
    assert suffix.runs_to_remove(raw, spans, 4, 31) == [(0, 18)]
    assert suffix.runs_to_remove(raw, [], 4, 31) == []


def test_query_against_brute_force(spark):
    """op9 itself, at its 400 bytes, over whole documents."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = registry.op9_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    want = brute([(r.doc_id, r.text) for r in docs], 400)
    assert sorted(map(tuple, got), key=str) == want and sum(r[2] for r in want) > 0
