import random

import numpy as np
import pytest

from driftglass.llm import jaccard


def words_of(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if len(w) >= words else {tuple(w)}


def brute(rows, words, percent):
    sets = [words_of(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def made(seed, n, vocab=200):
    rng = random.Random(seed)
    rows = []
    base = [[f"w{rng.randrange(vocab)}" for _ in range(rng.choice([2, 5, 20, 60, 120]))] for _ in range(n // 6)]
    for k in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
        rows.append((k, (" " if rng.random() < 0.9 else "\n").join(w).upper() if rng.random() < 0.2 else " ".join(w)))
    return rows


EDGES = [(5, None), (6, ""), (7, " \n\t"), (None, "a b c d e f g h i j k l"), (8, "a b c d e f g h i j k l"), (8, "one"), (8, "one"), (3, "ONE"), (9, "one two"), (10, "Éa éa x y z"), (11, "éa éa x y z"), (2, "one " * 9000)]


@pytest.mark.parametrize("group", [1000, 6])
def test_against_brute_force(spark, group):
    rows = made(1, 240) + [(1000 + (d or 0), t) if d else (d, t) for d, t in EDGES]
    for words, percent in ((4, 85), (5, 80)):
        got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words, percent, group).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, words, percent)


def test_empty(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string, block string, n int")).count() == 0


def test_divide_skip():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60)).astype(np.uint64)) for _ in range(200)]
    lists = jaccard.Lists(sets)
    for percent in (30, 60, 85):
        for s in sets:
            want = [k for k, y in enumerate(sets) if 100 * len(np.intersect1d(s, y)) >= percent * len(np.union1d(s, y))]
            assert lists.search(s, percent).tolist() == want


def test_a_chain_of_unrelated_sets_stays_linear(spark, monkeypatch):
    """Neighbours share a rare shingle and nothing links: one candidate group, but no task of it and no copies of it."""
    shipped = []
    whole = jaccard.search_tasks

    def counting(rows, percent):
        shipped.append(rows.groupBy("task").count().selectExpr("sum(count) s", "max(count) m").first())
        return whole(rows, percent)

    monkeypatch.setattr(jaccard, "search_tasks", counting)
    n = 300
    rows = [(k, f"a{k} b{k} c{k} d{k} " + f"a{k + 1} b{k + 1} c{k + 1} d{k + 1}") for k in range(n)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, group=10).collect()
    assert sorted(r.component_id for r in got) == list(range(n))
    assert sum(r.s or 0 for r in shipped) < 12 * n and max(r.m or 0 for r in shipped) <= 20


def test_large_clusters_next_to_each_other(spark):
    """Groups of near copies that share shingles with other groups, more than a task takes."""
    rng = random.Random(8)
    base = [[f"w{rng.randrange(400)}" for _ in range(60)] for _ in range(5)]
    rows = []
    for k in range(160):
        w = list(base[k % 5])
        for _ in range(rng.choice([0, 1, 1, 2])):
            w[rng.randrange(60)] = f"x{rng.randrange(12)}"
        rows.append((k, " ".join(w + base[(k + 1) % 5][: rng.choice([0, 0, 6])])))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4, 85, group=8).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 4, 85)


def test_the_row_that_stays_is_defined(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text, "fr", "b", 3), (1, text, "en", "c", 3), (1, text, "en", "a", 3), (2, text + " x", "en", "a", 3), (7, "", "en", "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _mark string, _id int").repartition(3)
    got = jaccard.first_of_groups(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == [(1, text, "en", "a", 3), (7, "", "en", "q", 1)]
