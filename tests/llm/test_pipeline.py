import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftglass.llm import toxicity
from tests.llm.test_jaccard import words_of
from tests.llm.test_native import brute_hits
from tests.llm.test_tokens_packing import check_layout

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returned, as the driver chains them."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append({r.doc_id: r for r in docs.collect()} if name != "packing" else docs.toPandas())
    return [{r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}, *out]


def test_toxicity_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), labels, F.lit(True))
    assert set(stages[1]) == {d for d, r in stages[0].items() if model.score(r.text) < 0.5}


def test_rejecting_leaves_no_python_to_the_callers_write(spark):
    """A caller's write has batches of the session's size, whatever a row weighs."""
    model = toxicity.Model(np.zeros(0, np.int64), np.zeros(0), -1.0)
    rows = [(k, f"text {k}" if k % 7 else None, k * 0.5) for k in range(700)]
    kept = toxicity.reject(spark.createDataFrame(rows, "doc_id long, text string, more double").coalesce(1), model)
    assert "MapInArrow" not in kept._jdf.queryExecution().toString()
    assert sorted(map(tuple, kept.collect())) == rows


def test_near_duplicates_stage(stages):
    rows = sorted((d, words_of(r.text, 5)) for d, r in stages[1].items())
    up = {d: d for d, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                up[hi] = lo
    assert set(stages[2]) == {d for d, x in rows if not x or find(d) == d}


def test_repeats_stage(stages):
    before = {d: (r.text or "").encode() for d, r in stages[2].items()}
    at = collections.Counter(b[k : k + 150] for b in before.values() for k in range(len(b) - 149))
    want = {}
    for d, b in before.items():
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 149):
            if at[b[k : k + 150]] > 1:
                gone[k : k + 150] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone])))
        runs = [(x, y) for x, y in zip(edges[::2], edges[1::2]) if y - x >= 400 or len(b[x:y].split()) >= 51]
        keep = np.ones(len(b), bool)
        for x, y in runs:
            keep[x:y] = False
        want[d] = bytes(np.frombuffer(b, np.uint8)[keep]).decode(errors="ignore") if runs else stages[2][d].text
        if runs and keep.sum() == 0:
            del want[d]
    assert {d: r.text for d, r in stages[3].items()} == want and want != {d: r.text for d, r in stages[2].items()}
    assert all(r.n_chars == len(r.text) for r in stages[3].values())


def test_decontamination_stage(spark, stages):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = brute_hits([(d, r.text) for d, r in stages[3].items()], items, 10)
    assert set(stages[4]) == {d for d, *_, bad in hits if not bad}


def test_packing_stage(stages):
    pieces = stages[5]
    assert set(pieces.doc_id) == set(stages[4])
    check_layout(pieces)


def test_run_and_edges(spark, tmp_path):
    clean = " ".join(f"word{k}" for k in range(90))
    rows = [
        (1, clean, "en", "a", 1), (2, clean + " more", "en", "a", 1), (2, clean + " more", "en", "a", 1), (3, None, None, None, None),
        (3, "", "en", "a", 0), (None, "another text of its own without a name", "en", "a", 1), (4, " ".join(f"item{k}" for k in range(30)), "en", "a", 1),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"item{k}" for k in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter(r.doc_id for r in got) == {1: 1, 3: 2, None: 1}
    assert all(len(np.frombuffer(r.ids, "<u4")) == r.length for r in got)


def test_empty_documents_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, _mark long, _name string, t1 int, kept string, mark int, block string"
    row = (1, " ".join(f"word{k}" for k in range(90)), "en", "a", 600, "x", 1, "y", 2, "z", 3, "b")
    spark.createDataFrame([(1, "an item of a few words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows, want in (([], 0), ([row, row], 1)):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == corpus_pipeline.COLUMNS
        assert docs.count() == want
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == want
