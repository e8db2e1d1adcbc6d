import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftglass.llm import language, neighbours, toxicity

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


EDGES = [(1, None, "en", 1), (2, "", "en", 1), (2, "1234 --", None, 1), (None, "the word", "en", 1), (3, "x" * 600_000, "en", 1), (4, "the " * 20000, None, 2), *((k, "the other word", "en", 2) for k in range(5, 9))]
SCHEMA = "doc_id long, text string, lang string, score int"


def test_features_are_the_set_of_grams():
    rng = random.Random(0)
    text = "".join(rng.choice("abcé ") for _ in range(300))
    points = toxicity.points_of(text)
    one = {int(toxicity._keys(points[k : k + n], n)[0]) for n in toxicity.ORDERS for k in range(len(text) - n + 1)}
    assert len(one) == len({text[k : k + n] for n in toxicity.ORDERS for k in range(len(text) - n + 1)})
    assert set(toxicity.features(text).tolist()) == one
    long = text * 1200
    whole = np.unique(toxicity.gram_ids(toxicity.points_of(long)))
    assert (toxicity.features(long) == whole).all()


def grams_of(text):
    """N-grams of a lower-cased text with their counts."""
    x = text.lower()
    return collections.Counter(x[k : k + n] for n in toxicity.ORDERS for k in range(len(x) - n + 1))


def key_of(gram):
    return int(toxicity._keys(toxicity.points_of(gram), len(gram))[0])


def test_toxicity_against_a_plain_version(spark):
    """Ratios, choice of grams, fit and scores of the whole query, held against dense arrays and Python counters."""
    rng = random.Random(5)
    words = [["calm", "river", "stöne", "bread", "glad"], ["bile", "scörn", "river", "Stöne", "filth"]]
    texts = {k: " ".join(rng.choice(words[k % 5 == 0]) for _ in range(rng.randrange(20, 90))) for k in range(150)}
    docs = spark.createDataFrame([*texts.items(), (900, None)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in texts if k % 7], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.predict(docs, labels).collect()}

    learn = [k for k in texts if k % 7 and zlib.crc32(str(k).encode()) % 5 != 0]
    y = np.array([float(k % 5 == 0) for k in learn])
    counts = [grams_of(texts[k]) for k in learn]
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    ratio = {}
    for g in set().union(*counts):
        c1 = sum(1 for c, v in zip(counts, y) if g in c and v)
        c0 = sum(1 for c, v in zip(counts, y) if g in c and not v)
        r = math.log((c1 + 0.5) / (n1 + 1)) - math.log((c0 + 0.5) / (n0 + 1))
        if c0 + c1 >= 3 and abs(r) >= 3 * math.sqrt(1 / (c1 + 0.5) + 1 / (c0 + 0.5)):
            ratio[g] = r
    assert len(ratio) > 20
    grams = sorted(ratio, key=key_of)
    rate = lambda c: np.array([c[g] for g in grams]) * 1000 / max(sum(c.values()), 300)
    r = np.array([ratio[g] for g in grams])
    x = np.stack([rate(c) for c in counts]) * r
    w, b, m, s = np.zeros(len(r)), 0.0, np.zeros(len(r) + 1), np.zeros(len(r) + 1)
    for t in range(1, 121):  # Adam on the log loss plus half the squared weights
        off = 1 / (1 + np.exp(-(x @ w + b))) - y
        g = np.append((x.T @ off + w) / len(y), off.sum() / len(y))
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        move = 0.05 * m / (1 - 0.9**t) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    assert got[900].score == pytest.approx(1 / (1 + math.exp(-b)), abs=1e-6)
    for k, text in texts.items():
        z = rate(grams_of(text)) @ (w * r) + b
        assert got[k].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0)


def test_toxicity_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    got = toxicity.predict(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    words = got.text.str.lower().str.contains("idiot|moron|scum|stupid|worthless")
    assert got[words & (got.toxic == 1)].predicted.mean() > 0.9
    assert got[got.toxic == 0].predicted.mean() < 0.02


@pytest.fixture(scope="module")
def labelled(spark):
    """A model of the learning fold of sf0.1, and its labelled documents."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    return toxicity.train(docs, labels, toxicity.learns(5, 0)), docs.join(labels, "doc_id").select("doc_id", "text", "lang", "toxic").toPandas()


def test_toxicity_held_out_in_every_language(labelled):
    model, rows = labelled
    held = rows[[zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]]
    marked = held.text.map(model.score) >= 0.5
    recall = marked[held.toxic == 1].groupby(held.lang).mean()
    assert sorted(recall.index) == ["de", "en", "es", "fr"] and recall.min() > 0.8
    assert marked[held.toxic == 0].mean() < 0.005


def test_long_clean_texts_stay_clean(labelled):
    model, rows = labelled
    clean = rows[(rows.toxic == 0) & ~rows.text.str.lower().str.contains("idiot|moron|scum|stupid|worthless|loser|clown|trash|pathetic|disgusting")]
    for lang in ("de", "en", "es", "fr"):
        text = "\n".join(clean[clean.lang == lang].sort_values("doc_id").text)
        text = (text * 10)[:3_000_000]
        assert [model.score(text[:n]) < 0.5 for n in (100_000, 400_000, 800_000, 3_000_000)] == [True] * 4


def test_counts_over_pieces():
    text = "abcé" * 150_000 + "xyz"
    ids, counts = toxicity.counted(text)
    whole, n = np.unique(toxicity.gram_ids(toxicity.points_of(text)), return_counts=True)
    assert (ids == whole).all() and (counts == n).all()


def test_quality_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    got = neighbours.predict(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in held.doc_id]).all()
    assert (held.predicted == held.quality).mean() > 0.97


def test_neighbours_against_plain_cosine():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "cd", "e|", "f9", "gh"]) + rng.choice("xyz") for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    space = neighbours.Space([(*neighbours.terms(t), k % 2) for k, t in enumerate(texts)], {0: 30, 1: 30}, 5)
    for t, s in zip(texts, space.score(texts), strict=True):
        v = space.vector(t)
        cos = sorted(((float(space.vectors[k] @ v / np.linalg.norm(v)), k % 2) for k in range(60)), reverse=True)[:5]
        w = [(max(c, 0) ** 2, y) for c, y in cos]
        assert s == pytest.approx(sum(c for c, y in w if y) / sum(c for c, _ in w), abs=0.02)


def test_language_held_out(spark):
    docs = table(spark, "documents")
    got = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() > 0.98


def phrases_of(text, sample):
    """Greedy longest phrases of a whole text, a character that the sample lacks by itself."""
    def classes(t):
        own = {c for c in sample.lower() if c.isalpha()}
        return "".join(c if c in own else "\0" if not c.isalpha() else "\1" for c in t.lower())

    known, x, n, phrase = classes(sample), classes(text), 0, ""
    for c in x:
        if phrase and phrase + c in known:
            phrase += c
        else:
            n += 1
            phrase = c if c in known else ""
    return n


LETTERS = {"a": "abcé ", "b": "bcd ", "c": "xyz", "adlam": "\U0001e922\U0001e923\U0001e924 ", "deseret": "\U00010428\U00010429 a"}


@pytest.mark.parametrize("dense", [1 << 28, 0])
def test_phrases_against_substrings(monkeypatch, dense):
    monkeypatch.setattr(language, "DENSE_BYTES", dense)
    rng = random.Random(2)
    samples = {name: "".join(rng.choice(letters) for _ in range(200)) for name, letters in LETTERS.items()}
    samples["periodic"] = "abcd" * 40 + "dcb"
    parser = language.Parser(samples)
    texts = ["".join(rng.choice(rng.choice(["abcdéxq 1\U0001e922", "ab", "\U00010428漢 "])) for _ in range(rng.choice([0, 1, 5, 255, 256, 257, 700, 1500]))) for _ in range(40)]
    texts += ["bcda" * 700, "b" + "cdab" * 500 + "x" + "abcd" * 300, "dcba" * 300, "abcd" * 64, ""]
    each = [language.points_of(t) for t in texts]
    got = parser.phrases(np.concatenate(each), np.cumsum([len(c) for c in each]))
    for i, t in enumerate(texts):
        assert got[i].tolist() == [phrases_of(t, samples[name]) for name in parser.languages], i


def test_letters_beyond_the_basic_plane_are_told_apart(spark):
    rng = random.Random(3)
    rows = [(k, "".join(rng.choice(LETTERS[name]) for _ in range(80)), name) for k in range(120) for name in [["adlam", "deseret"][k % 2]]]
    got = language.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    want = {d: name for d, _, name in rows}
    assert all(r.lang_pred == want[r.doc_id] for r in got)


def test_edges(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, None, None), (None, 1, 1), (9, 1, 1)], "doc_id long, toxic int, quality int")
    none = labels.limit(0)
    for module in (toxicity, neighbours):
        for lab in (labels, none):
            got = module.predict(docs, lab).collect()
            assert len(got) == len(EDGES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
            assert [r.held_out for r in got if r.doc_id is None] == [None]
            assert module.predict(docs.limit(0), lab).count() == 0
    got = language.predict(docs).collect()
    assert len(got) == len(EDGES) and sum(r.lang_pred == "und" for r in got) == 3
    assert {r.lang_pred for r in language.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.predict(docs.limit(0)).count() == 0
