import hashlib
import random
import re

from driftglass.llm import decontaminate, quality

GAP = re.compile(r"[\x20\x09-\x0D]+")


def brute_quality(text):
    words = [w for w in GAP.split(text or "") if w]
    at = {}
    for k in range(len(words) - 2):
        at.setdefault(tuple(words[k : k + 3]), []).append(k)
    covered = {p for starts in at.values() if len(starts) > 1 for k in starts for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if GAP.sub("", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def made(seed, n=60):
    rng = random.Random(seed)
    out = [None, "", " \n ", "a", "a b", "a a a", "a a a a", "x y z x y z\nx y z", "É# $\x0bü\n\nÉ# $\x0bü", "one two " * 3000]
    for _ in range(n):
        out.append("".join(rng.choice(["a", "b", "bb", "#", "|"]) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(rng.randrange(80))))
    return out


def test_measures_against_brute_force(spark):
    texts = made(0)
    rows = [(k, t, "x", 1.0) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept double")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    for k, t, *_ in rows:
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(t), repr(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_rules(spark):
    prose = " ".join(f"This w{k} is a line x{k} of plain y{k} prose." for k in range(12))
    table = "a | b | c | d | e | f\n" * 40
    rows = [(1, prose + "\nHome\nAll rights reserved"), (2, table), (3, "word " * 80), (4, prose.replace(".", " #### $$$$ |||| &&&&"))]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].clean_text == prose
    assert not got[2].kept and not got[3].kept and not got[4].kept


CUT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_words(text):
    return [w for w in CUT.split("".join(c.lower() if c.isascii() else c for c in text or "")) if w]


def brute_hits(texts, items, span):
    out = []
    windows = {}
    for name, text in items:
        w = ascii_words(text)
        if name is not None and w:
            m = min(span, len(w))
            for k in range(len(w) - m + 1):
                windows.setdefault(tuple(w[k : k + m]), set()).add(name)
    sizes = {len(w) for w in windows}
    for d, text in texts:
        w = ascii_words(text)
        spots, names = set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if hit := windows.get(tuple(w[k : k + m])):
                    spots.update(range(k, k + m))
                    names |= hit
        out.append((d, len(w), len(spots), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(spots)))
    return sorted(out, key=str)


def test_contamination_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b", "É", "é9", "d", "e", "f"])
    items = [(str(k), " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25, 40])))) for k in range(30)]
    items += [("3", "zz yy xx ww vv uu tt ss rr qq pp"), (None, "a b"), ("n", None), ("10", "Lone-Word"), ("one", "k l")]
    texts = [(k, " ".join(word() for _ in range(rng.randrange(40)))) for k in range(60)]
    for k in range(60, 140):
        t = rng.choice(items)[1] or ""
        w = t.split()
        a = rng.randrange(len(w) + 1)
        texts.append((k, f"{' '.join(word() for _ in range(rng.randrange(5)))} {'; '.join(w[a:]).upper()} {word()}"))
    texts += [(7, None), (None, ""), (8, "LONE, word K.L"), (8, "LONE, word K.L"), (9, "a b " * 4000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    for bound in (200_000, 0):
        got = decontaminate.contamination(docs, bench, bound=bound).drop("items").collect()
        assert sorted(map(tuple, got), key=str) == brute_hits(texts, items, 10)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs, none).collect()] == [0]
    assert decontaminate.contamination(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0


def test_clashing_columns_and_long_texts(spark):
    """Columns named like helpers or results don't matter; a text of a megabyte is one row like any other."""
    long = "filler word " * 90_000 + "one two three four five six seven eight nine ten"
    rows = [(1, long, "a", 7, "w"), (2, "one two three four five six seven eight nine ten", "b", 8, "w"), (2, None, "c", 9, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _name string, n_hit int, _words string")
    bench = spark.createDataFrame([("q", "zero one two three four five six seven eight nine ten", "x", 1)], "item_id string, text string, _item string, mark int")
    got = decontaminate.contamination(docs, bench).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in got) == [(1, 180_010, 10), (2, 0, 0), (2, 10, 10)]
    kept = decontaminate.clean_rows(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, None, "c", 9, "w")]
    judged = quality.judge(spark.createDataFrame([(1, long, "x")], "doc_id long, text string, _text string")).first()
    assert judged.n_words == 180_010 and judged.base_failed and not judged.kept
