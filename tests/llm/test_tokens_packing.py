import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftglass.llm import bitplanes, packing
from driftglass.llm.tokens import Encoder, byte_bpe_path, encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(plain):
    rng = random.Random(1)
    alphabet = list("ab'sltrev 0²½\t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　​᠎éßÜ漢字🙂́_#|<>.,") + ["'ll", "<|endoftext|>", "  ", "\n\n", "؀", "١"]
    enc = encoder(byte_bpe_path())
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 30)))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == plain(text), repr(text)
    long = "".join(rng.choices(alphabet, k=1_200_000))
    assert np.frombuffer(enc.encode(long), "<u4").tolist() == plain(long)


def test_special_strings_as_ordinary_text():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe_path())
    for text in ("a<|endoftext|>b", "<|endoftext|>", " <|endoftext|><|endoftext|> x" * 3, "<|endof<|endoftext|>text|>"):
        t.encode_special_tokens = False
        assert np.frombuffer(Encoder(byte_bpe_path()).encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        t.encode_special_tokens = True
        assert np.frombuffer(Encoder(byte_bpe_path(), special_as_text=True).encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, _salt int")


EDGES = [(1, "hello world", "x", 1), (1, "hello world", "x", 1), (2, None, None, None), (None, "a null id", "x", 2), (3, "", "y", 3), (4, "word " * 5000, "z", 4), (5, "an <|endoftext|> inside", "z", 4)]


def test_packing_edges(spark, plain):
    got = packing.pack_documents(docs_of(spark, EDGES)).toPandas()
    assert got.shape[0] == 6 + -(-(len(plain("word " * 5000)) + 1) // 1024)
    assert packing.pack_documents(docs_of(spark, [])).count() == 0


def check_layout(pieces, capacity=1024):
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        ends = s["offset"] + s["length"]
        assert s["offset"].iloc[0] == 0 and (s["offset"].iloc[1:].values == ends.iloc[:-1].values).all() and ends.iloc[-1] <= capacity


def test_packing_whole_table(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.pack_documents(docs, ids=True).toPandas()
    check_layout(got)
    for doc, text in docs.select("doc_id", "text").collect():
        own = got[got.doc_id == doc].sort_values("piece")
        ids = plain(text) + [2]
        assert np.frombuffer(b"".join(own.ids), "<u4").tolist() == ids
        assert own.start.tolist() == np.concatenate([[0], own.length.cumsum().values[:-1]]).tolist()
        assert (own.length.iloc[1:] == 1024).all()
        assert own.ids_crc32.tolist() == [zlib.crc32(x) for x in own.ids]
    least = -(-int(got.length.sum()) // 1024)
    assert got.sequence_id.nunique() <= least * 1.02 + 1


def test_plan_uses_the_histogram_exactly():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50, 20000):
        hist = np.bincount(np.minimum(256, rng.geometric(0.02, n)), minlength=257)
        runs = packing.plan(hist, 256)
        used = np.zeros(257, int)
        for slots, often in runs:
            assert sum(slots) <= 256
            for v in slots:
                used[v] += often
        assert (used == hist).all()
        least = -(-int((np.arange(257) * hist).sum()) // 256)
        assert sum(often for _, often in runs) <= least * 1.02 + 1
    for v, r0, r1, _, _ in packing.slot_rows(runs):
        assert 0 <= r0 < r1 <= hist[v]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_invert(bits):
    ids = np.random.default_rng(0).integers(0, 2**32, 1003, dtype=np.uint32)
    assert (bitplanes.join_planes(bitplanes.split_planes(ids, bits), len(ids), bits) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_files_round_trip(spark, plain, bits):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = bitplanes.round_trip(docs, block_ids=1000, bits=bits).orderBy("start").collect()
    start = 0
    for row, (doc, text) in zip(got, docs.select("doc_id", "text").orderBy("doc_id").collect(), strict=True):
        ids = np.array([*plain(text), 0], "<u4")
        assert tuple(row) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_of_failed_attempts_go(spark, tmp_path):
    folder = f"file://{tmp_path}"
    (tmp_path / "planes").mkdir()
    (tmp_path / "planes" / "part-000000-dead.planes").write_bytes(b"half")
    manifest = bitplanes.write_files(docs_of(spark, EDGES), folder)
    left = sorted(p.name for p in (tmp_path / "planes").iterdir() if not p.name.startswith("."))
    assert left == sorted(r.file.rsplit("/", 1)[-1] for r in manifest.collect())
    assert bitplanes.read_files(manifest).count() == len(EDGES)


def test_files_edges(spark):
    got = bitplanes.round_trip(docs_of(spark, EDGES)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 2, 3, 4, 5]
    assert got[3].n_tokens == got[4].n_tokens == 1
    assert bitplanes.round_trip(docs_of(spark, [])).count() == 0


def test_salts_are_bounded_groups():
    assert [packing.salts_for(n) for n in (1, 1024, 1025, 10**6, 10**7, 10**9)] == [1, 1, 2, 64, 64, 3815]


@pytest.mark.parametrize("rows", [1, 1 << 18])
def test_one_length_over_many_salts(spark, rows, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_RANKED", 10)
    monkeypatch.setattr(packing, "BROADCAST_ROWS", rows)
    pieces = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") < 700, 1024).when(F.col("id") < 1400, 600).otherwise(424).cast("long").alias("length"))
    got = packing.pack_pieces(pieces).toPandas()
    assert len(got) == 2000 and got.sequence_id.nunique() == 700 + 700
    check_layout(got)
