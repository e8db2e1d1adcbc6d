"""Removal of long repeated byte strings with suffix arrays.

Every byte under a ``span``-byte string that also starts elsewhere is removed. Matches never cross texts.

1. A text's windows of ``span`` bytes are grouped by content anchors (``anchors``): equal windows have equal anchors, so a
   window is compared only with windows of the same anchor hash. One row per run of windows with one anchor (a slice).
2. Anchors that occur once are done. Slices whose whole content occurs twice are repeated throughout, by their digest.
   So copies, however many, weigh no more than one row per task in the aggregates.
3. One copy of every other slice goes to a shard with all slices of its anchor. A shard has a bounded number of bytes: its
   suffix array is built by Larsson-Sadakane refinement, common prefixes follow from Kasai's rule, and windows that stand
   together under a prefix of ``span`` bytes are repeated.
4. An anchor with more than ``group`` different slices is salted over several shards. These shards deal the sorted
   digests of their windows over hash buckets, where each shard's are searched in the others' by binary search, and get
   back which are known elsewhere.

Texts are named by two digests (96 bits), stored once in buckets of that name, and handled once, whatever the number of
their rows.

Defined cases: null and empty texts have no bytes; texts shorter than ``span`` lose nothing; all rows of a repeated text
of at least ``span`` bytes lose it all; rows with equal doc_id are rows of their own; a null doc_id is kept; extra columns
are not read, and those named like a result are replaced; an empty table gives an empty result; a very long text is cut
into anchors a megabyte at a time, and only its repeated slices leave its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.anchors import window_anchors
from driftglass.llm.blocks import bucket_count, by_bucket, dealt, rows_of
from driftglass.llm.shared import batch, drop_folder, keep, keep_bucketed, shared_dir, tidied

#: A task sorts so many bytes at once: each takes some 150 bytes of arrays.
SHARD_BYTES = 1 << 19


def suffix_array(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank of every suffix) by Larsson-Sadakane refinement.

    The first order is by eight bytes. Then only suffixes that still share their group are ordered by the rank of the
    suffix h further on, h doubling; a suffix that runs out is smaller.
    """
    n = len(raw)
    x = np.zeros(n + 8, np.uint64)
    x[:n] = raw
    for d in (1, 2, 4):
        x[:-d] = (x[:-d] << np.uint64(8 * d)) | x[d:]
    first = x[:n]
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    key = first[order]
    lead = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), np.arange(n), 0))
    rank[order] = lead
    h, places = 8, np.arange(n)  # places in the order that may still move
    while True:
        groups = lead[places] if len(places) != n else lead
        same = np.zeros(len(places), bool)
        same[1:] = groups[1:] == groups[:-1]
        same[:-1] |= same[1:]
        places, groups = places[same], groups[same]
        if not len(places):
            return order, rank
        at = order[places]
        ahead = at + h
        inside = ahead < n
        nxt = np.where(inside, rank[np.minimum(ahead, n - 1)], n - 1 - ahead)
        both = groups * np.int64(2 * n + h + 2) + (nxt + n + h + 1)
        by = np.argsort(both, kind="stable")
        both, at = both[by], at[by]
        order[places] = at
        new = np.concatenate([[True], both[1:] != both[:-1]])
        fresh = np.maximum.accumulate(np.where(new, places, 0))
        lead[places] = fresh
        rank[at] = fresh
        h *= 2


def common_prefixes(raw: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with the one before it in the order (0 for the first).

    Kasai's rule: going on by one position in the text shortens the prefix by one at most, and by exactly one where the
    bytes before both suffixes are equal. Only the other positions are compared, eight bytes at a time.
    """
    n = len(raw)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    back = np.maximum(before - 1, 0)
    kept = np.zeros(n, bool)
    kept[1:] = (before[1:] > 0) & (before[:-1] == before[1:] - 1) & (raw[back[1:]] == raw[:-1])
    heads = np.flatnonzero(~kept & (before >= 0))
    x = np.zeros(n + 16, np.uint64)
    x[:n] = raw
    for d in (1, 2, 4):
        x[:-d] = (x[:-d] << np.uint64(8 * d)) | x[d:]
    length = np.zeros(n, np.int64)
    live = heads
    while len(live):
        a, b = live + length[live], before[live] + length[live]
        room = n - np.maximum(a, b)
        a, b = np.minimum(a, n), np.minimum(b, n)
        off = x[a] ^ x[b]
        # leading equal bytes of two big-endian words
        equal = np.full(len(live), 8)
        for k in range(7, -1, -1):
            equal[(off >> np.uint64(8 * (7 - k))) & np.uint64(255) != 0] = k
        got = np.minimum(equal, room)
        length[live] += got
        live = live[(got == 8)]
    # the others follow from the last compared position
    last = np.maximum.accumulate(np.where(kept, 0, np.arange(n)))
    length = np.where(kept, length[last] - (np.arange(n) - last), length)
    return length[order]


def _anchors(batches: Iterator[pa.RecordBatch], span: int, k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, names, marks = b.column(2), b.column(0), b.column(1)
        held, first, size = [], 0, 0
        for i in range(b.num_rows + 1):
            if i == b.num_rows or size >= 1 << 20:
                if size:
                    yield _anchor_rows(held, names.slice(first, len(held)), marks.slice(first, len(held)), span, k)
                held, first, size = [], i, 0
            if i < b.num_rows:
                held.append((texts[i].as_py() or "").encode())
                size += len(held[-1])


def _anchor_rows(texts: list[bytes], t1: pa.Array, t2: pa.Array, span: int, k: int) -> pa.RecordBatch:
    whole = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    h, lo, hi = window_anchors(np.frombuffer(whole, np.uint8), ends, span, k)
    view = memoryview(whole)
    digest = np.fromiter((xxhash.xxh3_64_intdigest(view[a : e + span]) for a, e in zip(lo.tolist(), hi.tolist(), strict=True)), np.uint64, len(lo))
    own = np.searchsorted(ends, lo, side="right")
    start = np.concatenate([[0], ends])[own]
    own = pa.array(own)
    return batch(h=pa.array(h.view(np.int64)), digest=pa.array(digest.view(np.int64)), t1=t1.take(own), t2=t2.take(own), lo=pa.array(lo - start), hi=pa.array(hi - start))


def _cut(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the slices asked from each text."""
    for row in rows_of(batches):
        raw = row["text"].encode()
        s = row["slices"]
        yield batch(
            h=pa.array([x["h"] for x in s], pa.int64()),
            shard=pa.array([x["shard"] for x in s], pa.string()),
            t1=pa.array([row["t1"]] * len(s), pa.int64()),
            t2=pa.array([row["t2"]] * len(s), pa.int64()),
            lo=pa.array([x["lo"] for x in s], pa.int64()),
            open=pa.array([x["open"] for x in s], pa.bool_()),
            salted=pa.array([x["salted"] for x in s], pa.bool_()),
            raw=pa.array([raw[x["lo"] : x["hi"] + span] for x in s], pa.binary()),
        )


def shard_classes(slices: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, slice, class) of every window of a shard; windows of one class are equal."""
    raw = np.frombuffer(b"".join(slices), np.uint8)
    size = np.array([len(s) for s in slices])
    ends = np.cumsum(size)
    order, rank = suffix_array(raw)
    apart = common_prefixes(raw, order, rank) < span
    classes = np.empty(len(raw), np.int64)
    classes[order] = np.cumsum(apart)
    owner = np.repeat(np.arange(len(slices)), size)
    at = np.flatnonzero(np.arange(len(raw)) + span <= ends[owner])
    return at, owner[at], classes[at]


def _shards(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Whole shards gathered up to SHARD_BYTES."""
    held, size = [], 0
    for _, group in by_bucket({"bucket": r["shard"], **r} for r in rows):
        held += group
        size += sum(len(r["raw"]) for r in group)
        if size >= SHARD_BYTES or group[0]["salted"]:
            yield held
            held, size = [], 0
    if held:
        yield held


def _spans(rows: list[dict], at: np.ndarray, owner: np.ndarray, span: int) -> pa.RecordBatch:
    """Runs of neighbouring windows as (t1, t2, first byte, end)."""
    starts = np.cumsum([0, *(len(r["raw"]) for r in rows)])
    ok = np.array([r["open"] for r in rows], bool)[owner]
    at, owner = at[ok], owner[ok]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(at) - 1)[: len(first)]
    own = [rows[k] for k in owner[first].tolist()]
    lo = np.array([r["lo"] for r in own], np.int64) - starts[owner[first]]
    return batch(t1=pa.array([r["t1"] for r in own], pa.int64()), t2=pa.array([r["t2"] for r in own], pa.int64()), lo=pa.array(at[first] + lo, pa.int64()), end=pa.array(at[last] + lo + span, pa.int64()))


def _repeated(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Spans of windows that occur twice within their shard."""
    for rows in _shards(rows_of(batches)):
        at, owner, classes = shard_classes([r["raw"] for r in rows], span)
        often = np.bincount(classes)
        twice = often[classes] > 1
        yield _spans(rows, at[twice], owner[twice], span)


def _window_digests(rows: list[dict], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at, owner, classes = shard_classes([r["raw"] for r in rows], span)
    whole = memoryview(b"".join(r["raw"] for r in rows))
    names, first, inverse = np.unique(classes, return_index=True, return_inverse=True)
    digest = np.fromiter((xxhash.xxh3_64_intdigest(whole[p : p + span]) for p in at[first].tolist()), np.uint64, len(first))
    return at, owner, digest, inverse


def _ask(batches: Iterator[pa.RecordBatch], span: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for rows in _shards(rows_of(batches)):
        digest = np.sort(_window_digests(rows, span)[2])
        bucket = digest % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        yield from dealt(rows[0]["shard"], order, bucket[order], digests=digest[order])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in by_bucket(rows_of(batches)):
        own = [np.frombuffer(r["digests"], np.uint64) for r in rows]
        merged = np.sort(np.concatenate(own))
        # a digest is once in each shard that has it, so it is elsewhere if its run in the merged order is longer
        elsewhere = [d[np.searchsorted(merged, d, "right") - np.searchsorted(merged, d, "left") > 1] for d in own]
        yield batch(shard=pa.array([r["block"] for r in rows]), known=pa.array([d.tobytes() for d in elsewhere], pa.binary()))


def _told(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for rows in _shards(rows_of(batches)):
        at, owner, digest, inverse = _window_digests(rows, span)
        known = np.concatenate([np.frombuffer(k, np.uint64) for k in rows[0]["known"]])
        found = np.isin(digest, known)[inverse]
        yield _spans(rows, at[found], owner[found], span)


def distinct_texts(docs: DataFrame, folder: str) -> DataFrame:
    """(t1, t2, text, copies) of every distinct text of ``docs``, stored in buckets of its name: the one shuffle of texts."""
    texts = named(docs).select("t1", "t2", "text").groupBy("t1", "t2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return keep_bucketed(texts, f"{folder}/texts", "t1", "t2")


def repeated_spans(texts: DataFrame, folder: str, span: int = 400, k: int = 200, group: int = 1024) -> DataFrame:
    """(t1, t2, lo, end): stored byte spans of ``texts`` (see ``distinct_texts``) that start elsewhere in them, too."""
    spark = texts.sparkSession
    found = keep(texts.select("t1", "t2", "text").mapInArrow(tidied(partial(_anchors, span=span, k=k)), "h long, digest long, t1 long, t2 long, lo long, hi long"), f"{folder}/anchors")
    heads = found.groupBy("h").agg(F.count("*").alias("n"), F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("n > 1")
    # stored, so that the join has exchanges of its own and a hot anchor's partition can be split
    heads = keep(heads.select("h", (F.col("d0") < F.col("d1")).alias("mixed")), f"{folder}/heads")
    again = keep(found.join(heads, "h"), f"{folder}/again")
    drop_folder(spark, f"{folder}/anchors", f"{folder}/heads")
    slices = again.where("mixed").groupBy("h", "digest").agg(F.count("*").alias("n"), F.min(F.struct("t1", "t2", "lo", "hi")).alias("one"))
    slices = keep(slices, f"{folder}/slices")
    whole = again.where("not mixed").select("t1", "t2", "lo", (F.col("hi") + span).alias("end"))
    copies = again.where("mixed").join(slices.where("n > 1").select("h", "digest"), ["h", "digest"]).select("t1", "t2", "lo", (F.col("hi") + span).alias("end"))

    many = keep(slices.groupBy("h").agg(F.count("*").alias("kinds")), f"{folder}/many")
    parts = F.ceil(F.col("kinds") / F.lit(group)).cast("long")
    wanted = slices.join(many, "h").select("h", "one.*", (F.col("n") == 1).alias("open"), (parts > 1).alias("salted"), F.concat_ws("/", "h", F.pmod("digest", parts)).alias("shard"))
    wanted = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct("h", "lo", "hi", "open", "salted", "shard")).alias("slices"))
    cut = texts.join(wanted, ["t1", "t2"]).mapInArrow(tidied(partial(_cut, span=span)), "h long, shard string, t1 long, t2 long, lo long, open boolean, salted boolean, raw binary")
    cut = cut.repartition("shard").sortWithinPartitions("shard", "t1", "t2", "lo")
    salted = many.where(F.col("kinds") > group).limit(1).count() > 0
    if salted:
        cut = keep(cut, f"{folder}/cut")
    schema = "t1 long, t2 long, lo long, end long"
    near = keep(cut.mapInArrow(tidied(partial(_repeated, span=span)), schema), f"{folder}/near")
    out = whole.union(copies).union(near)
    if salted:
        buckets = bucket_count(texts)
        hot = cut.where("salted").repartition("shard").sortWithinPartitions("shard", "t1", "t2", "lo")
        asked = hot.mapInArrow(tidied(partial(_ask, span=span, buckets=buckets)), "bucket int, block string, digests binary")
        told = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(_answer), "shard string, known binary").groupBy("shard").agg(F.collect_list("known").alias("known"))
        both = hot.join(told, "shard").repartition("shard").sortWithinPartitions("shard", "t1", "t2", "lo")
        out = out.union(keep(both.mapInArrow(tidied(partial(_told, span=span)), schema), f"{folder}/far"))
    return out


def named(docs: DataFrame) -> DataFrame:
    """``docs`` with text as a non-null string and its names t1 and t2."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("text", text).withColumns({"t1": F.xxhash64("text"), "t2": F.crc32(F.col("text").cast("binary"))})


def runs_to_remove(raw: bytes, spans: list[tuple[int, int]], least_words: int, least_bytes: int) -> list[tuple[int, int]]:
    """Maximal runs of ``spans`` that have ``least_words`` words or ``least_bytes`` bytes (both 0: all)."""
    runs: list[list[int]] = []
    for lo, end in sorted(spans):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([lo, end])
    return [(lo, end) for lo, end in runs if end - lo >= least_bytes or len(raw[lo:end].split()) >= least_words]


def _kept(batches: Iterator[pa.RecordBatch], texts: bool, span: int, least_words: int, least_bytes: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, list] = {c: [] for c in ("t1", "t2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for row in rows_of([b]):
            raw, digest, parts, at = row["text"].encode(), hashlib.sha256(), [], 0
            again = [(s["lo"], s["end"]) for s in row["spans"] or []]
            if row["copies"] > 1 and len(raw) >= span:
                again = [(0, len(raw))]
            runs = runs_to_remove(raw, again, least_words, least_bytes)
            for lo, end in runs:
                parts.append(raw[at:lo])
                at = end
            parts.append(raw[at:])
            left = sum(map(len, parts))
            for p in parts:
                digest.update(p)
            for c, v in (("t1", row["t1"]), ("t2", row["t2"]), ("n_bytes", len(raw)), ("n_removed", len(raw) - left), ("n_spans", len(runs)), ("kept_sha256", digest.hexdigest())):
                out[c].append(v)
            out["kept"].append(b"".join(parts).decode(errors="ignore") if texts and runs else None)
        yield batch(**{c: pa.array(v, pa.string() if c in ("kept_sha256", "kept") else pa.int64()) for c, v in out.items()})


def remove_repeats(docs: DataFrame, span: int = 400, k: int = 200, group: int = 1024, texts: bool = False, least_words: int = 0, least_bytes: int = 0) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and, with ``texts``, kept: what is left of a text that lost
    something, null for the others. ``kept`` drops the bytes of a character that was cut apart.

    Of the maximal runs of repeated windows only those with ``least_words`` words or ``least_bytes`` bytes go (both 0: all).
    """
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession)
    once = distinct_texts(docs, folder)
    spans = repeated_spans(once, folder, span, k, group).groupBy("t1", "t2").agg(F.collect_list(F.struct("lo", "end")).alias("spans"))
    schema = "t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
    told = once.join(spans, ["t1", "t2"], "left").select("t1", "t2", "text", "copies", "spans")
    left = keep(told.mapInArrow(tidied(partial(_kept, texts=texts, span=span, least_words=least_words, least_bytes=least_bytes)), schema), f"{folder}/left")
    drop_folder(spark, *(f"{folder}/{name}" for name in ("texts", "again", "slices", "many", "cut", "near", "far")))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if texts else [])]
    rows = named(docs.drop(*(c for c in ("t1", "t2", *names) if c in docs.columns))).drop(*([] if texts else ["text"]))
    return rows.join(left.select("t1", "t2", *names), ["t1", "t2"]).drop("t1", "t2")
