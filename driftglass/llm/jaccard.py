"""Exact Jaccard join on word n-grams by T-occurrence search (DivideSkip).

1. Documents become word blocks; each distinct shingle set is handled once (sets are named by a 128-bit digest).
2. Every shingle's document frequency class (its binary logarithm) comes back to the blocks from hash buckets. Sets are
   ordered by (class, hash), rare shingles first. Two sets of similarity t share a shingle among the first
   n - ceil(t n) + 1 of both in any common order, so only these prefixes are joined, and a shingle of one document leaves
   no posting. Passages that many documents share come last in the order and stay out of the prefixes.
3. Sets that share a prefix shingle form a candidate group. A group of at most ``group`` sets is searched in one task:
   inverted lists per shingle; the required overlap T of a query gives how many of its longest lists may be left out of
   the merge (L < T); sets found T - L times in the short lists are probed in the long ones by binary search.
4. Larger groups, which chains of unrelated sets may form, are not searched as such but by prefix shingle. First every
   set is matched with the least named set of each of its shingles; that contracts groups of copies to parts. Then, under
   each shingle whose sets are of several parts, the sets outside its largest part are searched against all of them, in
   tasks of bounded size. Shingles with the same sets are searched once. A pair that links has a prefix shingle in common,
   so no link between two parts is left out; pairs inside one part are already known to be connected.
5. Links give components; a class's id is the smallest doc_id in it.

Defined cases: null, empty and blank texts have no shingles and no links (component_id is their own doc_id); a text of
fewer words than the shingle is one shingle of all its words; rows with equal doc_id are rows of their own; a null
doc_id is ignored in the minimum; extra columns are not read; an empty table gives an empty result; a very long text is
a block of its own, read a few megabytes at a time, and one set of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.blocks import Block, bucket_count, by_bucket, dealt, mix, rows_of, word_blocks
from driftglass.llm.components import connected_components
from driftglass.llm.shared import batch, drop_folder, keep, keep_bucketed, shared_dir, tidied, unused

STEP = np.uint64(0x9E3779B97F4A7C15)
KEY_BITS = np.uint64(24)


def shingle_sets(block: Block, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document of a block."""
    h = mix(block.vocab + np.uint64(1))[block.words] if len(block.words) else np.zeros(0, np.uint64)
    n = len(h)
    with np.errstate(over="ignore"):
        acc = np.zeros(max(0, n - words + 1), np.uint64)
        for k in range(words):
            acc = acc * STEP + h[k : n - words + 1 + k] if len(acc) else acc
        acc = mix(acc)
        out = []
        for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
            if b - a >= words:
                out.append(np.unique(acc[a : b - words + 1]))
            elif b > a:
                one = np.uint64(0)
                for x in h[a:b]:
                    one = one * STEP + x
                # a short sequence never equals a full shingle
                out.append(mix(np.array([one + np.uint64(b - a)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        block = Block(row)
        sets = shingle_sets(block, words)
        yield batch(
            block=pa.array([block.block] * len(sets)),
            nth=pa.array(range(len(sets)), pa.int32()),
            doc_id=pa.array(block.docs, pa.int64()),
            mark=pa.array(block.folds, pa.int64()),
            n=pa.array([len(s) for s in sets], pa.int64()),
            name=pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
        )


def bucket_order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and 40-bit form of every key, and the order by both. Keys that fall together only blur a class."""
    bucket, short = keys % np.uint64(buckets), keys >> KEY_BITS
    return bucket, short, np.argsort((bucket << np.uint64(40)) | short, kind="stable")


def _ask(batches: Iterator[pa.RecordBatch], words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        sets = shingle_sets(Block(row), words)
        own = [sets[k] for k in row["firsts"]]
        keys, often = np.unique(np.concatenate(own), return_counts=True)
        bucket, short, order = bucket_order(keys, buckets)
        low, high = (short[order] & np.uint64(0xFFFFFFFF)).astype("<u4"), (short[order] >> np.uint64(32)).astype(np.uint8)
        yield from dealt(row["block"], order, bucket[order], low=low, high=high, often=often[order].astype("<u4"))


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in by_bucket(rows_of(batches)):
        keys = [np.frombuffer(r["low"], "<u4").astype(np.uint64) | (np.frombuffer(r["high"], np.uint8).astype(np.uint64) << np.uint64(32)) for r in rows]
        all_keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate([np.frombuffer(r["often"], "<u4") for r in rows]), minlength=len(all_keys))
        grade = np.floor(np.log2(total)).astype(np.uint8)[at]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        parts = np.split(grade, cuts)
        yield batch(block=pa.array([r["block"] for r in rows]), bucket=pa.array([bucket] * len(rows), pa.int32()), grades=pa.array([p.tobytes() for p in parts], pa.binary()))


def _prefixes(batches: Iterator[pa.RecordBatch], words: int, buckets: int, percent: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        sets = shingle_sets(Block(row), words)
        keys = np.unique(np.concatenate([sets[k] for k in row["firsts"]]))
        _, _, order = bucket_order(keys, buckets)
        grade = np.empty(len(keys), np.uint8)
        grade[order] = np.frombuffer(b"".join(x["grades"] for x in sorted(row["answers"], key=lambda x: x["bucket"])), np.uint8)
        names, counts, blobs, marks = [], [], [], []
        for k in row["firsts"]:
            s = sets[k]
            g = grade[np.searchsorted(keys, s)]
            most = len(s) - -(-percent * len(s) // 100) + 1
            first = np.lexsort((s, g))[:most]
            first = s[first[g[first] > 0]]
            if len(first):
                names.append(xxhash.xxh3_128_digest(s.tobytes()))
                counts.append(len(s)), blobs.append(s.tobytes()), marks.append(first.view(np.int64).tolist())
        if names:
            yield batch(name=pa.array(names, pa.binary()), n=pa.array(counts, pa.int64()), shingles=pa.array(blobs, pa.binary()), marks=pa.array(marks, pa.list_(pa.int64())))


class Lists:
    """Inverted lists of a bounded group of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.keys, self.at = np.unique(flat[order], return_index=True)
        self.ends = np.append(self.at[1:], len(flat))

    def search(self, s: np.ndarray, percent: int, mu: float = 0.05) -> np.ndarray:
        """Positions of the sets y with 100 |s and y| >= percent |s or y| (DivideSkip)."""
        k = np.searchsorted(self.keys, s)
        k = np.minimum(k, len(self.keys) - 1)
        k = k[self.keys[k] == s]
        need = -(-percent * len(s) // 100)
        if len(k) < need:
            return np.zeros(0, np.int64)
        length = self.ends[k] - self.at[k]
        k = k[np.argsort(length, kind="stable")]
        longest = max(1, int(length.max()))
        skip = min(need - 1, int(need / (mu * np.log2(longest + 1) + 1)))
        short, long = (k[: len(k) - skip], k[len(k) - skip :]) if skip else (k, k[:0])
        merged = np.concatenate([self.owner[self.at[i] : self.ends[i]] for i in short.tolist()])
        found, often = np.unique(merged, return_counts=True)  # one sort merges the runs
        # sizes outside the length bound can't reach the overlap
        ok = (often >= need - skip) & (100 * self.sizes[found] >= percent * len(s)) & (percent * self.sizes[found] <= 100 * len(s))
        found, often = found[ok], often[ok].astype(np.int64)
        for i in long.tolist():
            if not len(found):
                break
            run = self.owner[self.at[i] : self.ends[i]]
            p = np.minimum(np.searchsorted(run, found), len(run) - 1)
            often += run[p] == found
        union = len(s) + self.sizes[found] - often
        return found[100 * often >= percent * union]


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _search(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links that connect a task's parts: query rows against all rows of the task."""
    for _, rows in by_bucket({"bucket": r["task"], **r} for r in rows_of(batches)):
        if len(rows) < 2:
            continue
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        lists, forest, a, b = Lists(sets), Forest(len(rows)), [], []
        known: dict[bytes, int] = {}
        for k, r in enumerate(rows):
            forest.join(k, known.setdefault(r["part"], k))
        for k, r in enumerate(rows):
            if r["asks"]:
                for other in lists.search(sets[k], percent).tolist():
                    if forest.join(k, other):
                        a.append(r["name"]), b.append(rows[other]["name"])
        yield batch(a=pa.array(a, pa.binary()), b=pa.array(b, pa.binary()))


def search_tasks(rows: DataFrame, percent: int) -> DataFrame:
    """Links found in tasks; ``rows`` has task, name, part, asks and shingles."""
    dealt_rows = rows.select("task", "name", "part", "asks", "shingles").repartition("task").sortWithinPartitions("task", "name")
    return dealt_rows.mapInArrow(tidied(partial(_search, percent=percent)), "a binary, b binary")


def small_group_links(members: DataFrame, percent: int, folder: str) -> DataFrame:
    """Links within candidate groups that fit a task each."""
    rows = members.select(F.hex("grp").alias("task"), "name", F.col("name").alias("part"), F.lit(True).alias("asks"), "shingles")
    return keep(search_tasks(rows, percent), f"{folder}/links-small")


def large_group_links(members: DataFrame, percent: int, folder: str, group: int) -> DataFrame:
    """Links that connect what is connected among the sets of larger groups, by prefix shingle."""
    spark, half = members.sparkSession, F.lit(max(1, group // 2))

    def cells(column: str):
        return F.greatest(F.lit(1), F.ceil(F.col(column) / half).cast("int"))

    def cell(column: str, seed: int):
        return F.pmod(F.xxhash64("name", F.lit(seed)), cells(column).cast("long")).cast("int")

    def each(column: str):
        return F.explode(F.sequence(F.lit(0), cells(column) - 1))

    def searched(refs: DataFrame, name: str) -> DataFrame:
        """Links of tasks given as (task, name, part, asks); the shingles join them here."""
        return keep(search_tasks(refs.join(members.select("name", "shingles"), "name"), percent), f"{folder}/links-{name}")

    postings = keep(members.select("name", F.explode("marks").alias("mark")), f"{folder}/postings")
    heads = postings.groupBy("mark").agg(F.min("name").alias("head"), F.max("name").alias("last")).where("head < last")
    heads = keep(heads.select("mark", "head"), f"{folder}/heads")
    stars = keep(postings.join(heads, "mark").where("name != head").select("head", "name").distinct(), f"{folder}/stars")
    sizes = keep(stars.groupBy("head").agg(F.count("*").alias("n")), f"{folder}/star-sizes")
    at = F.concat_ws("/", F.hex("head"), "cell").alias("task")
    lead = sizes.withColumn("cell", each("n")).select(at, F.col("head").alias("name"), F.col("head").alias("part"), F.lit(True).alias("asks"))
    rest = stars.join(sizes, "head").withColumn("cell", cell("n", 7)).select(at, "name", F.col("name").alias("part"), F.lit(False).alias("asks"))
    star = searched(lead.union(rest), "star")
    alone = members.select(F.col("name").alias("a"), F.col("name").alias("b"))
    parts = connected_components(star.union(alone)).select(F.col("v").alias("name"), F.col("label").alias("part"))

    placed = keep(postings.join(keep(parts, f"{folder}/parts"), "name"), f"{folder}/placed")
    drop_folder(spark, *(f"{folder}/{x}" for x in ("postings", "heads", "stars", "star-sizes", "parts")))
    kind = [F.sum(F.xxhash64("name", F.lit(k)).cast("decimal(38,0)")).alias(f"k{k}") for k in (1, 2)]
    lists = placed.groupBy("mark").agg(F.count("*").alias("members"), F.min("part").alias("p0"), F.max("part").alias("p1"), *kind).where("p0 < p1")
    once = keep(lists.groupBy("members", "k1", "k2").agg(F.min("mark").alias("mark")).select("mark", "members"), f"{folder}/lists")
    mixed = keep(placed.join(once, "mark"), f"{folder}/mixed")
    shares = mixed.groupBy("mark", "members", "part").agg(F.count("*").alias("size"))
    main = shares.groupBy("mark", "members").agg(F.max(F.struct("size", "part")).alias("top"))
    main = keep(main.select("mark", F.col("top.part").alias("main"), (F.col("members") - F.col("top.size")).alias("asking")), f"{folder}/main")
    rows = mixed.join(main, "mark").withColumn("asks", F.col("part") != F.col("main"))
    task = F.concat_ws("/", "mark", "query_cell", "cell").alias("task")
    target = rows.withColumn("cell", cell("members", 7)).withColumn("query_cell", each("asking"))
    query = rows.where("asks").withColumn("query_cell", cell("asking", 11)).withColumn("cell", each("members"))
    # a set that both asks and is asked in a task is there once
    refs = target.select(task, "name", "part", F.lit(False).alias("asks")).union(query.select(task, "name", "part", F.lit(True).alias("asks")))
    return star.union(searched(refs.groupBy("task", "name", "part").agg(F.max("asks").alias("asks")), "rest"))


def link_sets(sets: DataFrame, percent: int, folder: str, group: int = 1000) -> DataFrame:
    """(name, root) for every set with a link; ``sets`` (name, n, shingles and marks, its prefix shingles) is the stage table
    ``sets`` below ``folder``, dropped when it is not needed any more."""
    postings = sets.select("name", F.explode("marks").alias("mark"))
    heads = postings.groupBy("mark").agg(F.min("name").alias("head"), F.max("name").alias("last")).where("head < last").drop("last")
    # small sides are stored, so that either side of a join has an exchange of its own and a hot key's partition can be split
    heads = keep(heads, f"{folder}/first-heads")
    near = postings.join(heads, "mark").where("name != head").select(F.col("name").alias("a"), F.col("head").alias("b")).distinct()
    groups = connected_components(near).select(F.col("v").alias("name"), F.col("label").alias("grp"))
    sizes = keep(groups.groupBy("grp").agg(F.count("*").alias("members")), f"{folder}/sizes")
    sized = groups.join(sizes, "grp")
    members = keep(sets.select("name", "shingles", "marks").join(sized, "name"), f"{folder}/members")
    drop_folder(sets.sparkSession, f"{folder}/sets", f"{folder}/first-heads", f"{folder}/sizes")
    links = small_group_links(members.where(F.col("members") <= group), percent, folder)
    large = members.where(F.col("members") > group)
    if large.limit(1).count():
        links = links.union(large_group_links(large, percent, folder, group))
    roots = connected_components(links)
    drop_folder(sets.sparkSession, *(f"{folder}/{x}" for x in ("members", "links-small", "links-star", "links-rest", "placed", "lists", "mixed", "main")))
    return roots.select(F.col("v").alias("name"), F.col("label").alias("root"))


def set_roots(docs: DataFrame, words: int, percent: int, group: int, folder: str, mark=None) -> tuple[DataFrame, DataFrame]:
    """Stored (block, nth, doc_id, mark, n, name) per row, with ``mark`` an integer expression to carry along, and (name, root) for every set with a link."""
    buckets = bucket_count(docs)
    blocks = keep_bucketed(word_blocks(docs, mark), f"{folder}/blocks", "block")
    rows = keep(blocks.mapInArrow(tidied(partial(_sets, words=words)), "block string, nth int, doc_id long, mark long, n long, name binary"), f"{folder}/rows")
    firsts = rows.where("name is not null").groupBy("name").agg(F.min(F.struct("block", "nth")).alias("at")).groupBy("at.block").agg(F.sort_array(F.collect_list("at.nth")).alias("firsts"))
    chosen = blocks.join(firsts, "block")
    asked = chosen.mapInArrow(tidied(partial(_ask, words=words, buckets=buckets)), "bucket int, block string, low binary, high binary, often binary")
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(_answer), "block string, bucket int, grades binary")
    told = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "grades")).alias("answers"))
    sets = chosen.join(told, "block").mapInArrow(tidied(partial(_prefixes, words=words, buckets=buckets, percent=percent)), "name binary, n long, shingles binary, marks array<bigint>")
    sets = keep_bucketed(sets, f"{folder}/sets", "name")
    drop_folder(docs.sparkSession, f"{folder}/blocks")
    return rows, link_sets(sets, percent, folder, group)


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, group: int = 1000) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    folder = shared_dir(docs.sparkSession)
    rows, roots = set_roots(docs, words, percent, group, folder)
    named = rows.join(roots, "name", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "name").alias("root"))
    # stored, so that the join has exchanges of its own and a large group's partition can be split
    least = keep(named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least")), f"{folder}/least")
    return named.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def first_of_groups(docs: DataFrame, words: int = 5, percent: int = 80, group: int = 1000) -> DataFrame:
    """One row of ``docs`` per group: the least doc_id (null last), then the least text digest, then the least other columns.

    Rows whose texts have no words are in no group and stay. Equal rows are one row.
    """
    folder = shared_dir(docs.sparkSession)
    own_id, own_mark = unused(docs, "id"), unused(docs, "mark")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a row is named by its doc_id and a digest of its text, so rows with one doc_id are told apart
    mark = F.xxhash64(text, F.col("doc_id").isNull())
    rows, roots = set_roots(docs, words, percent, group, folder, mark)
    named = rows.where("name is not null").join(roots, "name", "left").select("doc_id", "mark", F.coalesce("root", "name").alias("root"))
    best = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("one"))
    best = keep(best.select(F.coalesce("one.doc_id", F.lit(0)).alias(own_id), F.col("one.mark").alias(own_mark)), f"{folder}/best")
    keyed = docs.withColumns({own_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), own_mark: mark})
    inked = text.rlike(r"[^\x20\x09-\x0D]")
    whole, others = F.struct(*docs.columns), F.to_json(F.struct(*(c for c in docs.columns if c != "text")))
    stay = keyed.where(inked).join(best, [own_id, own_mark], "left_semi").groupBy(own_id, own_mark).agg(F.min_by(whole, others).alias("row"))
    return stay.select("row.*").unionByName(docs.where(~inked))
