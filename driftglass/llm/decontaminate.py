"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is ``span`` consecutive words of an item, or all words of a shorter item. Of the hashes of k-grams in a window
of ``span`` words the least is its fingerprint (k + w - 1 = span, w k-grams a window), so a shared window always has a
shared fingerprint. Documents and items are joined on fingerprints; the hits are then extended: a fingerprint's places in
the text and in the item say how far the one is shifted against the other, and along every such shift the words of both
are compared, window by window.

Texts are named by a digest, so copies of a text are looked at once per pair. Fingerprints and candidates are broadcast
only while their counted rows stay under a bound; beyond it the same joins shuffle.

No filter stands on a computed array: Catalyst would push it down and inline the word split into the lambdas. So marks
are exploded with explode_outer and empty results fall to joins and aggregates.

Defined cases: null texts and items have no words; items with a null item_id are not looked at; rows with equal doc_id
are judged each; equal item_ids count once; extra columns are not read; an empty benchmark hits nothing; an empty table
gives an empty result; a very long text is one row, its words an array of that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftglass.llm.shared import keep, shared_dir, unused

CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"
AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z only; ``lower`` does the same, and faster, where no other capital occurs."""
    return F.when(text.rlike(UPPER), F.translate(text, AZ, az)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), CUT), lambda w: w != "")


def starts_of(words: Column, length: int) -> Column:
    """1-based starts of runs of ``length`` words."""
    last = F.size(words) - length + 1
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def grams(words: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words: those of their arrays, without making the arrays."""
    return F.transform(starts_of(words, k), lambda i: F.xxhash64(*(F.get(words, i + (d - 1)) for d in range(k))))


def least_of(values: list[Column]) -> Column:
    return F.least(*values) if len(values) > 1 else values[0]


def fingerprints(df: DataFrame, words: str, span: int, k: int, short: list[int]) -> DataFrame:
    """Add _marks: distinct winnowed k-gram hashes, and all n-gram hashes of the lengths in ``short``."""
    width = span - k + 1
    df = df.withColumn("_grams", grams(F.col(words), k))
    least = F.transform(starts_of(F.col("_grams"), width), lambda i: least_of([F.get("_grams", i + (d - 1)) for d in range(width)]))
    marks = [least, *(grams(F.col(words), n) for n in short)]
    return df.withColumn("_marks", F.array_distinct(F.concat(*marks) if short else least)).drop("_grams")


def small(df: DataFrame, bound: int) -> DataFrame:
    """A broadcast hint while the stored table has at most ``bound`` narrow rows."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5, bound: int = 200_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted array), items_sha256, contaminated for every row of ``docs``."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("_item")).where("item_id is not null and size(_item) > 0")
    # an id may stand for several texts
    items = keep(items.withColumn("_length", F.least(F.size("_item"), F.lit(span))).withColumn("_row", F.xxhash64("_item")).dropDuplicates(["item_id", "_row"]), f"{folder}/items")
    short = sorted(r[0] for r in items.select("_length").distinct().collect() if r[0] < span)  # at most span - 1 numbers
    full = fingerprints(items.where(F.col("_length") == span), "_item", span, k, []).select("item_id", "_row", F.explode_outer("_marks").alias("mark"))
    brief = items.where(F.col("_length") < span).select("item_id", "_row", F.xxhash64("_item").alias("mark"))
    marks = keep(full.union(brief).distinct(), f"{folder}/marks")

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.md5(text.cast("binary")).alias("_name"), text.alias("_text"))
    asked = fingerprints(texts.withColumn("_words", words_of(F.col("_text"))), "_words", span, k, short).select("_name", F.explode_outer("_marks").alias("mark"))
    met = asked.join(small(marks, bound), "mark").groupBy("_name", "item_id", "_row").agg(F.collect_set("mark").alias("_met"))
    pairs = keep(met, f"{folder}/pairs")

    both = texts.join(small(pairs, bound), "_name").withColumn("_words", words_of(F.col("_text"))).drop("_text").join(small(items, bound // 50), ["item_id", "_row"])
    gram = F.when(F.col("_length") == span, k).otherwise(F.col("_length"))

    def places(words: str) -> Column:
        """Where a met fingerprint stands: its hash and the first word's number, from 1."""
        last = F.size(words) - gram + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        each = F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice(words, i, gram)).alias("h"), i.alias("i")))
        return F.filter(each, lambda x: F.array_contains("_met", x["h"]))

    shifts = F.array_distinct(F.flatten(F.transform("_here", lambda p: F.transform(F.filter("_there", lambda q: q["h"] == p["h"]), lambda q: p["i"] - q["i"]))))
    both = both.withColumns({"_here": places("_words"), "_there": places("_item")}).withColumn("_shifts", shifts)

    def equal_windows(d: Column) -> Column:
        lo, hi = F.greatest(F.lit(1), d + 1), F.least(F.size("_words"), F.size("_item") + d) - F.col("_length") + 1
        starts = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
        return F.filter(starts, lambda s: F.slice("_words", s, F.col("_length")) == F.slice("_item", s - d, F.col("_length")))

    begins = F.array_distinct(F.flatten(F.transform("_shifts", equal_windows)))
    # the filter stands above the aggregate: below it, it would be inlined with the word split inside the lambda
    hits = both.select("_name", "item_id", "_row", "_length", begins.alias("_begins")).groupBy("_name", "item_id", "_row", "_length").agg(F.first("_begins").alias("_begins"))
    hits = hits.where("size(_begins) > 0")
    spots = F.flatten(F.transform("_begins", lambda b: F.sequence(b, b + F.col("_length") - 1)))
    found = hits.select("_name", "item_id", spots.alias("_spots")).groupBy("_name").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.size(F.array_distinct(F.flatten(F.collect_list("_spots")))).cast("long").alias("n_hit")
    )
    found = keep(found, f"{folder}/found")
    rows = docs.select("doc_id", F.md5(text.cast("binary")).alias("_name"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    out = rows.join(small(found, bound), "_name", "left").withColumn("items", F.coalesce("items", none))
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "items",
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, as they are (equal texts share their fate)."""
    spark = docs.sparkSession
    own = unused(docs, "name")
    name = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    # a digest as the id: whether a row goes depends on its text alone
    marked = contamination(docs.select(name.alias("doc_id"), "text"), benchmark, **options)
    bad = keep(marked.where("contaminated").select(F.col("doc_id").alias(own)).distinct(), f"{shared_dir(spark)}/contaminated")
    return docs.withColumn(own, name).join(small(bad, options.get("bound", 200_000)), own, "left_anti").select(*docs.columns)
