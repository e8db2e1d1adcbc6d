"""Line-first quality rules, with DataFrame functions only.

Every line of a text is judged by itself:

* punctuation: at least ``prose_words`` words and no sentence mark, or more symbols than ``symbol_share`` allows per word;
* navigation: separators (``|``, ``>``, ``»``, ``·``, ``•``) for every ``item_words`` words or fewer, or a line that is a menu word;
* boilerplate: a line with a stock phrase, or a repetition of an earlier line.

Lines that fail are removed (``clean_text``); a document keeps its place only if at least ``keep_percent`` of the
characters of its words are left and the base rules hold (enough words, not mostly repeated 3-word windows).

Everything is per row: no shuffle, no Python. Repeated windows are found by sorting hashes of windows within the row, and
only in rows where a hash occurs twice.

Defined cases: null and empty texts have no words (base_failed, not kept); empty lines belong to no rule; repeated rows are
judged each; a null doc_id is kept; other columns are kept as they are by ``judge`` (its own columns replace equally named
ones); an empty table gives an empty result; a very long text is one row, its windows arrays of that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
INK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MARKS = r"[.!?:;…。！？]"
SEPARATORS = r"[|>»·•]"

#: Menu words and stock phrases, matched on lower-cased lines.
MENU = "home menu login logout search next previous share print contact about archive sitemap register subscribe back top".split()
PHRASES = [
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign in",
    "sign up",
    "skip to content",
    "terms of service",
    "terms of use",
]
MENU_LINE = r"^[\x20\x09-\x0D]*(" + "|".join(MENU) + r")[\x20\x09-\x0D]*$"
PHRASE = "(" + "|".join(PHRASES) + ")"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def _count(text: Column, pattern: str) -> Column:
    """Characters of ``text`` in a one-character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _covered(starts: Column) -> Column:
    """Words under 3-word windows at ascending starts."""
    fresh = F.transform(starts, lambda x, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(starts, k - 1))))
    return F.aggregate(fresh, F.lit(0), lambda a, x: a + x)


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = df.withColumn("_text", whole).withColumn("_words", words_of(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(INK)))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    last = F.greatest(F.size("_words") - 3, F.lit(-1))
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_windows", F.transform(starts, lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))))
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(twice, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_sorted", lambda s, k: F.get("_sorted", k - 1)["h"].eqNullSafe(s["h"]) | F.get("_sorted", k + 1)["h"].eqNullSafe(s["h"]))
    df = df.withColumn("_again", F.array_sort(F.transform(again, lambda s: s["i"])))
    df = df.withColumn("n_repeat_words", F.coalesce(_covered(F.col("_again")), F.lit(0)).cast("long"))
    return df.withColumns({
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": _count(F.col("_text"), SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_windows", "_sorted", "_again")


def line_passes(line: Column, prose_words: int = 12, symbol_share: float = 0.25, item_words: int = 4) -> Column:
    """The per-line verdict, repetition aside."""
    n = F.size(words_of(line))
    low = F.lower(line)
    bare = (n >= prose_words) & ~line.rlike(MARKS)
    noisy = _count(line, SYMBOLS) > symbol_share * n
    separators = _count(line, SEPARATORS)
    menu = ((separators >= 3) & (n <= item_words * separators)) | low.rlike(MENU_LINE)
    return ~(bare | noisy | menu | low.rlike(PHRASE))


def judge(df: DataFrame, text: str = "text", keep_percent: int = 50, least_words: int = 50, repeat_percent: int = 50, **rules) -> DataFrame:
    """Add the measures, base_failed, kept_chars, kept and clean_text."""
    df = measures(df, text)
    good = F.filter(F.array_distinct("_lines"), lambda x: line_passes(x, **rules))
    df = df.withColumn("_good", good).withColumn("clean_text", F.array_join("_good", "\n"))
    df = df.withColumn("kept_chars", F.length(F.regexp_replace("clean_text", GAP, "")).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")))
    df = df.withColumn("kept", ~F.col("base_failed") & (100 * F.col("kept_chars") >= keep_percent * F.col("word_chars")))
    return df.drop("_text", "_words", "_lines", "_good")


OP2_COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
