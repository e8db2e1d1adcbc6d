"""Training-data pipeline over documents: five stages, each on all rows its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

1. toxicity: documents the classifier predicts toxic go. It learns from all labels.
2. near_duplicates: word 5-grams, Jaccard similarity of 0.8 or more; of every group the row with the least doc_id stays.
3. repeats: bytes under 150-byte strings that start more than once are removed where they make a run of over 50 words or
   of 400 bytes; a text that is removed whole goes. (op9 by itself takes 400 bytes; passages of 51 words are mostly shorter.)
4. decontamination: documents with a 10-word window of a benchmark item go.
5. packing: what is left is cut into pieces and packed into sequences of 1024 tokens, with the token ids.

Null and empty texts pass the stages (they are neither toxic, nor copies of one another, nor contaminated). Rows with an
equal doc_id in one near-duplicate group are told apart by their text; equal rows are one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftglass.llm import decontaminate, jaccard, packing, suffix
from driftglass.llm import toxicity as toxic
from driftglass.llm.shared import keep, read_table, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxic.train(docs, read_table(spark, sf_dir, "labels"), F.lit(True))
    return toxic.reject(docs.select(COLUMNS), model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.first_of_groups(docs.select(COLUMNS), words=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = suffix.remove_repeats(docs.select(COLUMNS), span=150, k=60, texts=True, least_words=51, least_bytes=400)
    left = cleaned.where("n_removed = 0 or n_removed < n_bytes")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumns({"text": text, "n_chars": n_chars}).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_rows(docs.select(COLUMNS), read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL expresses neither the classifier nor the tokenizer; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = keep(docs, f"{folder}/{name}")
    return docs
