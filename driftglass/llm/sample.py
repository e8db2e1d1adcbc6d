"""Bounded, repeatable samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, label) of at most ``per_class`` labelled documents of either class, and the label counts of all learners.

    The documents with the least hash of their id are taken, so the sample does not depend on partitions. ``learn`` is
    the fold condition on doc_id. A document labelled twice has its larger label; null labels teach nothing.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(learn).groupBy("doc_id").agg(F.max("label").alias("label"))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    order = F.xxhash64("doc_id", F.lit(17))
    picks = [known.where(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in (0, 1)]
    chosen = F.broadcast(picks[0].union(picks[1]))  # 2 * per_class narrow rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(chosen, "doc_id").select("text", "label"), totals


def prior_shift(totals: dict[int, int], n0: int, n1: int) -> float:
    """Log odds to add where a sample has other class shares than the labels."""
    import math

    if not (n0 and n1 and totals.get(0) and totals.get(1)):
        return 0.0
    return math.log(totals[1] / totals[0]) - math.log(n1 / n0)
