"""Connected components over an edge table, by minimum labels and pointer jumping on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.llm.shared import drop_folder, keep, shared_dir


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """(v, label): every vertex of ``edges`` with the smallest vertex of its component.

    Every round takes the least label of all neighbours and then the label of that label, so chains shrink by halves.
    A round is written to the shared folder and read back; all aggregates are partial minima, so no neighbourhood is
    gathered. Self edges are allowed (they name isolated vertices).
    """
    spark = edges.sparkSession
    folder = shared_dir(spark)
    both = edges.select(F.col(a).alias("v"), F.col(b).alias("u")).union(edges.select(F.col(b), F.col(a))).distinct()
    both = keep(both, f"{folder}/edges")
    labels = keep(both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("label")), f"{folder}/round-0")
    for k in range(1, max_rounds + 1):
        near = both.join(labels.select(F.col("v").alias("u"), "label"), "u").groupBy("v").agg(F.min("label").alias("near"))
        low = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("v").alias("low"), F.col("label").alias("next"))
        new = low.join(jump, "low").select("v", F.least("low", "next").alias("label"), (F.col("label") != F.least("low", "next")).alias("moved"))
        new = keep(new, f"{folder}/round-{k}")
        done = new.where("moved").limit(1).count() == 0
        drop_folder(spark, f"{folder}/round-{k - 1}")
        labels = new.drop("moved")
        if done:
            drop_folder(spark, f"{folder}/edges")
            return labels
    raise RuntimeError("components did not settle")
