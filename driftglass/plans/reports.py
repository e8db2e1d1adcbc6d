"""Run artifacts: metrics and gate records as tables, and the exported report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD = "run_id string, model string, version long, started timestamp, metrics map<string, double>, promoted boolean, reason string"


def read_runs(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """All run records below ``folder``, one a file or, with ``lines``, one a line; what can't be read is skipped."""
    rows = spark.read.schema(f"{RECORD}, _corrupt_record string").option("mode", "PERMISSIVE").option("ignoreMissingFiles", "true").option("multiLine", str(not lines).lower()).json(folder)
    return rows.where("run_id is not null").drop("_corrupt_record")


def export_report(runs: DataFrame, champion: DataFrame, most: int = 500) -> DataFrame:
    """One JSON text: runs by start time with their metrics and gate, and each model's champion version.

    ``champion`` has model and champion. At most ``most`` runs, the earliest first, as the report shows.
    """
    rows = runs.join(champion, "model", "left").withColumn("is_champion", F.col("version").eqNullSafe(F.col("champion"))).drop("champion")
    rows = rows.orderBy("started", "run_id").limit(most)
    key = lambda r: F.struct(r["started"], r["run_id"])  # noqa: E731  a map has no order
    one = F.collect_list(F.struct("started", "run_id", "model", "version", "is_champion", "metrics", "promoted", "reason"))
    one = F.array_sort(one, lambda a, b: F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0))
    return rows.agg(F.to_json(F.struct(F.count("*").alias("n_runs"), one.alias("runs"))).alias("report"))


def ranked(runs: DataFrame, metric: str) -> DataFrame:
    """Runs by a metric, best (least) first, ties by start, then version; runs without it come last. ``place`` counts from 1.

    A row per run: the ranks need one sort, and a registry is small.
    """
    value = F.col("metrics")[metric]
    rows = runs.select("run_id", "model", "version", value.alias("value"), "started")
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.asc_nulls_last("value"), "started", "version", "run_id"))).orderBy("place")
