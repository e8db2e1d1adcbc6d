"""Progress of queries: metrics per batch, gaps, skipped offsets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def skipped_rows(progress: dict, first: bool) -> int:
    """Offsets that advanced without a row read, 0 for a query's first batch and for sources without numeric offsets."""
    if first:
        return 0
    total = 0
    for source in progress.get("sources", []):
        start, end = (source.get(k) or {} for k in ("startOffset", "endOffset"))
        start, end = ((json.loads(x) if isinstance(x, str) else x) for x in (start, end))
        if not isinstance(start, dict) or not isinstance(end, dict):
            continue
        moved = sum(int(at) - int((start.get(t) or {}).get(p, 0)) for t, parts in end.items() if isinstance(parts, dict) for p, at in parts.items())
        total += max(0, moved - int(source.get("numInputRows", 0))) if any(isinstance(x, dict) for x in end.values()) else 0
    return total


class Reporter(StreamingQueryListener):
    """Collects one row per batch that did work; empty progress (no addBatch) is left out."""

    def __init__(self):
        self.rows: list[dict] = []
        self.seen: set[str] = set()

    def onQueryStarted(self, event) -> None:
        return None

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if "addBatch" not in p.get("durationMs", {}):
            return
        self.rows.append({"run": p["runId"], "batch_id": p["batchId"], "rows": p["numInputRows"], "ms": p["durationMs"]["addBatch"], "skipped": skipped_rows(p, p["runId"] not in self.seen)})
        self.seen.add(p["runId"])

    def onQueryIdle(self, event) -> None:
        return None

    def onQueryTerminated(self, event) -> None:
        return None

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "run string, batch_id long, rows long, ms long, skipped long")


def gaps(progress: DataFrame) -> DataFrame:
    """Batches of each run that left no progress."""
    span = progress.groupBy("run").agg(F.min("batch_id").alias("a"), F.max("batch_id").alias("b"))
    return span.select("run", F.explode(F.sequence("a", "b")).alias("batch_id")).join(progress.select("run", "batch_id"), ["run", "batch_id"], "left_anti")
