"""Micro-batch sinks: idempotent hot state, cold append, retries, drain."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftglass import schema
from driftglass.operators import aggregates, merge
from driftglass.plans.store import Store

BACKOFF_S = (1, 2, 4, 8, 15, 15, 15)


def retrying(work: Callable[[], None], waits=BACKOFF_S, sleep=time.sleep, report: Callable[[bool, int], None] = lambda ok, n: None) -> int:
    """Run ``work`` until it succeeds or the waits are used up; then its error goes on, so the batch is replayed."""
    for attempt, wait in enumerate([*waits, None], start=1):
        try:
            work()
        except Exception:
            report(False, attempt)
            if wait is None:
                raise
            sleep(wait)
        else:
            report(True, attempt)
            return attempt
    return 0


class HotSink:
    """Latest row per object and a short history, as versioned folders and one pointer file.

    A batch writes ``latest/<batch>`` and ``history/<batch>`` and then moves the pointer to them: readers see both or
    neither, a failed batch leaves nothing behind that is read, and a replayed batch overwrites itself. The latest table
    has one row per object; ``latest_keep_s`` drops objects not seen for so long. The latest folder before the current one
    stays for readers that have just read the old pointer.

    The pointer knows the event times of every part of the history, so a batch is compared only with parts that can hold
    its reports. Parts that are wholly older than ``keep_s`` leave with the batch that finds them so, and more than
    ``most_parts`` become one.
    """

    def __init__(self, spark: SparkSession, folder: str, snapshot: str = "timestamp", key: str = "icao24", event: str = "time_position", ties: list[str] | None = None, keep_s: int | None = None, notify: Callable[[int], None] = lambda batch: None, waits=BACKOFF_S, latest_columns: list[str] | None = None, history_columns: list[str] | None = None, latest_keep_s: int | None = None, most_parts: int = 48):
        self.spark, self.folder, self.store = spark, folder, Store(spark)
        self.snapshot, self.key, self.event, self.ties, self.keep_s = snapshot, key, event, ties or [], keep_s
        self.notify, self.waits, self.reasons = notify, waits, []
        self.latest_columns, self.history_columns = latest_columns, history_columns
        self.latest_keep_s, self.most_parts = latest_keep_s, most_parts

    def pointer(self) -> dict | None:
        path = f"{self.folder}/pointer.json"
        return self.store.read_json(path) if self.store.has_text(path) else None

    def latest(self) -> DataFrame | None:
        p = self.pointer()
        return self.spark.read.parquet(p["latest"]) if p else None

    def history(self) -> DataFrame | None:
        p = self.pointer()
        return self.spark.read.parquet(*(x["path"] for x in p["history"])) if p else None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch: count drop reasons, keep valid keyed rows, merge, move the pointer, notify."""
        rows = schema.flag_valid(batch, self.snapshot).persist()
        try:
            self.reasons.append(aggregates.drop_reasons(rows, self.snapshot).first().asDict())
            good = schema.hot_rows(rows)
            retrying(lambda: self._commit(good, batch_id), self.waits, report=lambda ok, n: self.store.write_json(f"{self.folder}/status.json", {"ok": ok, "attempts": n, "batch": batch_id}))
        finally:
            rows.unpersist()
        self.notify(batch_id)

    @staticmethod
    def _seconds(rows: DataFrame, column: str):
        """A time column, as a timestamp or a number, in seconds."""
        return F.col(column).cast("timestamp").cast("double") if dict(rows.dtypes)[column].startswith("timestamp") else F.col(column).cast("double")

    def _extent(self, rows: DataFrame) -> dict:
        """Event times (lo, hi) and newest snapshot of some rows, in seconds; null where there are none."""
        at, seen = self._seconds(rows, self.event), self._seconds(rows, self.snapshot)
        return rows.agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.max(seen).alias("seen")).first().asDict()

    @staticmethod
    def _newest(parts: list[dict]) -> float | None:
        return max((x["seen"] for x in parts if x["seen"] is not None), default=None)

    def _commit(self, good: DataFrame, batch_id: int) -> None:
        p = self.pointer()
        if p and p["batch"] >= batch_id:
            return
        stored = self.latest()
        dated = good.select(self.history_columns) if self.history_columns else good
        good = good.select(self.latest_columns) if self.latest_columns else good
        here = self._extent(dated)
        parts, gone = (p["history"] if p else []), []
        newest = self._newest([*parts, here])
        if self.keep_s is not None and newest is not None:
            gone = [x for x in parts if x["seen"] is not None and x["seen"] < newest - self.keep_s]
            parts = [x for x in parts if x not in gone]
        new = merge.upsert_latest(stored if stored is not None else good.limit(0), good, self.key, self.snapshot, self.ties)
        if self.latest_keep_s is not None and newest is not None:
            new = new.where(self._within(new, newest, self.latest_keep_s))
        new.write.mode("overwrite").parquet(f"{self.folder}/latest/{batch_id}")
        near = [x["path"] for x in parts if here["lo"] is not None and x["lo"] is not None and x["lo"] <= here["hi"] and x["hi"] >= here["lo"]]
        past = self.spark.read.parquet(*near) if near else dated.limit(0)
        added = merge.insert_absent(past, dated, self.key, self.event, [self.snapshot, *self.ties])
        part = {"path": f"{self.folder}/history/{batch_id}", **here}
        added.write.mode("overwrite").parquet(part["path"])
        parts = [*parts, part]
        if len(parts) > self.most_parts:
            gone += parts
            parts = [self._joined(parts, newest, f"{self.folder}/history/kept-{batch_id}")]
        latest = f"{self.folder}/latest/{batch_id}"
        self._point({"batch": batch_id, "latest": latest, "history": parts}, p, [x["path"] for x in gone])

    def _point(self, new: dict, old: dict | None, gone: list[str]) -> None:
        """Move the pointer. What the last pointer named stays until the next move: its readers may have just begun."""
        old = old or {}
        self.store.write_json(f"{self.folder}/pointer.json", {**new, "gone": [*gone, *([old["latest"]] if old else [])]})
        for path in old.get("gone", []):
            self.store.delete(path)

    def _within(self, rows: DataFrame, newest: float, span_s: float):
        return self._seconds(rows, self.snapshot) >= newest - span_s

    def _joined(self, parts: list[dict], newest: float | None, path: str) -> dict:
        """Several parts as one, within the retention."""
        rows = self.spark.read.parquet(*(x["path"] for x in parts))
        if self.keep_s is not None and newest is not None:
            rows = rows.where(self._within(rows, newest, self.keep_s))
        rows.write.mode("overwrite").parquet(path)
        return {"path": path, **self._extent(self.spark.read.parquet(path))}

    def vacuum(self, as_of: float) -> int:
        """What a retention job does at ``as_of`` (seconds): history rows past ``keep_s`` go, and objects not seen for
        ``latest_keep_s``. Rows of history left."""
        p = self.pointer()
        if p is None:
            return 0
        new, tag, gone = {k: p[k] for k in ("batch", "latest", "history")}, f"{p['batch']}-{uuid.uuid4().hex[:8]}", []
        if self.keep_s is not None:
            new["history"] = [self._joined(p["history"], as_of, f"{self.folder}/history/kept-{tag}")]
            gone = [x["path"] for x in p["history"]]
        rows = self.spark.read.parquet(p["latest"])
        if self.latest_keep_s is not None:
            rows = rows.where(self._within(rows, as_of, self.latest_keep_s))
        new["latest"] = f"{self.folder}/latest/{tag}"
        rows.write.parquet(new["latest"])
        self._point(new, p, gone)
        return self.history().count()


class Retention:
    """Runs a sink's ``vacuum`` at most every ``every_s`` seconds: call ``due`` from a batch's notification or a timer.

    Nothing written yet is nothing to do, not an error.
    """

    def __init__(self, sink: HotSink, every_s: float = 600, clock: Callable[[], float] = time.time):
        self.sink, self.every_s, self.clock, self.last = sink, every_s, clock, None

    def due(self, *_) -> int | None:
        """Rows of history left, or None where it was not yet time."""
        now = self.clock()
        if self.last is not None and now - self.last < self.every_s:
            return None
        self.last = now
        return self.sink.vacuum(now)


class ColdSink:
    """All valid rows by date. A replayed batch overwrites its own folder, so each batch is there once.

    A batch is written by at most ``files`` tasks, so a date gets so many files of it: one for a batch that a rate limit
    keeps small.
    """

    def __init__(self, folder: str, snapshot: str = "timestamp", files: int = 1):
        self.folder, self.snapshot, self.files = folder, snapshot, files

    def write(self, batch: DataFrame, batch_id: int) -> None:
        rows = schema.cold_rows(schema.flag_valid(batch, self.snapshot))
        at = F.col(self.snapshot) if dict(rows.dtypes)[self.snapshot].startswith("timestamp") else F.timestamp_seconds(self.snapshot)
        rows.withColumn("dt", F.date_format(at, "yyyy-MM-dd")).coalesce(self.files).write.mode("overwrite").partitionBy("dt").parquet(f"{self.folder}/batch={batch_id}")


def start(source: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """A foreachBatch query; without ``every`` it takes what is there and ends."""
    w = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def drain(queries: list[StreamingQuery], again: Callable[[], StreamingQuery], limit_s: float = 70) -> bool:
    """Stop all queries, then run the cold one to the end on its checkpoint; whether it ended in time."""
    for q in queries:
        q.stop()
    last = again()
    done = last.awaitTermination(limit_s)
    if not done:
        last.stop()
    return bool(done)


def supervise(queries: list[StreamingQuery], timeout_s: float | None = None, every_s: float = 0.5) -> str | None:
    """Wait until any of ``queries`` ends; its error, if it had one, None if it ended by itself or the time is up.

    The caller then ends the process. An ended query is no longer among the active ones, so its own handle is asked.
    """
    until = time.monotonic() + timeout_s if timeout_s is not None else None
    while all(q.isActive for q in queries):
        if until is not None and time.monotonic() >= until:
            return None
        time.sleep(every_s)
    errors = [str(e) for q in queries if not q.isActive and (e := q.exception())]
    return errors[0] if errors else None


def fresh_checkpoint(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a query would start from the beginning."""
    return not Store(spark).list(f"{checkpoint}/commits")
