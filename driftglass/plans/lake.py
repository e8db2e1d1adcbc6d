"""Lake tables: partition replacement, markers, records, compaction with recovery, late files, staleness."""

from __future__ import annotations

import json
import math
import re
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftglass.functions.text import excluded_marker, marker_version, strict_date
from driftglass.operators.aggregates import fingerprint
from driftglass.plans.store import Entry, Store

DATE_DIR = re.compile(r"^dt=(\d{4}-\d{2}-\d{2})$")
TARGET_BYTES = 128 << 20


def write_partition(df: DataFrame, path: str, partition: str) -> str:
    """Replace exactly the partitions in ``df``; new columns join the table's schema on read (mergeSchema).

    Idempotent: writing the same partition twice leaves it once. One file per task and partition value.
    """
    mode = "overwrite" if Store(df.sparkSession).exists(path) else "create"
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return mode


def append_cold(df: DataFrame, path: str, snapshot: str = "timestamp") -> None:
    """Append a batch by snapshot date, one file per date."""
    df.withColumn("dt", F.date_format(snapshot, "yyyy-MM-dd")).coalesce(1).write.mode("append").partitionBy("dt").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All partitions with columns that came later as null where they are missing."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def register_views(spark: SparkSession, gold: str, names: tuple[str, ...] = ("trajectory", "aircraft_daily", "traffic_hourly")) -> list[str]:
    """Temp views of the gold tables that exist, for SQL; a filter on event_date prunes partitions."""
    found = [n for n in names if Store(spark).exists(f"{gold}/{n}")]
    for n in found:
        read_table(spark, f"{gold}/{n}").createOrReplaceTempView(n)
    return found


def read_date(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One date's folder; a missing one is an error, not an empty table."""
    strict_date(day)
    folder = f"{path}/dt={day}"
    if not Store(spark).exists(folder):
        raise FileNotFoundError(folder)
    return spark.read.option("mergeSchema", "true").parquet(folder)


def read_dates(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    """The folders of several dates with their date as dt (a date)."""
    rows = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*(f"{path}/dt={d}" for d in days))
    return rows.withColumn("dt", F.col("dt").cast("date"))


def date_batches(spark: SparkSession, path: str, key: str, days: list[str], most_bytes: int = 1 << 30, most_dates: int = 31) -> list[list[str]]:
    """The dates in order, as many at once as have few bytes together; a large date goes by itself."""
    out, held = [], 0
    for d in days:
        size = sum(f.size for f in data_files(spark, f"{path}/{key}={d}"))
        if not out or held + size > most_bytes or len(out[-1]) == most_dates:
            out, held = [*out, []], 0
        out[-1].append(d)
        held += size
    return out


def dates_under(spark: SparkSession, path: str) -> set[str]:
    """Dates with a folder; names that aren't dates are skipped."""
    out = set()
    for e in Store(spark).list(path):
        if e.is_dir and (m := DATE_DIR.match(e.name)):
            try:
                out.add(strict_date(m[1]).isoformat())
            except ValueError:
                continue
    return out


def completed_dates(spark: SparkSession, markers: str) -> set[str]:
    store = Store(spark)
    return {d for d in dates_under(spark, markers) if store.exists(f"{markers}/dt={d}/_SUCCESS")}


def data_files(spark: SparkSession, folder: str) -> list[Entry]:
    """Parquet files directly in a folder; names with _ or . in front are no data."""
    return [e for e in Store(spark).list(folder) if not e.is_dir and e.name.endswith(".parquet") and e.name[0] not in "_."]


def write_marker(spark: SparkSession, markers: str, day: str, rows: int, target: str, version: str) -> None:
    """Completion marker; call it after every write of the date has been committed."""
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    Store(spark).write_text(f"{markers}/dt={day}/_SUCCESS", f"date={day}\nrows={rows}\ntarget={target}\ncompleted_at={now}\ncode_version={version}\n")


def write_record(spark: SparkSession, path: str, record: dict) -> bool:
    """A run or quality record; a failure is reported to the caller as False, never raised."""
    try:
        Store(spark).write_json(path, record)
    except Exception as e:
        print(f"record not written: {path}: {e}")
        return False
    return True


def append_run(spark: SparkSession, folder: str, stage: str, day: str, record: dict, at: datetime | None = None) -> str | None:
    """One more run record, under a name no other run has: records are added, never replaced. Its path, None on failure."""
    now = at or datetime.now(UTC)
    path = f"{folder}/{stage}/{day}/{now.strftime('%Y%m%dT%H%M%S%fZ')}-{uuid.uuid4().hex[:8]}.json"
    body = {"stage": stage, "date": day, "recorded_at": now.strftime("%Y-%m-%dT%H:%M:%SZ"), **record}
    return path if write_record(spark, path, body) else None


def run_records(spark: SparkSession, folder: str) -> DataFrame:
    """(stage, dt, recorded_at, status, body) of all run records, in order of their writing."""
    store = Store(spark)
    rows = []
    for stage in store.list(folder):
        for day in store.list(stage.path) if stage.is_dir else ():
            for e in store.list(day.path):
                body = store.read_json(e.path)
                rows.append((stage.name, day.name, body.get("recorded_at"), body.get("status"), json.dumps(body, sort_keys=True)))
    return spark.createDataFrame(rows, "stage string, dt string, recorded_at string, status string, body string")


def markers_table(spark: SparkSession, markers: str) -> DataFrame:
    """(dt, body) of all markers, one row each."""
    store = Store(spark)
    rows = [(d, store.read_text(f"{markers}/dt={d}/_SUCCESS")) for d in sorted(completed_dates(spark, markers))]
    return spark.createDataFrame(rows, "dt string, body string")


def stale(markers: DataFrame, current: str) -> DataFrame:
    """(dt, reason) of markers another code version wrote, that name none, or that exclude their date."""
    version = marker_version(F.col("body"))
    reason = F.when(excluded_marker(F.col("body")), "excluded").when(version.isNull(), "unknown").when(version != current, "older")
    return markers.select("dt", reason.alias("reason")).where("reason is not null")


def late_files(spark: SparkSession, table: str, markers: str) -> DataFrame:
    """(dt, file) of data files newer than their date's marker; compaction output doesn't count."""
    store, rows = Store(spark), []
    for d in sorted(completed_dates(spark, markers)):
        done = next(e.modified_ms for e in store.list(f"{markers}/dt={d}") if e.name == "_SUCCESS")
        rows += [(d, e.name) for e in data_files(spark, f"{table}/dt={d}") if e.modified_ms > done and not e.name.startswith("merged-")]
    return spark.createDataFrame(rows, "dt string, file string")


class Crash(RuntimeError):
    """Raised by tests between the phases of a compaction."""


def compact(spark: SparkSession, table: str, day: str, sort: list[str], target_bytes: int = TARGET_BYTES, stop_after: str = "") -> str:
    """Rewrite a date's small files as few sorted ones: skipped, merged or finished.

    Phases: stage a range-partitioned, sorted copy; compare fingerprints with the originals; write a manifest; move the
    staged files in; delete the originals; drop the manifest. A manifest left by a crash is finished if all its files are
    in; otherwise what was moved is taken back and the compaction starts over.
    """
    store, folder = Store(spark), f"{table}/dt={day}"
    manifest, staging = f"{table}/_compaction/{day}.json", f"{table}/_compaction/{day}-staging"
    if store.has_text(manifest):
        plan = store.read_json(manifest)
        whole = all(store.exists(m["final"]) for m in plan["merged"])
        for f in plan["originals"] if whole else [m["final"] for m in plan["merged"]]:
            store.delete(f)
        store.delete(staging)
        store.delete(manifest)
        store.delete(f"{manifest}.next")
        if whole:
            return "finished"
    files = data_files(spark, folder)
    n = math.ceil(sum(f.size for f in files) / target_bytes)
    if len(files) <= max(1, n):
        return "skipped"
    before = spark.read.option("mergeSchema", "true").parquet(*(f.path for f in files))
    before.repartitionByRange(max(1, n), *sort).sortWithinPartitions(*sort).write.mode("overwrite").option("compression", "snappy").parquet(staging)
    columns = sorted(before.columns)
    if fingerprint(before, columns).first() != fingerprint(spark.read.parquet(staging), columns).first():
        store.delete(staging)
        raise ValueError(f"compaction of {folder} changed its content")
    staged = data_files(spark, staging)
    merged = [{"staged": f.path, "final": f"{folder}/merged-{k:05d}-{f.name}"} for k, f in enumerate(staged)]
    store.write_json(manifest, {"date": day, "originals": [f.path for f in files], "merged": merged, "in_bytes": sum(f.size for f in files), "out_bytes": sum(f.size for f in staged)})
    if stop_after == "manifest":
        raise Crash(stop_after)
    for k, m in enumerate(merged):
        store.rename(m["staged"], m["final"])
        if stop_after == "first move" and k == 0 and len(merged) > 1:
            raise Crash(stop_after)
    if stop_after == "moves":
        raise Crash(stop_after)
    for f in files:
        store.delete(f.path)
    store.delete(staging)
    store.delete(manifest)
    return "merged"


def backup(spark: SparkSession, source: str, folder: str, name: str, keep: int = 5) -> list[str]:
    """Copy a table directory under a sortable name and keep the newest ones."""
    spark.read.parquet(source).write.mode("errorifexists").parquet(f"{folder}/{name}")
    store = Store(spark)
    names = [e.name for e in store.list(folder) if e.is_dir]
    for old in names[:-keep]:
        store.delete(f"{folder}/{old}")
    return names[-keep:]
