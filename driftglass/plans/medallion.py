"""Bronze to silver to gold, date by date."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from driftglass.functions.text import strict_date
from driftglass.operators import aggregates, dedup, segments
from driftglass.plans import lake
from driftglass.plans.store import Store


class DateMismatch(ValueError):
    """Rows of another date under a date's folder."""


def to_silver(bronze: DataFrame, day: str | Column) -> DataFrame:
    """One row per (key, snapshot) of a date, with its date as event_date."""
    rows = bronze.withColumn("event_date", (F.lit(day) if isinstance(day, str) else day).cast("date")).drop("dt")
    return dedup.snapshot_rows(rows, by=("event_date",))


def silver_dates(spark: SparkSession, bronze: str, silver: str, markers: str, days: list[str], version: str) -> list[dict]:
    """Refine some dates in one pass. An empty date writes nothing and no marker; one that has no folder or a row of
    another date fails by itself, before any write."""
    out = {d: failed(d, FileNotFoundError(f"{bronze}/dt={d}")) for d in days if not Store(spark).exists(f"{bronze}/dt={strict_date(d).isoformat()}")}
    if len(out) < len(days):
        raw = lake.read_dates(spark, bronze, [d for d in days if d not in out])
        rows = to_silver(raw, F.col("dt")).persist()
        try:
            found = aggregates.quality_profile(rows, F.col("event_date"), F.col("timestamp"), "event_date").collect()  # a row per date
            quality = {r.event_date.isoformat(): {k: v for k, v in r.asDict().items() if k != "event_date"} for r in found}
            out |= {d: failed(d, DateMismatch(f"{q['date_mismatch']} rows are not of {d}")) for d, q in quality.items() if q["date_mismatch"]}
            good = [d for d in quality if d not in out]
            if good:
                lake.write_partition(by_date(rows.where(F.col("event_date").cast("string").isin(good)), len(good)), silver, "event_date")
        finally:
            rows.unpersist()
        for d in good:
            lake.write_record(spark, f"{markers}/_quality/{d}.json", {"stage": "silver", "date": d, **quality[d]})
            lake.write_marker(spark, markers, d, quality[d]["n_rows"], silver, version)
            out[d] = {"status": "success", "date": d, **quality[d]}
    return [out.get(d, {"status": "empty", "date": d}) for d in days]


def silver_date(spark: SparkSession, bronze: str, silver: str, markers: str, day: str, version: str) -> dict:
    """Refine one date; a missing folder and a row of another date are errors."""
    return only(silver_dates(spark, bronze, silver, markers, [day], version))


def owned_positions(silver: DataFrame, days: str | list[str]) -> DataFrame:
    """One row per position report of a date and the day before, for each date as _day. The date of a position
    (event_date) is that of its earliest snapshot among the two."""
    days = [days] if isinstance(days, str) else days
    both = silver.withColumn("_day", F.explode(F.array("event_date", F.date_add("event_date", 1))))
    return dedup.positions(both.where(F.col("_day").cast("string").isin(days)), by=("_day",))


def gold_frames(owned: DataFrame, gap: float = 300) -> dict[str, DataFrame]:
    """Trajectory, daily and hourly of each date (_day) from the positions of it and the day before.

    Segments are built over both dates and only then cut to the date's own rows, so a segment over midnight keeps one id
    and its first row of the date keeps what precedes it.
    """
    own = F.col("event_date") == F.col("_day")
    traj = segments.trajectory(owned, gap, span=("_day",)).where(own).drop("_day")
    today = owned.where(own).drop("_day")
    return {
        "trajectory": traj.withColumn("event_time", F.timestamp_seconds("time_position")),
        "aircraft_daily": aggregates.daily(today.where("icao24 is not null"), traj, F.timestamp_seconds("time_position"), "event_date"),
        "traffic_hourly": aggregates.hourly(today, F.col("timestamp"), "event_date"),
    }


def gold_dates(spark: SparkSession, silver: str, gold: str, markers: str, days: list[str], version: str, gap: float = 300) -> list[dict]:
    """Build and replace the three gold partitions of some dates in one pass, then mark them. Rows are counted as they
    are written."""
    before = {(strict_date(d) - timedelta(days=1)).isoformat() for d in days}
    rows = lake.read_table(spark, silver).withColumn("event_date", F.col("event_date").cast("date"))
    date = F.col("event_date").cast("string")
    full = sorted(r.d for r in rows.where(date.isin(days)).select(date.alias("d")).distinct().collect())  # a row per date
    counts = {d: {} for d in full}
    if full:
        owned = owned_positions(rows.where(date.isin(sorted({*before, *days}))), full).persist()
        try:
            for name, frame in gold_frames(owned, gap).items():
                seen = Observation(name)
                each = [F.count_if(date == d).alias(d) for d in full]
                lake.write_partition(by_date(frame, len(full)).observe(seen, *each), f"{gold}/{name}", "event_date")
                for d in full:
                    counts[d][name] = seen.get[d]
        finally:
            owned.unpersist()
    for d in full:
        lake.write_marker(spark, markers, d, counts[d]["trajectory"], gold, version)
    return [{"status": "success", "date": d, **counts[d]} if d in counts else {"status": "empty", "date": d} for d in days]


def gold_date(spark: SparkSession, silver: str, gold: str, markers: str, day: str, version: str, gap: float = 300) -> dict:
    """Build, replace and mark the three gold partitions of one date."""
    return only(gold_dates(spark, silver, gold, markers, [day], version, gap))


def by_date(df: DataFrame, dates: int) -> DataFrame:
    """Rows of several dates dealt out by date, so that a date has few files; large dates are split by size."""
    return df.hint("rebalance", F.col("event_date")) if dates > 1 else df


def failed(day: str, e: Exception) -> dict:
    return {"status": "failed", "date": day, "error": f"{type(e).__name__}: {e}", "_raised": e}


def only(results: list[dict]) -> dict:
    if "_raised" in results[0]:
        raise results[0]["_raised"]
    return results[0]


def run_dates(step, days: list[str]) -> tuple[list[dict], int]:
    """Run ``step`` for every date; a date that fails doesn't stop the others. Results and the exit code."""
    out, code = [], 0
    for day in days:
        try:
            out.append(step(day))
        except Exception as e:
            out.append({"status": "failed", "date": day, "error": f"{type(e).__name__}: {e}"})
            code = 1
    return out, code


def run_batches(step, batches: list[list[str]]) -> tuple[list[dict], int]:
    """Run ``step`` for every batch of dates; if it raises, its dates are run one by one. Results and the exit code."""
    out = []
    for days in batches:
        try:
            out += step(days)
        except Exception as e:
            out += run_dates(lambda d: only(step([d])), days)[0] if len(days) > 1 else [failed(days[0], e)]
    return [{k: v for k, v in r.items() if k != "_raised"} for r in out], int(any(r["status"] == "failed" for r in out))


def run_daily(spark: SparkSession, bronze: str, silver: str, gold: str, markers: str, today: str, version: str, gap: float = 300, sort: tuple[str, ...] = ("icao24", "timestamp")) -> dict[str, list[dict]]:
    """Everything that is due, one writer: refine pending dates, build the gold dates that are ready, compact the rest.

    What to do comes from the markers, so a run that was missed or broke off is caught up by the next one.
    """
    from driftglass.plans import planner

    def table(days: set[str]) -> DataFrame:
        return spark.createDataFrame([(d,) for d in sorted(days)], "dt string")

    def done(stage: str) -> set[str]:
        return lake.completed_dates(spark, f"{markers}/{stage}")

    raw = table(lake.dates_under(spark, bronze))
    due = [r.dt for r in planner.pending(raw, table(done("silver")), today).orderBy("dt").collect()]
    out = {"silver": run_dates(lambda d: silver_date(spark, bronze, silver, f"{markers}/silver", d, version), due)[0]}
    ready = planner.gold_plan(raw, table(done("silver")), table(done("gold")), today).where("status = 'ready'")
    out["gold"] = run_dates(lambda d: gold_date(spark, silver, gold, f"{markers}/gold", d, version, gap), [r.dt for r in ready.orderBy("dt").collect()])[0]

    def merge(day: str) -> dict:
        status = lake.compact(spark, bronze, day, list(sort))
        lake.write_marker(spark, f"{markers}/merge", day, 0, bronze, version)
        return {"status": status, "date": day}

    due = planner.merge_pending(raw, table(done("silver")), table(done("merge")), today)
    out["merge"] = run_dates(merge, [r.dt for r in due.orderBy("dt").collect()])[0]
    return out
