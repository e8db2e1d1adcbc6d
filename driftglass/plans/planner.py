"""Which dates to process: pending, eligible, to compact, to redo. As DataFrames of dates (text, YYYY-MM-DD)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending(source: DataFrame, done: DataFrame, today: str) -> DataFrame:
    """Dates of ``source`` that are not done and over."""
    return source.select("dt").distinct().join(done.select("dt"), "dt", "left_anti").where(F.col("dt") < today)


def gold_plan(bronze: DataFrame, silver: DataFrame, gold: DataFrame, today: str) -> DataFrame:
    """(dt, status): a pending date is ready when its refined data is there and the day before's too, if it has any."""
    rows = pending(bronze.union(silver), gold, today)
    before = F.date_format(F.date_sub(F.col("dt").cast("date"), 1), "yyyy-MM-dd")
    own = silver.select("dt").distinct().withColumn("own", F.lit(True))
    prev = silver.select(F.col("dt").alias("prev")).distinct().withColumn("prev_done", F.lit(True))
    raw = bronze.select(F.col("dt").alias("prev")).distinct().withColumn("prev_raw", F.lit(True))
    rows = rows.withColumn("prev", before).join(own, "dt", "left").join(prev, "prev", "left").join(raw, "prev", "left")
    status = F.when(F.col("own").isNull(), "held: not refined").when(F.col("prev_raw") & F.col("prev_done").isNull(), "held: day before not refined").otherwise("ready")
    return rows.select("dt", status.alias("status"))


def merge_pending(bronze: DataFrame, silver: DataFrame, merged: DataFrame, today: str) -> DataFrame:
    """Refined dates with raw files that were not compacted."""
    both = bronze.select("dt").intersect(silver.select("dt"))
    return both.subtract(merged.select("dt")).where(F.col("dt") < today)


def chunks(dates: DataFrame, size: int = 10) -> DataFrame:
    """(chunk, dates): ascending dates in comma-joined groups of ``size``. A table of dates is small."""
    nth = F.row_number().over(Window.orderBy("dt")) - 1
    numbered = dates.withColumn("chunk", F.floor(nth / size))
    return numbered.groupBy("chunk").agg(F.array_join(F.array_sort(F.collect_list("dt")), ",").alias("dates"))


def reprocess(requests: DataFrame, cascade: bool = True) -> DataFrame:
    """(pos, stage, dt): requested targets, and with ``cascade`` what follows from a refined date: gold of it and of the
    next day. Each target once, at its first place. ``requests`` has pos, stage and dt."""
    next_day = F.date_format(F.date_add(F.col("dt").cast("date"), 1), "yyyy-MM-dd")
    one = F.array(F.struct("stage", "dt"))
    both = F.array(F.struct("stage", "dt"), F.struct(F.lit("gold").alias("stage"), "dt"), F.struct(F.lit("gold").alias("stage"), next_day.alias("dt")))
    targets = F.when((F.col("stage") == "silver") & F.lit(cascade), both).otherwise(one)
    rows = requests.select("pos", F.posexplode(targets).alias("k", "t")).select((F.col("pos") * 10 + F.col("k")).alias("pos"), "t.*")
    return rows.groupBy("stage", "dt").agg(F.min("pos").alias("pos"))


def reprocess_allowed(targets: DataFrame, excluded: DataFrame, force: bool = False) -> DataFrame:
    """Targets without the dates whose marker excludes them, unless forced."""
    return targets if force else targets.join(excluded.select("stage", "dt"), ["stage", "dt"], "left_anti")


def missing_ids(found: DataFrame, column: str = "batch_id") -> DataFrame:
    """Numbers between the first and last that are not there."""
    span = found.agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a is not null")
    return span.select(F.explode(F.sequence("a", "b")).alias(column)).join(found.select(column), column, "left_anti")


def admission(jobs: DataFrame, as_of: Column | int, cooldown_s: int = 120, targets: tuple[str, ...] = ("next_report", "compare_10s", "all")) -> DataFrame:
    """HTTP verdict for each asked target: 400 unknown, 409 a job or pipeline is running, 429 too soon, 202 accepted.

    ``jobs`` has asked, running, dag_running and last_start; a null dag_running (unreachable) doesn't block.
    """
    code = (
        F.when(~F.col("asked").isin(*targets), 400)
        .when(F.col("running") > 0, 409)
        .when(F.col("last_start").isNotNull() & ((F.lit(as_of) if isinstance(as_of, int) else as_of) - F.col("last_start") < cooldown_s), 429)
        .when(F.coalesce("dag_running", F.lit(0)) > 0, 409)
        .otherwise(202)
    )
    return jobs.withColumn("code", code.cast("long"))


def admission_of_records(targets: DataFrame, records: DataFrame, as_of: Column | int, cooldown_s: int = 120) -> DataFrame:
    """``admission`` with its counts taken from job records (target, state, started): running jobs of the target, queued
    ones, and the last start."""
    is_state = lambda s: F.count_if(F.col("state") == s)
    found = records.groupBy(F.col("target").alias("asked")).agg(is_state("running").alias("running"), is_state("queued").alias("dag_running"), F.max("started").alias("last_start"))
    jobs = targets.join(found, "asked", "left").fillna(0, ["running", "dag_running"])
    return admission(jobs, as_of, cooldown_s).withColumnRenamed("dag_running", "queued")
