"""Streaming queries: run to the end over the events files; each has the batch form as SQL where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftglass.catalog.states import GAP, RUN_GAP, duck, states
from driftglass.catalog.telemetry import ORACLES as BATCH
from driftglass.operators import dedup
from driftglass.plans.store import work_folder
from driftglass.sources.streams import file_stream, log_tail_watermark
from driftglass.streaming import native, serving, sinks
from driftglass.streaming.progress import Reporter

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = duck(sql) if "states" in sql and "states AS" not in sql else sql
        return f

    return add


def feed(spark, sf_dir, folder, files: int = 3):
    """The states fixture as a folder of files in snapshot order, and a stream that takes one file a batch."""
    s = states(spark, sf_dir).where("snap_epoch is not null")
    inner = s.approxQuantile("snap_epoch", [k / files for k in range(1, files)], 0.01) if files > 1 else []
    cuts = [float("-inf"), *inner, float("inf")]
    for a, b in zip(cuts, cuts[1:], strict=False):  # one after the other: the source takes files by age
        s.where((F.col("snap_epoch") > a) & (F.col("snap_epoch") <= b)).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    schema = spark.read.parquet(f"{folder}/feed").schema
    return file_stream(spark, f"{folder}/feed", schema, 1)


def collected(stream, folder, mode: str = "append"):
    """Run a stream to the end; all rows it put out, as a table."""
    path = f"{folder}/out"
    q = stream.writeStream.outputMode(mode).foreachBatch(lambda df, k: df.write.mode("overwrite").parquet(f"{path}/batch={k}")).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.parquet(path)


@query("SELECT icao24, event_id, snap_epoch, callsign FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY snap_epoch DESC, event_id) AS rn FROM states WHERE latitude IS NOT NULL) WHERE rn = 1")
def stream_hot(spark, sf_dir):
    """Latest state after all batches of the hot sink; equal to the batch form whatever the file order."""
    folder = work_folder(spark)
    sink = sinks.HotSink(spark, f"{folder}/hot", "snap_epoch", ties=["event_id"])
    sinks.start(feed(spark, sf_dir, folder), sink.write, f"{folder}/checkpoint").awaitTermination()
    return sink.latest().select("icao24", "event_id", "snap_epoch", "callsign")


@query("""WITH v AS (SELECT * FROM states WHERE latitude IS NOT NULL) SELECT count(*) AS n, count(time_position) AS dated FROM (
  SELECT time_position, row_number() OVER (PARTITION BY icao24, time_position ORDER BY snap_epoch, event_id) AS rn FROM v) WHERE rn = 1 OR time_position IS NULL""")
def stream_history(spark, sf_dir):
    """History rows: one per position report, every undated one."""
    folder = work_folder(spark)
    sink = sinks.HotSink(spark, f"{folder}/hot", "snap_epoch", ties=["event_id"])
    sinks.start(feed(spark, sf_dir, folder), sink.write, f"{folder}/checkpoint").awaitTermination()
    return sink.history().agg(F.count("*").alias("n"), F.count("time_position").alias("dated"))


@query(BATCH["cold_by_date"])
def stream_cold(spark, sf_dir):
    folder = work_folder(spark)
    sink = sinks.ColdSink(f"{folder}/cold", "snap_epoch")
    sinks.start(feed(spark, sf_dir, folder), sink.write, f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/cold").groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count("*").alias("n"))


@query("SELECT icao24, event_id, snap_epoch FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY snap_epoch DESC, event_id) AS rn FROM states) WHERE rn = 1")
def stream_latest_state(spark, sf_dir):
    """Keyed state; the last update of each object is its state."""
    folder = work_folder(spark)
    out = collected(native.latest_state(feed(spark, sf_dir, folder)), folder, "update")
    return dedup.last_per(out, ["icao24"], ["batch"]).select("icao24", "event_id", "snap_epoch")


@query(f"""WITH a AS (SELECT DISTINCT icao24, time_position AS t FROM states WHERE on_ground = FALSE AND time_position IS NOT NULL),
  n AS (SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > {GAP} THEN 1 ELSE 0 END AS b FROM a WINDOW w AS (PARTITION BY icao24 ORDER BY t)),
  g AS (SELECT icao24, t, sum(b) OVER (PARTITION BY icao24 ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM n)
  SELECT icao24, min(t) AS seg_start, count(*) AS n_points FROM g GROUP BY icao24, k HAVING max(t) + {GAP} <= (SELECT max(t) FROM a) - 3600""")
def stream_sessions(spark, sf_dir):
    """Closed native sessions of the airborne reports, the last ones of each object are still open."""
    folder = work_folder(spark)
    s = feed(spark, sf_dir, folder).where("on_ground = false and time_position is not null").withColumn("ts", F.timestamp_seconds("time_position"))
    once = native.first_reports(s, "ts", "1 hour", ["icao24", "time_position"])
    closed = once.groupBy("icao24", F.session_window("ts", f"{GAP} seconds").alias("s")).agg(F.count("*").alias("n_points"))
    return collected(closed.select("icao24", F.unix_timestamp("s.start").alias("seg_start"), "n_points"), folder).select("icao24", "seg_start", "n_points")


@query("""WITH t AS (SELECT CAST(floor(snap_epoch / 86400.0) AS BIGINT) * 86400 AS window_start, count(*) AS n FROM states GROUP BY 1) SELECT * FROM t WHERE window_start + 86400 <= (SELECT max(snap_epoch) FROM states) - 3600""")
def stream_tumbling(spark, sf_dir):
    """Closed one-day windows: those the watermark has passed."""
    folder = work_folder(spark)
    s = feed(spark, sf_dir, folder).withColumn("ts", F.timestamp_seconds("snap_epoch"))
    return collected(native.tumbling(s, "ts", "1 day", "1 hour", F.count("*").alias("n")), folder).select("window_start", "n")


@query("""SELECT source, snapshot, CASE WHEN before IS NULL OR snapshot > before THEN 'send' WHEN snapshot = before THEN 'repeat' ELSE 'older' END AS decision FROM (
  SELECT source, snapshot, max(snapshot) OVER (PARTITION BY source ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (
  SELECT 's' || CAST(user_id % 5 AS VARCHAR) AS source, event_id AS seq, CAST(floor(epoch(ts)) AS BIGINT) // 36000 - event_id % 3 AS snapshot FROM events))""")
def stream_watermark_decision(spark, sf_dir):
    folder = work_folder(spark)
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = e.select(F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("source"), F.col("event_id").alias("seq"), (F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 36000) - F.col("event_id") % 3).cast("long").alias("snapshot"))
    rows.coalesce(1).sortWithinPartitions("seq").write.parquet(f"{folder}/polls")
    return collected(native.decisions(file_stream(spark, f"{folder}/polls", rows.schema)), folder).select("source", "snapshot", "decision")


@query(BATCH["cold_by_date"])
def stream_drain(spark, sf_dir):
    """A cold query is stopped and drained on its checkpoint: nothing is lost or doubled."""
    folder = work_folder(spark)
    source = feed(spark, sf_dir, folder)
    sink = sinks.ColdSink(f"{folder}/cold", "snap_epoch")
    q = sinks.start(source, sink.write, f"{folder}/checkpoint", "0 seconds")
    while not q.recentProgress and q.isActive:
        q.awaitTermination(0.2)
    sinks.drain([q], lambda: sinks.start(source, sink.write, f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/cold").groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count("*").alias("n"))


@query("SELECT CAST(3 AS BIGINT) AS batches, count(*) AS n_rows, CAST(0 AS BIGINT) AS skipped FROM states WHERE snap_epoch IS NOT NULL")
def stream_progress(spark, sf_dir):
    """Rows and batches by the progress listener."""
    folder, reporter = work_folder(spark), Reporter()
    spark.streams.addListener(reporter)
    try:
        sinks.start(feed(spark, sf_dir, folder), lambda df, k: df.write.mode("overwrite").parquet(f"{folder}/cold/batch={k}"), f"{folder}/checkpoint").awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(reporter)
    return reporter.table(spark).agg(F.count("*").alias("batches"), F.sum("rows").alias("n_rows"), F.sum("skipped").alias("skipped"))


@query("SELECT least(max(snap_epoch), 1705000000) AS watermark FROM states")
def log_watermark(spark, sf_dir):
    return spark.createDataFrame([(log_tail_watermark(states(spark, sf_dir), 1_705_000_000, "snap_epoch"),)], "watermark long")


@query()
def serving_windows(spark, sf_dir):
    """The serving loop over the feed's times, a cycle a day of it, with dead reckoning as the model: what each
    closed window scored. Constants are scaled like the fixture's."""
    folder, s = work_folder(spark), states(spark, sf_dir).where("snap_no = 0 and time_position is not null")
    t0, t1 = s.agg(F.min("time_position"), F.max("time_position")).first()
    loop = serving.Serving(spark, f"{folder}/serving", lambda: (1, serving.dead_reckoning_predictor), step=3600, giveup_s=86_400, fresh_s=86_400, context_s=3600, gap=RUN_GAP, window_s=172_800, lookback_s=604_800)
    for now in range(int(t0) + 86_400, min(int(t1), int(t0) + 7 * 86_400), 86_400):
        loop.cycle(s.where(F.col("time_position") <= now), now)
    return loop.windows().select("window_start", "predictions", "scored", "unscorable", "model_p50_m", "baseline_p50_m")
