"""Queries over gold tables, planning, lake maintenance and models."""

from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from driftglass.catalog.states import GAP, duck, states, with_clock
from driftglass.catalog.telemetry import _HOUR, _PSI, AS_OF, latest, longs, positions, rounded, traj
from driftglass.functions import text
from driftglass.operators import aggregates, evaluate, live, samples, segments
from driftglass.plans import adhoc, lake, medallion, model, planner, reports
from driftglass.plans.store import Store, work_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = duck(sql) if "states" in sql or "pos" in sql or "traj" in sql else sql
        return f

    return add


# --- ad hoc ----------------------------------------------------------------------------------------------------------

_DAY = "CAST(CAST(to_timestamp(snap_epoch) AT TIME ZONE 'UTC' AS DATE) AS VARCHAR)"
_HOURLY = f"hourly AS (SELECT {_DAY} AS event_date, snap_epoch // 86400 AS d, {_HOUR} AS hour_utc, origin_country, count(DISTINCT icao24) AS aircraft_count, count(*) AS obs_count FROM pos GROUP BY ALL)"


def hourly(spark, sf_dir):
    p = with_clock(positions(spark, sf_dir))
    grouped = p.groupBy(F.to_date("timestamp").alias("event_date"), F.hour("timestamp").alias("hour_utc"), "origin_country")
    return grouped.agg(F.countDistinct("icao24").alias("aircraft_count"), F.count("*").alias("obs_count"))


@query(f"WITH {_HOURLY} SELECT event_date, hour_utc, origin_country, aircraft_count, obs_count FROM hourly ORDER BY aircraft_count DESC, event_date, hour_utc, origin_country LIMIT 10")
def top_traffic(spark, sf_dir):
    return longs(adhoc.top_traffic(hourly(spark, sf_dir)), "hour_utc").withColumn("event_date", F.col("event_date").cast("string"))


_LOCAL = f"WITH {_HOURLY}, per AS (SELECT d * 24 + hour_utc + 9 AS h, sum(aircraft_count) AS a FROM hourly GROUP BY 1) SELECT CAST(h % 24 AS BIGINT) AS hour_local, count(*) AS days, round(avg(a), 1) AS avg_aircraft FROM per GROUP BY 1"


@query(_LOCAL)
def local_hour_avg(spark, sf_dir):
    return longs(adhoc.local_hours(hourly(spark, sf_dir)), "hour_local")


@query(_LOCAL + " ORDER BY avg_aircraft DESC, hour_local LIMIT 10")
def top_hours(spark, sf_dir):
    return longs(adhoc.top_hours(hourly(spark, sf_dir)), "hour_local")


@query("SELECT icao24, round(sum(dist_m), 3) AS distance_m, round(sum(dist_m) / 1000, 1) AS distance_km FROM traj GROUP BY 1 HAVING sum(dist_m) IS NOT NULL ORDER BY sum(dist_m) DESC, icao24 LIMIT 10")
def top_entities(spark, sf_dir):
    rows = traj(spark, sf_dir).groupBy("icao24").agg(F.sum("dist_m").alias("distance_m")).where("distance_m is not null")
    return rounded(adhoc.top_distance(rows), 3, "distance_m")


@query(f"""SELECT CASE WHEN baro_altitude < 3000 THEN '1) <3,000m' WHEN baro_altitude < 9000 THEN '2) 3,000-9,000m' ELSE '3) >=9,000m' END AS altitude_band, count(*) AS points,
  round(median(calc_speed_mps), 1) AS calc_speed_p50, round(median(velocity), 1) AS reported_speed_p50 FROM traj WHERE dt_s IS NOT NULL AND dt_s <= {GAP} AND baro_altitude IS NOT NULL GROUP BY 1""")
def band_medians(spark, sf_dir):
    return adhoc.band_speeds(traj(spark, sf_dir), GAP)


@query(f"SELECT CAST(sum(n) AS BIGINT) AS n_rows, string_agg(d, ',' ORDER BY d) AS event_dates FROM (SELECT {_DAY} AS d, count(*) AS n FROM states GROUP BY 1)")
def date_list(spark, sf_dir):
    return adhoc.date_list(with_clock(states(spark, sf_dir)).withColumn("event_date", F.to_date("timestamp")))


_MED = "SELECT icao24, median(velocity) AS velocity, median(baro_altitude) AS baro_altitude FROM pos WHERE event_id % 2 = {} GROUP BY 1"


def _psi_of(feature: str) -> str:
    body = _PSI + " FROM j"
    return f"(WITH ref AS (SELECT {feature} AS v FROM r0 WHERE {feature} IS NOT NULL), live AS (SELECT {feature} AS v FROM l0 WHERE {feature} IS NOT NULL), {body})"


@query(f"""WITH r0 AS ({_MED.format(0)}), l0 AS ({_MED.format(1)}), s AS (SELECT (SELECT count(DISTINCT icao24) FROM l0) AS aircraft, {_psi_of('velocity')} AS psi_velocity, {_psi_of('baro_altitude')} AS psi_baro_altitude)
  SELECT *, CASE WHEN aircraft < 100 OR greatest(coalesce(psi_velocity, -1), coalesce(psi_baro_altitude, -1)) < 0 THEN 'insufficient' WHEN greatest(coalesce(psi_velocity, -1), coalesce(psi_baro_altitude, -1)) >= 0.25 THEN 'shifted' ELSE 'stable' END AS status FROM s""")
def drift_verdict(spark, sf_dir):
    p = positions(spark, sf_dir)
    med = lambda part: evaluate.per_object_median(p.where(part), ["icao24"], ["velocity", "baro_altitude"])
    return evaluate.drift_verdict(med("event_id % 2 = 0"), med("event_id % 2 = 1"), ["velocity", "baro_altitude"], least_objects=100)


_MADE = """SELECT icao24, snap_epoch AS ti, CASE event_id % 7 WHEN 0 THEN 'giveup' WHEN 1 THEN 'keep' ELSE 'scored' END AS state, abs(velocity) AS err_model, abs(velocity) + CAST(event_id % 190 AS DOUBLE) AS err_dr, CAST(1 + event_id % 211 AS DOUBLE) AS moved, velocity, baro_altitude FROM states"""


def _made(spark, sf_dir):
    """Predictions as the serving loop leaves them, derived from the reports."""
    s, k = states(spark, sf_dir), F.col("event_id")
    state = F.when(k % 7 == 0, "giveup").when(k % 7 == 1, "keep").otherwise("scored")
    return s.select("icao24", F.col("snap_epoch").alias("ti"), state.alias("state"), F.abs("velocity").alias("err_model"), (F.abs("velocity") + (k % 190).cast("double")).alias("err_dr"), (1 + k % 211).cast("double").alias("moved"), "velocity", "baro_altitude")


def _sides(side: str, err: str) -> str:
    hits = ", ".join(f"round(avg(CASE WHEN {err} <= {t} THEN 1.0 ELSE 0.0 END) * 100, 1) AS {side}_hit_{t}m_pct" for t in evaluate.THRESHOLDS_M)
    return f"round(avg({err}), 1) AS {side}_mean_m, round(quantile_cont({err}, 0.5), 1) AS {side}_p50_m, round(quantile_cont({err}, 0.9), 1) AS {side}_p90_m, {hits}, round((1 - quantile_cont({err} / moved, 0.5)) * 100, 1) AS {side}_relative_accuracy_pct"


@query(f"""WITH m AS (SELECT *, ti // 86400 * 86400 AS window_start FROM ({_MADE})),
  a AS (SELECT window_start, count(*) AS predictions, count(*) FILTER (state = 'scored') AS scored, count(*) FILTER (state = 'giveup') AS unscorable FROM m GROUP BY 1),
  e AS (SELECT window_start, {_sides('model', 'err_model')}, {_sides('baseline', 'err_dr')} FROM m WHERE state = 'scored' GROUP BY 1)
  SELECT * FROM a LEFT JOIN e USING (window_start)""")
def window_close(spark, sf_dir):
    """Closed windows: counts and the error summaries of the model and of dead reckoning."""
    return evaluate.close_windows(_made(spark, sf_dir), "ti", 86_400)


@query(f"""SELECT (ti // 86400 + 1) * 86400 AS window_end, icao24, median(velocity) AS velocity, median(baro_altitude) AS baro_altitude FROM ({_MADE}) GROUP BY 1, 2""")
def window_object_medians(spark, sf_dir):
    return evaluate.window_medians(_made(spark, sf_dir), "ti", 86_400, ["velocity", "baro_altitude"])


_ROLL_END = 1_704_844_800
_ROLL = f"SELECT icao24, median(velocity) AS velocity, median(baro_altitude) AS baro_altitude FROM (SELECT (ti // 86400 + 1) * 86400 AS window_end, icao24, median(velocity) AS velocity, median(baro_altitude) AS baro_altitude FROM ({_MADE}) GROUP BY 1, 2) WHERE window_end <= {_ROLL_END} AND {_ROLL_END} - window_end <= 432000 GROUP BY 1"


@query(f"""WITH r0 AS ({_MED.format(0)}), l0 AS ({_ROLL}), s AS (SELECT (SELECT count(DISTINCT icao24) FROM l0) AS aircraft, {_psi_of('velocity')} AS psi_velocity, {_psi_of('baro_altitude')} AS psi_baro_altitude)
  SELECT *, CASE WHEN aircraft < 100 OR greatest(coalesce(psi_velocity, -1), coalesce(psi_baro_altitude, -1)) < 0 THEN 'insufficient' WHEN greatest(coalesce(psi_velocity, -1), coalesce(psi_baro_altitude, -1)) >= 0.25 THEN 'shifted' ELSE 'stable' END AS status FROM s""")
def rolling_drift(spark, sf_dir):
    """The verdict over the closed windows of a rolling span."""
    reference = evaluate.per_object_median(positions(spark, sf_dir).where("event_id % 2 = 0"), ["icao24"], ["velocity", "baro_altitude"])
    windows = evaluate.window_medians(_made(spark, sf_dir), "ti", 86_400, ["velocity", "baro_altitude"])
    return evaluate.rolling_drift(reference, windows, ["velocity", "baro_altitude"], F.lit(_ROLL_END), 432_000, least_objects=100)


@query("SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt FROM orders ORDER BY 1")
def sorted_dates(spark, sf_dir):
    """Every distinct date, in order."""
    return adhoc.sorted_dates(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")


# --- planning --------------------------------------------------------------------------------------------------------

_DATES = """b AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, CAST(day(ts) AS BIGINT) AS n FROM events), s AS (SELECT * FROM b WHERE n % 4 <> 0), g AS (SELECT * FROM b WHERE n % 3 = 0)"""
TODAY = "2024-01-28"


def _dates(spark, sf_dir):
    b = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.to_date("ts").cast("string").alias("dt"), F.dayofmonth("ts").alias("n")).distinct()
    return b.select("dt"), b.where("n % 4 != 0").select("dt"), b.where("n % 3 = 0").select("dt")


@query(f"WITH {_DATES} SELECT dt FROM b WHERE dt NOT IN (SELECT dt FROM s) AND dt < '{TODAY}'")
def pending_dates(spark, sf_dir):
    b, s, _ = _dates(spark, sf_dir)
    return planner.pending(b, s, TODAY)


@query(f"""WITH {_DATES}, p AS (SELECT dt, CAST(CAST(dt AS DATE) - INTERVAL 1 DAY AS DATE)::VARCHAR AS prev FROM b WHERE dt NOT IN (SELECT dt FROM g) AND dt < '{TODAY}')
  SELECT dt, CASE WHEN dt NOT IN (SELECT dt FROM s) THEN 'held: not refined' WHEN prev IN (SELECT dt FROM b) AND prev NOT IN (SELECT dt FROM s) THEN 'held: day before not refined' ELSE 'ready' END AS status FROM p""")
def gold_eligible(spark, sf_dir):
    return planner.gold_plan(*_dates(spark, sf_dir), TODAY)


@query(f"WITH {_DATES} SELECT dt FROM s WHERE dt NOT IN (SELECT dt FROM g) AND dt < '{TODAY}'")
def merge_pending(spark, sf_dir):
    b, s, g = _dates(spark, sf_dir)
    return planner.merge_pending(b, s, g, TODAY)


@query(f"WITH {_DATES}, n AS (SELECT dt, (row_number() OVER (ORDER BY dt) - 1) // 10 AS chunk FROM b) SELECT chunk, string_agg(dt, ',' ORDER BY dt) AS dates FROM n GROUP BY 1")
def chunked_dates(spark, sf_dir):
    return longs(planner.chunks(_dates(spark, sf_dir)[0]), "chunk")


@query(f"""WITH {_DATES}, r AS (SELECT n AS pos, CASE WHEN n % 2 = 0 THEN 'silver' ELSE 'gold' END AS stage, dt FROM b WHERE n % 5 < 2),
  t AS (SELECT pos * 10 AS pos, stage, dt FROM r UNION ALL SELECT pos * 10 + 1, 'gold', dt FROM r WHERE stage = 'silver' UNION ALL SELECT pos * 10 + 2, 'gold', CAST(CAST(dt AS DATE) + INTERVAL 1 DAY AS DATE)::VARCHAR FROM r WHERE stage = 'silver')
  SELECT stage, dt, min(pos) AS pos FROM t GROUP BY 1, 2""")
def reprocess_plan(spark, sf_dir):
    b = _dates(spark, sf_dir)[0].withColumn("pos", F.dayofmonth(F.col("dt").cast("date")).cast("long")).where("pos % 5 < 2")
    return planner.reprocess(b.withColumn("stage", F.when(F.col("pos") % 2 == 0, "silver").otherwise("gold")))


_ASKED = "r AS (SELECT n AS pos, CASE WHEN n % 2 = 0 THEN 'silver' ELSE 'gold' END AS stage, dt FROM b WHERE n % 5 < 2)"


@query(f"WITH {_DATES}, {_ASKED} SELECT stage, dt, pos FROM r WHERE NOT (stage = 'gold' AND dt IN (SELECT dt FROM b WHERE n % 3 = 0))")
def reprocess_allowed(spark, sf_dir):
    """Targets without the dates whose marker excludes them."""
    dates, _, g = _dates(spark, sf_dir)
    b = dates.withColumn("pos", F.dayofmonth(F.col("dt").cast("date")).cast("long")).where("pos % 5 < 2")
    asked = b.withColumn("stage", F.when(F.col("pos") % 2 == 0, "silver").otherwise("gold"))
    return planner.reprocess_allowed(asked, g.withColumn("stage", F.lit("gold"))).select("stage", "dt", "pos")


@query("WITH f AS (SELECT DISTINCT event_id AS batch_id FROM events WHERE event_id % 7 <> 3), r AS (SELECT unnest(range((SELECT min(batch_id) FROM f), (SELECT max(batch_id) FROM f) + 1)) AS batch_id) SELECT batch_id FROM r WHERE batch_id NOT IN (SELECT batch_id FROM f)")
def missing_batches(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 7 != 3")
    return planner.missing_ids(e.select(F.col("event_id").alias("batch_id")))


_TARGETS = "VALUES ('all'), ('nope'), ('next_report'), ('compare_10s'), ('idle')"
_RECORDS = "SELECT CASE user_id % 3 WHEN 0 THEN 'all' WHEN 1 THEN 'next_report' ELSE 'compare_10s' END AS target, CASE WHEN event_type = 'error' AND event_id % 50 = 0 AND user_id % 3 = 0 THEN 'running' WHEN event_type = 'view' AND event_id % 40 = 1 AND user_id % 3 = 1 THEN 'queued' ELSE 'done' END AS state, event_id AS started FROM events"


@query(f"""WITH t AS (SELECT * FROM ({_TARGETS}) AS t(asked)), r AS (SELECT target AS asked, count(*) FILTER (state = 'running') AS running, count(*) FILTER (state = 'queued') AS queued, max(started) AS last_start FROM ({_RECORDS}) GROUP BY 1),
  j AS (SELECT asked, coalesce(running, 0) AS running, coalesce(queued, 0) AS queued, last_start FROM t LEFT JOIN r USING (asked))
  SELECT asked, running, queued, last_start, CAST(CASE WHEN asked NOT IN ('next_report', 'compare_10s', 'all') THEN 400 WHEN running > 0 THEN 409 WHEN last_start IS NOT NULL AND (SELECT max(event_id) FROM events) + 5 - last_start < 6 THEN 429 WHEN queued > 0 THEN 409 ELSE 202 END AS BIGINT) AS code FROM j""")
def job_admission(spark, sf_dir):
    """Verdicts from the job records: what is running or queued is counted."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    targets = spark.sql(f"SELECT * FROM ({_TARGETS}) AS t(asked)")
    as_of = events.agg((F.max("event_id") + 5).alias("t")).scalar()
    return planner.admission_of_records(targets, spark.sql(_RECORDS.replace("FROM events", "FROM {events}"), events=events), as_of, 6)


@query("""SELECT id, CAST(epoch(strptime(substr(id, 1, 16), '%Y%m%dT%H%M%SZ')) AS BIGINT) AS started FROM (SELECT strftime(ts, '%Y%m%dT%H%M%SZ') || '-' || CAST(event_id AS VARCHAR) AS id FROM events)""")
def run_id_time(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ids = e.select(F.concat(F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), F.lit("-"), F.col("event_id").cast("string")).alias("id"))
    return ids.select("id", F.unix_timestamp(text.run_time(F.col("id"))).alias("started"))


_KINDS = "CASE event_type WHEN 'click' THEN 'HTTPError' WHEN 'view' THEN 'JSONDecodeError' WHEN 'signup' THEN 'Timeout' WHEN 'error' THEN 'KafkaTimeoutError' ELSE 'KeyError' END"


@query(f"SELECT kind, count(*) AS n FROM (SELECT CASE WHEN x = 'HTTPError' THEN 'http' WHEN x IN ('ValueError', 'JSONDecodeError') THEN 'parse' WHEN x IN ('ConnectionError', 'Timeout', 'RequestException') THEN 'network' WHEN x LIKE 'Kafka%' THEN 'kafka' ELSE 'other' END AS kind FROM (SELECT {_KINDS} AS x FROM events)) GROUP BY 1")
def error_class(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.expr(_KINDS).alias("x"))
    return e.groupBy(text.error_class(F.col("x")).alias("kind")).agg(F.count("*").alias("n"))


_BODY = "CASE event_id % 4 WHEN 0 THEN 'status=EXCLUDED (by hand)' WHEN 1 THEN 'rows=1{n}code_version=abc' WHEN 2 THEN 'rows=1{n}code_version=old' ELSE 'rows=1' END"


@query(f"SELECT dt, CASE dt % 4 WHEN 0 THEN 'excluded' WHEN 3 THEN 'unknown' ELSE 'older' END AS reason FROM (SELECT event_id AS dt FROM events) WHERE dt % 4 <> 1")
def stale_markers(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return lake.stale(e.select(F.col("event_id").alias("dt"), F.expr(_BODY.replace("{n}", "\\n")).alias("body")), "abc")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS kst FROM events")
def time_formats(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select("event_id", text.iso_utc(F.col("ts")).alias("iso"), text.local_time(F.col("ts")).alias("kst"))


@query("SELECT count(*) AS n, max(snap_epoch) - min(snap_epoch) AS span_s, 1707000000 - max(snap_epoch) < 60 AS healthy, count(*) FILTER (callsign IN ('N/A')) > 0 AS busy FROM states")
def heartbeat(spark, sf_dir):
    return aggregates.heartbeat(states(spark, sf_dir), F.lit(1_707_000_000), F.col("callsign") == "N/A", "snap_epoch")


@query("SELECT r.run_id, r.version, m.n AS metric_n, g.promoted FROM (SELECT DISTINCT user_id AS run_id, user_id % 4 AS version FROM events) r LEFT JOIN (SELECT user_id AS run_id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1) m USING (run_id) LEFT JOIN (SELECT user_id AS run_id, max(value) > 150 AS promoted FROM events WHERE event_type = 'error' GROUP BY 1) g USING (run_id)")
def run_registry(spark, sf_dir):
    """Runs with version, metrics and gate by run id."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    runs = e.select(F.col("user_id").alias("run_id"), (F.col("user_id") % 4).alias("version")).distinct()
    metrics = e.where("event_type = 'view'").groupBy(F.col("user_id").alias("run_id")).agg(F.count("*").alias("metric_n"))
    gates = e.where("event_type = 'error'").groupBy(F.col("user_id").alias("run_id")).agg((F.max("value") > 150).alias("promoted"))
    return runs.join(metrics, "run_id", "left").join(gates, "run_id", "left").select("run_id", "version", "metric_n", "promoted")


# --- lake maintenance ------------------------------------------------------------------------------------------------


def _bronze(spark, sf_dir, folder, parts: int = 3):
    """Bronze rows of all dates, as several small files each."""
    s = with_clock(states(spark, sf_dir)).withColumns({
        "ingested_at": F.col("timestamp"), "squawk": F.lit(None).cast("string"), "geo_altitude": F.col("baro_altitude"), "dt": F.date_format(F.timestamp_seconds("snap_epoch"), "yyyy-MM-dd"),
    })
    for k in range(parts):
        s.where(F.pmod("event_id", F.lit(parts)) == k).repartition("dt").write.mode("append").partitionBy("dt").parquet(f"{folder}/bronze")
    return f"{folder}/bronze"


_PER_DAY = f"SELECT {_DAY} AS dt, count(*) AS n_rows, count(DISTINCT event_id % 3) AS files FROM states GROUP BY 1"


@query(f"SELECT dt, CASE WHEN files > 1 THEN 'merged' ELSE 'skipped' END AS first, 'skipped' AS again, files AS files_before, CAST(1 AS BIGINT) AS files_after, TRUE AS same, n_rows FROM ({_PER_DAY})")
def compaction_roundtrip(spark, sf_dir):
    """Fingerprint of every date before and after compaction, and what the second call does."""
    folder = work_folder(spark)
    bronze = _bronze(spark, sf_dir, folder)
    rows = []
    for day in sorted(lake.dates_under(spark, bronze)):
        before = aggregates.fingerprint(lake.read_date(spark, bronze, day)).first()
        n = len(lake.data_files(spark, f"{bronze}/dt={day}"))
        first, again = lake.compact(spark, bronze, day, ["icao24", "timestamp"]), lake.compact(spark, bronze, day, ["icao24", "timestamp"])
        after = aggregates.fingerprint(lake.read_date(spark, bronze, day)).first()
        rows.append((day, first, again, n, len(lake.data_files(spark, f"{bronze}/dt={day}")), before == after, before["n_rows"]))
    return spark.createDataFrame(rows, "dt string, first string, again string, files_before long, files_after long, same boolean, n_rows long")


@query(f"SELECT event_date, n, CASE WHEN event_date = '2024-01-05' THEN n ELSE 0 END AS n_extra FROM (SELECT {_DAY} AS event_date, count(*) AS n FROM states GROUP BY 1)")
def partition_overwrite(spark, sf_dir):
    """A partition written twice is there once; a column that came later is null before."""
    path = f"{work_folder(spark)}/table"
    s = with_clock(states(spark, sf_dir)).withColumn("event_date", F.to_date("timestamp")).select("event_id", "snap_no", "velocity", "event_date")
    lake.write_partition(s, path, "event_date")
    one = s.where("event_date = date'2024-01-05'").withColumn("extra", F.lit(1))
    lake.write_partition(one, path, "event_date")
    lake.write_partition(one, path, "event_date")
    return lake.read_table(spark, path).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(F.count("*").alias("n"), F.count("extra").alias("n_extra"))


@query(f"SELECT view, event_date, n FROM (SELECT 'trajectory' AS view, {_DAY} AS event_date, count(*) AS n FROM states GROUP BY 2) WHERE event_date >= '2024-01-10'")
def registered_views(spark, sf_dir):
    """SQL over the registered views, by date; only the asked dates are read."""
    folder = work_folder(spark)
    s = with_clock(states(spark, sf_dir)).withColumn("event_date", F.to_date("timestamp"))
    lake.write_partition(s, f"{folder}/trajectory", "event_date")
    found = lake.register_views(spark, folder)
    parts = [spark.sql(f"SELECT '{v}' AS view, CAST(event_date AS STRING) AS event_date, count(*) AS n FROM {v} WHERE event_date >= DATE'2024-01-10' GROUP BY event_date") for v in found]
    return parts[0]


@query(f"SELECT dt, CAST(1 AS BIGINT) AS files FROM ({_PER_DAY}) WHERE CAST(substr(dt, 9, 2) AS INT) % 2 = 1")
def late_files(spark, sf_dir):
    """Dates that got a file after their marker: here every odd day of the month gets its rows once more."""
    folder = work_folder(spark)
    bronze = _bronze(spark, sf_dir, folder, 1)
    days = sorted(lake.dates_under(spark, bronze))
    for day in days:
        lake.write_marker(spark, f"{folder}/markers", day, 1, bronze, "v1")
    time.sleep(1.1)  # files have times of whole seconds on some stores
    for day in days:
        if int(day[8:]) % 2:
            lake.read_date(spark, bronze, day).coalesce(1).write.mode("append").parquet(f"{bronze}/dt={day}")
    return lake.late_files(spark, bronze, f"{folder}/markers").groupBy("dt").agg(F.count("*").alias("files"))


_RUN = f"""WITH sil AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {_DAY} AS d, row_number() OVER (PARTITION BY icao24, snap_epoch ORDER BY event_id, snap_no) AS rn FROM states) WHERE rn = 1),
  days AS (SELECT d, count(*) AS silver_rows FROM sil GROUP BY 1),
  own AS (SELECT * FROM (SELECT days.d AS day, sil.*, row_number() OVER (PARTITION BY days.d, icao24, time_position ORDER BY snap_epoch) AS nth
    FROM days JOIN sil ON sil.d = days.d OR sil.d = CAST(CAST(days.d AS DATE) - INTERVAL 1 DAY AS DATE)::VARCHAR WHERE time_position IS NOT NULL) WHERE nth = 1 AND d = day),
  gold AS (SELECT day AS d, count(*) FILTER (on_ground = FALSE) AS trajectory, count(DISTINCT icao24) AS aircraft_daily, count(DISTINCT ({_HOUR}, origin_country)) AS traffic_hourly FROM own GROUP BY 1)
  SELECT d AS dt, 'success' AS silver, silver_rows, 'success' AS gold, coalesce(trajectory, 0) AS trajectory, coalesce(aircraft_daily, 0) AS aircraft_daily, coalesce(traffic_hourly, 0) AS traffic_hourly, TRUE AS marked FROM days LEFT JOIN gold USING (d)"""


@query(_RUN)
def medallion_run(spark, sf_dir):
    """Silver and gold of every date; their counts and markers."""
    folder = work_folder(spark)
    bronze = _bronze(spark, sf_dir, folder, 2)
    days = sorted(lake.dates_under(spark, bronze))
    silver, _ = medallion.run_batches(lambda d: medallion.silver_dates(spark, bronze, f"{folder}/silver", f"{folder}/m/silver", d, "v1"), lake.date_batches(spark, bronze, "dt", days))
    gold, _ = medallion.run_batches(lambda d: medallion.gold_dates(spark, f"{folder}/silver", f"{folder}/gold", f"{folder}/m/gold", d, "v1", GAP), lake.date_batches(spark, f"{folder}/silver", "event_date", days))
    done = lake.completed_dates(spark, f"{folder}/m/gold")
    rows = [(d, s["status"], s.get("n_rows"), g["status"], g.get("trajectory"), g.get("aircraft_daily"), g.get("traffic_hourly"), d in done) for d, s, g in zip(days, silver, gold, strict=True)]
    return spark.createDataFrame(rows, "dt string, silver string, silver_rows long, gold string, trajectory long, aircraft_daily long, traffic_hourly long, marked boolean")


@query()
def model_gbt(spark, sf_dir):
    """Errors of the model and of dead reckoning on the held-out segments, and the gate's verdict."""
    flown = traj(spark, sf_dir).withColumn("geo_altitude", F.col("baro_altitude"))
    rows = samples.group_split(samples.next_report(flown, 1, GAP), "segment_id").where("y_north_m is not null and y_east_m is not null")
    models = model.train(rows.where("is_train"), trees=QUERY_TREES)
    return model.judged(models, None, rows.where("not is_train"), 200_000.0)  # the fixture's reports are hours apart


#: Boosting rounds of the registered query; ``model.train`` has 300. README has the time and error of either.
QUERY_TREES = 20


@query(f"""WITH h AS (SELECT win, row_number() OVER (ORDER BY win) AS version, hit FROM (SELECT event_id % 10 AS win, round(avg(CASE WHEN abs(velocity) + CAST(event_id % 190 AS DOUBLE) <= 100 THEN 1.0 ELSE 0.0 END) * 100, 1) AS hit FROM states GROUP BY 1)),
  p AS (SELECT version, hit > coalesce(max(hit) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS promoted FROM h)
  SELECT version, promoted, version = (SELECT max(version) FROM p WHERE promoted) AS champion FROM p""")
def champion_registry(spark, sf_dir):
    """Ten candidates in turn, each a window's hit rate: one that beats the champion takes its place."""
    err = F.abs("velocity") + (F.col("event_id") % 190).cast("double")
    rates = evaluate.hit_rate(states(spark, sf_dir).select((F.col("event_id") % 10).alias("win"), err.alias("err")), ["win"], 100).orderBy("win").collect()  # ten rows
    registry = model.Registry(Store(spark), f"{work_folder(spark)}/registry.json")
    best = -1.0
    for r in rates:
        state = registry.record({"hit_100m_pct": r.hit_pct}, r.hit_pct > best, "above champion" if r.hit_pct > best else "not above champion")
        best = max(best, r.hit_pct)
    return spark.createDataFrame([(v["version"], v["promoted"], v["version"] == state["champion"]) for v in state["versions"]], "version long, promoted boolean, champion boolean")


@query(f"""SELECT '{{"count":' || count(*) || ',"flights":[' || string_agg('{{"icao24":"' || icao24 || '","callsign":"' || callsign || '","country":"' || origin_country || '","snapshot":' || snap_epoch || '}}', ',' ORDER BY icao24) || ']}}' AS message
  FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY snap_epoch DESC, event_id) AS rn FROM states WHERE snap_epoch <= {AS_OF}) WHERE rn = 1""")
def envelope(spark, sf_dir):
    return live.envelope(latest(spark, sf_dir).withColumn("snapshot", F.col("snap_epoch")), ["icao24", "callsign", "country", "snapshot"])


@query(f"""WITH n AS (SELECT icao24, time_position AS t, CASE WHEN lag(time_position) OVER w IS NULL OR time_position - lag(time_position) OVER w > {GAP} THEN 1 ELSE 0 END AS b FROM pos WINDOW w AS (PARTITION BY icao24 ORDER BY time_position)),
  g AS (SELECT icao24, t, sum(b) OVER (PARTITION BY icao24 ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM n)
  SELECT icao24, min(t) AS seg_start, count(*) AS n_points FROM g GROUP BY icao24, k""")
def aircraft_segments_native(spark, sf_dir):
    """Sessions by the native window over all reports."""
    return segments.session_counts(positions(spark, sf_dir), "icao24", F.timestamp_seconds("time_position"), GAP)


# --- runs and reports ------------------------------------------------------------------------------------------------

_RUNS = """SELECT user_id AS k, min(event_id) AS s, count(*) AS n, max(value) > 150 AS promoted, round(avg(value), 4) AS p50 FROM events GROUP BY 1"""


def _runs(spark, sf_dir):
    """One run record per user of the events, as JSON files, read back.

    Values are added in the order of event_id, whatever the partitions, and the mean is rounded as SQL does: many means
    lie halfway between two roundings, where the last bit decides.
    """
    folder = f"{work_folder(spark)}/runs"
    so_far = Window.partitionBy("user_id").orderBy("event_id", "value").rowsBetween(Window.unboundedPreceding, 0)
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "value").withColumns({"_nth": F.row_number().over(so_far), "_sum": F.sum("value").over(so_far)})
    mean = F.max_by("_sum", "_nth") / F.count("value")
    per = e.groupBy(F.col("user_id").alias("k")).agg(F.min("event_id").alias("s"), F.count("*").alias("n"), (F.max("value") > 150).alias("promoted"), (F.round(mean * 10_000, 0) / 10_000).alias("p50"))
    rows = per.select(
        F.format_string("r%s", F.lpad(F.col("k").cast("string"), 6, "0")).alias("run_id"), F.when(F.col("k") % 2 == 0, "next_report").otherwise("compare_10s").alias("model"), F.col("k").alias("version"),
        F.timestamp_seconds(F.col("s") * 60).alias("started"), F.create_map(F.lit("p50"), F.col("p50"), F.lit("n"), F.col("n").cast("double")).alias("metrics"), "promoted", F.lit("x").alias("reason"),
    )
    rows.write.json(folder)
    return reports.read_runs(spark, folder, lines=True)


@query(f"""WITH r AS ({_RUNS}) SELECT 'r' || lpad(CAST(k AS VARCHAR), 6, '0') AS run_id, CASE k % 2 WHEN 0 THEN 'next_report' ELSE 'compare_10s' END AS model, k AS version, p50 AS value, row_number() OVER (ORDER BY p50, s, k) AS place FROM r""")
def ranked_runs(spark, sf_dir):
    """Runs from best to worst by a metric, ties by start."""
    return reports.ranked(_runs(spark, sf_dir), "p50").select("run_id", "model", "version", "value", F.col("place").cast("long").alias("place"))


@query(f"""WITH r AS ({_RUNS}), c AS (SELECT k % 2 AS m, max(k) AS champion FROM r WHERE promoted GROUP BY 1)
  SELECT 'r' || lpad(CAST(k AS VARCHAR), 6, '0') AS run_id, s * 60 AS started, k IS NOT DISTINCT FROM champion AS is_champion, promoted, p50, nth FROM (SELECT r.*, champion, row_number() OVER (ORDER BY s, k) AS nth FROM r LEFT JOIN c ON c.m = k % 2) WHERE nth <= 500""")
def exported_report(spark, sf_dir):
    """The report's text, parsed again: the first 500 runs (its length is its feature) with their champions."""
    runs = _runs(spark, sf_dir)
    champion = runs.where("promoted").groupBy("model").agg(F.max("version").alias("champion"))
    text_of = reports.export_report(runs, champion)
    one = "struct<runs: array<struct<run_id: string, started: timestamp, is_champion: boolean, promoted: boolean, metrics: map<string, double>>>>"
    parsed = text_of.select(F.posexplode(F.from_json("report", one).getField("runs")).alias("nth", "r"))
    return parsed.select("r.run_id", F.unix_timestamp("r.started").alias("started"), "r.is_champion", "r.promoted", F.col("r.metrics")["p50"].alias("p50"), (F.col("nth") + 1).cast("long").alias("nth"))


@query("SELECT event_id, string_agg(line, chr(10) ORDER BY k) AS tail FROM (SELECT event_id, k, line, row_number() OVER (PARTITION BY event_id ORDER BY k DESC) AS back FROM (SELECT event_id, k, CASE k % 3 WHEN 0 THEN 'ML_STEP ' || k WHEN 1 THEN 'noise' ELSE 'ValueError: ' || user_id END AS line FROM events, (SELECT unnest(range(0, 20)) AS k)) WHERE line <> 'noise') WHERE back <= 8 GROUP BY 1")
def log_tails(spark, sf_dir):
    """The last eight notable lines of every log."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    lines = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.when(k % 3 == 0, F.concat(F.lit("ML_STEP "), k.cast("string"))).when(k % 3 == 1, F.lit("noise")).otherwise(F.concat(F.lit("ValueError: "), F.col("user_id").cast("string"))))
    return e.select("event_id", F.array_join(text.log_tail(F.array_join(lines, "\n")), "\n").alias("tail"))


_DATE_TEXTS = "SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d') || 'x' WHEN 2 THEN '2024-13-01' WHEN 3 THEN '2023-02-29' WHEN 4 THEN '2024-1-5' ELSE '2024-02-29' END AS body FROM events"


@query(f"SELECT event_id, body, CASE event_id % 6 WHEN 0 THEN body WHEN 5 THEN body END AS day FROM ({_DATE_TEXTS})")
def strict_dates(spark, sf_dir):
    """YYYY-MM-DD or nothing."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k, day = F.col("event_id") % 6, F.date_format("ts", "yyyy-MM-dd")
    body = F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("x"))).when(k == 2, "2024-13-01").when(k == 3, "2023-02-29").when(k == 4, "2024-1-5").otherwise("2024-02-29")
    return e.select("event_id", body.alias("body")).withColumn("day", text.date_text(F.col("body")).cast("string"))


@query("SELECT user_id, substr(sha256(string_agg(event_type, chr(0) ORDER BY event_id)), 1, 12) AS version FROM events GROUP BY 1")
def content_versions(spark, sf_dir):
    """Twelve hex digits of a digest over contents in order."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"])
    return e.groupBy("user_id").agg(parts.alias("parts")).select("user_id", text.version_of(F.col("parts")).alias("version"))


@query("SELECT event_id, iso, CAST(floor(epoch(ts)) AS BIGINT) AS at FROM (SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+00:00' ELSE '' END AS iso FROM events)")
def parsed_times(spark, sf_dir):
    """ISO texts with and without an offset; without one they are UTC."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.col("event_id") % 3
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(k == 0, "Z").when(k == 1, "+00:00").otherwise(""))
    return e.select("event_id", iso.alias("iso")).withColumn("at", F.unix_timestamp(text.parsed_time(F.col("iso"))))
