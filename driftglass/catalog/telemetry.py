"""Queries over position reports, each with its SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftglass import schema
from driftglass.catalog.states import GAP, duck, states, with_clock
from driftglass.functions import geo
from driftglass.functions.dimensions import AIRLINES, COUNTRIES, rows_of, with_airline
from driftglass.operators import aggregates, dedup, evaluate, live, merge, samples, segments
from driftglass.plans import model
from driftglass.sources import streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
ORDER = ["snap_epoch", "event_id"]
AS_OF = 1_705_000_000


def query(sql: str | None = None, gap: int = GAP):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = duck(sql, gap) if "states" in sql or "pos" in sql or "traj" in sql else sql
        return f

    return add


def longs(df, *columns):
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


def rounded(df, digits: int, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def flagged(spark, sf_dir):
    return schema.flag_valid(states(spark, sf_dir), "snap_epoch")


def positions(spark, sf_dir):
    return dedup.positions(states(spark, sf_dir), order=ORDER)


def traj(spark, sf_dir):
    return segments.trajectory(positions(spark, sf_dir), GAP)


# --- flags, counts -----------------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no, latitude IS NOT NULL AND longitude IS NOT NULL AND snap_epoch IS NOT NULL AS valid FROM states")
def flag_valid(spark, sf_dir):
    return longs(flagged(spark, sf_dir), "snap_no").select("event_id", "snap_no", F.col("_valid").alias("valid"))


@query("SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no, icao24, latitude, longitude FROM states WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND icao24 IS NOT NULL")
def hot_filter(spark, sf_dir):
    return longs(schema.hot_rows(flagged(spark, sf_dir)), "snap_no").select("event_id", "snap_no", "icao24", "latitude", "longitude")


@query("SELECT CAST(strftime(to_timestamp(snap_epoch) AT TIME ZONE 'UTC', '%Y-%m-%d') AS VARCHAR) AS dt, count(*) AS n FROM states WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1")
def cold_by_date(spark, sf_dir):
    cold = with_clock(schema.cold_rows(flagged(spark, sf_dir)))
    return cold.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("dt")).agg(F.count("*").alias("n"))


_KEYED = "SELECT *, CASE WHEN event_id % 101 = 0 THEN NULL ELSE icao24 END AS k FROM states"


@query(f"""SELECT count(*) AS total, count(*) FILTER (latitude IS NOT NULL) AS valid, count(*) FILTER (k IS NULL AND latitude IS NULL AND snap_epoch IS NULL) AS unparsed,
  count(*) FILTER (k IS NULL) AS no_key, count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS no_coord, count(*) FILTER (snap_epoch IS NULL) AS no_time FROM ({_KEYED})""")
def drop_reasons(spark, sf_dir):
    keyed = flagged(spark, sf_dir).withColumn("icao24", F.when(F.col("event_id") % 101 != 0, F.col("icao24")))
    return aggregates.drop_reasons(keyed, "snap_epoch")


@query(f"SELECT snap_epoch // 86400 AS day, count(*) AS polls, count(*) FILTER (k IS NULL) AS null_keys FROM ({_KEYED}) GROUP BY 1 HAVING count(*) FILTER (k IS NULL) > 0")
def null_key_count(spark, sf_dir):
    keyed = states(spark, sf_dir).withColumn("icao24", F.when(F.col("event_id") % 101 != 0, F.col("icao24")))
    return aggregates.null_keys(keyed, F.floor(F.col("snap_epoch") / 86400).alias("day"))


@query(f"SELECT day, sum(null_keys) OVER (ORDER BY day)::BIGINT AS so_far FROM (SELECT snap_epoch // 86400 AS day, count(*) FILTER (k IS NULL) AS null_keys FROM ({_KEYED}) GROUP BY 1) WHERE null_keys > 0")
def null_key_total(spark, sf_dir):
    """The running total of reports without a key."""
    return aggregates.running_total(null_key_count(spark, sf_dir), "day", "null_keys").select("day", F.col("so_far"))


@query("SELECT event_id, CAST(props::JSON->>'k' AS BIGINT) AS k FROM events")
def parse_props(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


@query("""SELECT event_id, 'a' || CAST(user_id AS VARCHAR) AS icao24, CASE WHEN event_id % 3 = 0 THEN 'N/A' ELSE 'KAL' || CAST(user_id AS VARCHAR) END AS callsign,
  CASE WHEN event_id % 2 = 0 THEN value END AS longitude, CAST(NULL AS DOUBLE) AS latitude FROM events""")
def vector_records(spark, sf_dir):
    """Positional vectors (short ones, blank callsigns) to named records."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    call = F.when(F.col("event_id") % 3 == 0, "  ").otherwise(F.concat(F.lit("KAL"), F.col("user_id").cast("string"), F.lit("  ")))
    head = F.array(F.concat(F.lit("a"), F.col("user_id").cast("string")), call, F.lit("Nowhere"), F.lit("1"), F.lit("2"))
    vector = F.when(F.col("event_id") % 2 == 0, F.concat(head, F.array(F.col("value").cast("string")))).otherwise(head)
    return e.select("event_id", *schema.record_from_vector(vector, F.lit(1), F.lit(2.0))).select("event_id", "icao24", "callsign", "longitude", "latitude")


# --- dedup and merges --------------------------------------------------------------------------------------------


@query("""SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no FROM (SELECT *, row_number() OVER (PARTITION BY icao24, snap_epoch ORDER BY event_id, snap_no) AS rn FROM states) WHERE rn = 1""")
def snapshot_dedup(spark, sf_dir):
    rows = dedup.first_per(states(spark, sf_dir), ["icao24", "snap_epoch"], ["event_id", "snap_no"])
    return longs(rows, "snap_no").select("event_id", "snap_no")


@query("SELECT event_id, icao24, time_position, snap_epoch FROM pos")
def position_dedup(spark, sf_dir):
    return positions(spark, sf_dir).select("event_id", "icao24", "time_position", "snap_epoch")


@query("""SELECT icao24, time_position, velocity, true_track FROM (SELECT DISTINCT ON (icao24, time_position) * FROM states
  WHERE time_position >= 1704500000 AND latitude IS NOT NULL ORDER BY icao24, time_position, snap_epoch, event_id)""")
def distinct_on_entity_time(spark, sf_dir):
    rows = states(spark, sf_dir).where("time_position >= 1704500000 and latitude is not null")
    return dedup.first_per(rows, ["icao24", "time_position"], ORDER).select("icao24", "time_position", "velocity", "true_track")


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def line_dedup(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = dedup.first_per(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return longs(rows, "l_linenumber").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


_LATEST = """SELECT icao24, event_id, snap_epoch, callsign FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY snap_epoch DESC, side, event_id) AS rn FROM ({}) ) WHERE rn = 1"""


@query(_LATEST.format("SELECT *, 0 AS side FROM states"))
def latest_state(spark, sf_dir):
    return dedup.last_per(states(spark, sf_dir), ["icao24"], ["snap_epoch", -F.col("event_id")]).select("icao24", "event_id", "snap_epoch", "callsign")


_STORED = _LATEST.format("SELECT *, 0 AS side FROM states WHERE event_id % 2 = 0").replace("icao24, event_id, snap_epoch, callsign", "* EXCLUDE (rn, side)")


@query(_LATEST.format(f"SELECT *, 0 AS side FROM ({_STORED}) UNION ALL SELECT *, 1 AS side FROM states WHERE event_id % 2 = 1"))
def upsert_merge(spark, sf_dir):
    s = states(spark, sf_dir)
    stored = dedup.last_per(s.where("event_id % 2 = 0"), ["icao24"], ["snap_epoch", -F.col("event_id")])
    return merge.upsert_latest(stored, s.where("event_id % 2 = 1"), version="snap_epoch", ties=["event_id"]).select("icao24", "event_id", "snap_epoch", "callsign")


@query("""WITH stored AS (SELECT DISTINCT icao24, time_position FROM states WHERE snap_no = 0 AND event_id % 2 = 0 AND time_position IS NOT NULL),
  batch AS (SELECT * FROM states WHERE snap_no = 1 OR event_id % 3 = 0),
  dated AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao24, time_position ORDER BY snap_epoch, event_id) AS rn FROM batch WHERE time_position IS NOT NULL) WHERE rn = 1)
  SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no, icao24, time_position FROM dated d WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.icao24 = d.icao24 AND s.time_position = d.time_position)
  UNION ALL SELECT event_id, CAST(snap_no AS BIGINT), icao24, time_position FROM batch WHERE time_position IS NULL""")
def insert_if_absent(spark, sf_dir):
    s = states(spark, sf_dir)
    rows = merge.insert_absent(s.where("snap_no = 0 and event_id % 2 = 0"), s.where("snap_no = 1 or event_id % 3 = 0"), order=ORDER)
    return longs(rows, "snap_no").select("event_id", "snap_no", "icao24", "time_position")


@query(f"SELECT count(*) AS n, min(snap_epoch) AS oldest FROM states WHERE snap_epoch >= {AS_OF} - 86400")
def history_retention(spark, sf_dir):
    return merge.retained(states(spark, sf_dir), "snap_epoch", F.lit(AS_OF), 86400).agg(F.count("*").alias("n"), F.min("snap_epoch").alias("oldest"))


@query("SELECT icao24, event_id, snap_epoch FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY snap_epoch DESC, event_id DESC, snap_no DESC) AS rn FROM states) WHERE rn <= 5")
def keep_last_n(spark, sf_dir):
    return dedup.newest(states(spark, sf_dir), ["icao24"], 5, ["snap_epoch", "event_id", "snap_no"]).select("icao24", "event_id", "snap_epoch")


# --- segments and trajectories -----------------------------------------------------------------------------------


@query("""SELECT icao24, segment_id, CAST(point_idx AS BIGINT) AS point_idx, time_position, dt_s, round(dist_m, 3) AS dist_m, round(calc_speed_mps, 6) AS calc_speed_mps,
  round(heading_change_deg, 6) AS heading_change_deg, round(alt_change_m, 6) AS alt_change_m, round(velocity_change_mps, 6) AS velocity_change_mps,
  next_latitude, next_longitude, next_baro_altitude, next_dt_s, is_outlier FROM traj""")
def trajectory(spark, sf_dir):
    rows = rounded(traj(spark, sf_dir), 6, "calc_speed_mps", "heading_change_deg", "alt_change_m", "velocity_change_mps").withColumn("dist_m", F.round("dist_m", 3))
    return rows.select(
        "icao24", "segment_id", "point_idx", "time_position", "dt_s", "dist_m", "calc_speed_mps", "heading_change_deg", "alt_change_m", "velocity_change_mps",
        "next_latitude", "next_longitude", "next_baro_altitude", "next_dt_s", "is_outlier",
    )


@query("SELECT icao24, seg_start, count(*) AS n_points, max(time_position) AS seg_end FROM traj GROUP BY 1, 2")
def segment_list(spark, sf_dir):
    return traj(spark, sf_dir).groupBy("icao24", "seg_start").agg(F.count("*").alias("n_points"), F.max("time_position").alias("seg_end"))


@query("""SELECT count(*) AS n_rows, count(DISTINCT segment_id) AS segments, min(dt_s) AS min_dt_s, count(*) FILTER (is_outlier) AS outliers,
  count(DISTINCT CASE WHEN seg_start // 86400 < time_position // 86400 THEN segment_id END) AS crossing_midnight FROM traj""")
def segment_crossing(spark, sf_dir):
    late = F.floor(F.col("seg_start") / 86400) < F.floor(F.col("time_position") / 86400)
    return traj(spark, sf_dir).agg(
        F.count("*").alias("n_rows"), F.countDistinct("segment_id").alias("segments"), F.min("dt_s").alias("min_dt_s"), F.count_if("is_outlier").alias("outliers"),
        F.countDistinct(F.when(late, F.col("segment_id"))).alias("crossing_midnight"),
    )


@query("SELECT icao24, seg_start, count(*) AS n_points FROM traj GROUP BY 1, 2")
def session_window_counts(spark, sf_dir):
    air = positions(spark, sf_dir).where("on_ground = false")
    return segments.session_counts(air, "icao24", F.timestamp_seconds("time_position"), GAP)


@query(f"""SELECT icao24, time_position FROM (SELECT *, max(rn) OVER (PARTITION BY icao24) AS last FROM (SELECT *, sum(ns) OVER (PARTITION BY icao24 ORDER BY time_position ROWS UNBOUNDED PRECEDING) AS rn
  FROM (SELECT *, CASE WHEN lag(time_position) OVER w IS NULL OR time_position - lag(time_position) OVER w > {GAP} THEN 1 ELSE 0 END AS ns FROM pos WINDOW w AS (PARTITION BY icao24 ORDER BY time_position)))) WHERE rn = last""")
def last_runs(spark, sf_dir):
    return segments.last_runs(positions(spark, sf_dir), gap=GAP).select("icao24", "time_position")


@query("""SELECT icao24, time_position, event_type FROM (SELECT p.icao24, p.time_position, e.event_type, lag(e.event_type) OVER w AS before, row_number() OVER w AS rn
  FROM pos p JOIN events e ON e.event_id = p.event_id WINDOW w AS (PARTITION BY p.icao24 ORDER BY p.time_position)) WHERE rn = 1 OR before IS DISTINCT FROM event_type""")
def trail_compressed(spark, sf_dir):
    kinds = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    rows = positions(spark, sf_dir).join(kinds, "event_id")
    return dedup.changes_only(rows, ["icao24"], ["time_position"], ["event_type"]).select("icao24", "time_position", "event_type")


# --- daily, hourly, quality --------------------------------------------------------------------------------------


@query("""WITH base AS (SELECT icao24, coalesce(max_by(callsign, CASE WHEN callsign <> 'N/A' THEN time_position END), 'N/A') AS callsign, max_by(origin_country, time_position) AS origin_country,
    min(time_position) AS first_seen, max(time_position) AS last_seen, count(*) AS obs_count, count(*) FILTER (on_ground = FALSE) AS airborne_obs, count(*) FILTER (on_ground = TRUE) AS ground_obs,
    max(baro_altitude) AS max_baro_altitude, round(avg(velocity) FILTER (on_ground = FALSE), 6) AS avg_airborne_velocity FROM pos GROUP BY 1),
  flown AS (SELECT icao24, count(DISTINCT segment_id) AS segment_count, sum(dist_m) AS distance_m FROM traj GROUP BY 1)
  SELECT base.*, coalesce(segment_count, 0) AS segment_count, round(coalesce(distance_m, 0.0), 3) AS distance_m FROM base LEFT JOIN flown USING (icao24)""")
def entity_daily(spark, sf_dir):
    rows = aggregates.daily(positions(spark, sf_dir), traj(spark, sf_dir), F.col("time_position"))
    return rounded(rows, 6, "avg_airborne_velocity").withColumn("distance_m", F.round("distance_m", 3))


_HOUR = "CAST(snap_epoch // 3600 % 24 AS BIGINT)"


@query(f"SELECT {_HOUR} AS hour_utc, origin_country, count(DISTINCT icao24) AS aircraft_count, count(DISTINCT CASE WHEN on_ground = FALSE THEN icao24 END) AS airborne_aircraft, count(*) AS obs_count FROM pos GROUP BY 1, 2")
def traffic_hourly(spark, sf_dir):
    return longs(aggregates.hourly(positions(spark, sf_dir), F.timestamp_seconds("snap_epoch")), "hour_utc")


@query("""SELECT count(*) AS n_rows, count(*) FILTER (snap_epoch // 86400 <> 19732) AS date_mismatch, count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS null_position,
  count(*) FILTER (baro_altitude IS NULL) AS null_baro_altitude, count(*) FILTER (velocity IS NULL) AS null_velocity, count(*) FILTER (abs(latitude) > 90 OR abs(longitude) > 180) AS bad_position,
  count(*) FILTER (baro_altitude < -500 OR baro_altitude > 20000) AS bad_altitude, count(*) FILTER (velocity < 0 OR velocity > 400) AS bad_velocity, count(DISTINCT icao24) AS aircraft FROM states""")
def quality_profile(spark, sf_dir):
    rows = with_clock(states(spark, sf_dir))
    return aggregates.quality_profile(rows, F.date_add(F.lit("1970-01-01").cast("date"), 19732), F.col("timestamp"))


@query(f"SELECT {_HOUR} AS hour_utc, origin_country, count(DISTINCT icao24) AS n, TRUE AS n_close, TRUE AS flying_close, count(*) AS obs_count FROM pos GROUP BY 1, 2")
def hourly_sketch(spark, sf_dir):
    """Exact counts, and whether the sketch's are within five standard errors (or one object) of them."""
    p, at = positions(spark, sf_dir), F.timestamp_seconds("snap_epoch")
    exact, sketch = aggregates.hourly(p, at), aggregates.hourly_approx(p, at, 0.02)
    both = exact.alias("x").join(sketch.alias("s"), ["hour_utc", "origin_country"])
    near = lambda c: F.abs(F.col(f"s.{c}") - F.col(f"x.{c}")) <= F.greatest(F.lit(1.0), 0.1 * F.col(f"x.{c}"))
    out = both.select("hour_utc", "origin_country", F.col("x.aircraft_count").alias("n"), near("aircraft_count").alias("n_close"), near("airborne_aircraft").alias("flying_close"), F.col("s.obs_count").alias("obs_count"))
    return longs(out, "hour_utc")


_PRINT = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in ("callsign", "event_id", "icao24", "on_ground", "origin_country", "snap_epoch", "snap_no", "time_position"))


@query(f"SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5({_PRINT}), 1, 12) AS HUGEINT)) AS VARCHAR) AS hash_sum FROM states")
def fingerprint(spark, sf_dir):
    """The portable digest, over columns that print alike in every engine."""
    whole = states(spark, sf_dir).drop("latitude", "longitude", "baro_altitude", "velocity", "true_track", "vertical_rate")
    return aggregates.fingerprint(whole, digest=aggregates.portable_digest).withColumn("hash_sum", F.col("hash_sum").cast("string"))


# --- live ----------------------------------------------------------------------------------------------------------

_LIVE = f"live AS (SELECT *, baro_altitude AS altitude, origin_country AS country FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY snap_epoch DESC, event_id) AS rn FROM states WHERE snap_epoch <= {AS_OF}) WHERE rn = 1)"


def latest(spark, sf_dir):
    rows = dedup.last_per(states(spark, sf_dir).where(F.col("snap_epoch") <= AS_OF), ["icao24"], ["snap_epoch", -F.col("event_id")])
    return rows.withColumns({"altitude": F.col("baro_altitude"), "country": F.col("origin_country")})


@query(f"WITH {_LIVE} SELECT icao24, snap_epoch, altitude FROM live WHERE snap_epoch >= {AS_OF} - 43200")
def live_window(spark, sf_dir):
    return live.fresh(latest(spark, sf_dir), F.lit(AS_OF), 43200, "snap_epoch").orderBy("icao24").select("icao24", "snap_epoch", "altitude")


@query("""SELECT snap_epoch, event_id, latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY snap_epoch ORDER BY event_id, snap_no) AS rn FROM states
  WHERE icao24 = '000003' AND snap_epoch >= 1706000000 - 60) WHERE rn = 1""")
def trail(spark, sf_dir):
    """minutes below 1 count as 1."""
    return live.trail(states(spark, sf_dir), "000003", F.lit(1_706_000_000), 0, "snap_epoch", ["event_id", "snap_no"]).select("snap_epoch", "event_id", "latitude", "longitude")


@query(f"SELECT max(snap_epoch) AS last_snapshot, greatest(0, {AS_OF} - max(snap_epoch)) AS age_s, CASE WHEN max(snap_epoch) IS NULL THEN 'starting' WHEN greatest(0, {AS_OF} - max(snap_epoch)) <= 120 THEN 'ok' ELSE 'stale' END AS status FROM states")
def health(spark, sf_dir):
    return longs(aggregates.health(states(spark, sf_dir), F.col("snap_epoch"), F.lit(AS_OF)), "age_s")


@query(f"""WITH {_LIVE} SELECT count(*) AS total, round(avg(CASE WHEN coalesce(on_ground, FALSE) = FALSE THEN altitude END), 6) AS avg_altitude, count(*) FILTER (coalesce(on_ground, FALSE)) AS grounded,
  round(avg(coalesce(velocity, 0.0)), 6) AS avg_speed, count(DISTINCT country) AS countries FROM live""")
def fleet_stats(spark, sf_dir):
    return rounded(live.statistics(latest(spark, sf_dir)), 6, "avg_altitude", "avg_speed")


@query(f"WITH {_LIVE} SELECT coalesce(country, 'Unknown') AS country, count(*) AS n FROM live GROUP BY 1")
def country_facets(spark, sf_dir):
    return live.facets(latest(spark, sf_dir))


_AIR = ", ".join("('" + "','".join(v.replace("'", "''") for v in r) + "')" for r in rows_of(AIRLINES))
_CC = ", ".join("('" + "','".join(r) + "')" for r in rows_of(COUNTRIES))
_ENRICH = f"""air(code, airline, ac) AS (VALUES {_AIR}), cc(country, country_code) AS (VALUES {_CC}),
  rich0 AS (SELECT s.*, airline, coalesce(ac, nullif(origin_country, '')) AS res, CASE WHEN ac IS NULL THEN 'registration' ELSE 'airline' END AS country_source
    FROM states s LEFT JOIN air ON code = upper(substr(trim(coalesce(callsign, '')), 1, 3))),
  rich AS (SELECT r.*, country_code FROM rich0 r LEFT JOIN cc ON cc.country = r.res)"""


@query(f"WITH {_ENRICH} SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no, airline, res AS country, country_source, country_code FROM rich")
def enrich_airline(spark, sf_dir):
    return longs(with_airline(states(spark, sf_dir)), "snap_no").select("event_id", "snap_no", "airline", "country", "country_source", "country_code")


@query(f"""WITH {_ENRICH} SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no FROM rich WHERE contains(lower(callsign), 'pac') OR contains(lower(icao24), 'pac') OR contains(lower(res), 'pac')
  OR contains(lower(coalesce(airline, '')), 'pac') OR contains(lower(origin_country), 'pac')""")
def fleet_search(spark, sf_dir):
    rich = with_airline(states(spark, sf_dir))
    return longs(live.search(rich, "  PaC ", ["callsign", "icao24", "country", "airline", "origin_country"]), "snap_no").select("event_id", "snap_no")


@query(f"""WITH {_LIVE} SELECT icao24, altitude FROM live ORDER BY icao24 IN ('000003', '000007') DESC, altitude DESC NULLS LAST, icao24""")
def fleet_sort_pinned(spark, sf_dir):
    return live.ordered(latest(spark, sf_dir), "altitude", ["000003", "000007"]).select("icao24", "altitude")


@query(f"""WITH {_LIVE} SELECT icao24, country, row_number() OVER (ORDER BY icao24 IN ('000002') DESC, country NULLS LAST, callsign NULLS LAST, icao24) AS place FROM live""")
def fleet_sort_country(spark, sf_dir):
    return placed(live.ordered(latest(spark, sf_dir), "country", ["000002"])).select("icao24", "country", "place")


@query(f"""WITH {_LIVE} SELECT icao24, callsign, row_number() OVER (ORDER BY callsign NULLS LAST, icao24) AS place FROM live""")
def fleet_sort_callsign(spark, sf_dir):
    return placed(live.ordered(latest(spark, sf_dir), "callsign")).select("icao24", "callsign", "place")


def placed(df):
    """Rows numbered from 1 in the order they come in: the live set, a row per object."""
    return df.withColumn("_at", F.monotonically_increasing_id()).withColumn("place", F.row_number().over(Window.orderBy("_at")).cast("long"))


@query(f"WITH {_LIVE} SELECT icao24, CASE WHEN event_id % 2 = 0 THEN baro_altitude + 15 ELSE baro_altitude END AS altitude FROM live WHERE snap_epoch >= {AS_OF} - 86400")
def display_altitude(spark, sf_dir):
    """The geometric altitude where a report has one, else the barometric."""
    rows = latest(spark, sf_dir).drop("altitude").withColumn("geo_altitude", F.when(F.col("event_id") % 2 == 0, F.col("baro_altitude") + 15))
    return live.fresh(rows, F.lit(AS_OF), 86400, "snap_epoch").select("icao24", "altitude")


@query("SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no, icao24, callsign, on_ground, snap_epoch FROM states WHERE event_id % 13 <> 5 UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM states WHERE event_id % 13 = 5")
def message_roundtrip(spark, sf_dir):
    """Rows through the message form of a log and back; a damaged message becomes a row of nulls."""
    s = longs(states(spark, sf_dir), "snap_no").select("event_id", "snap_no", "icao24", "callsign", "on_ground", "snap_epoch")
    damaged = F.get_json_object("value", "$.event_id").cast("long") % 13 == 5
    log = streams.to_messages(s).withColumn("value", F.when(damaged, F.lit("{broken")).otherwise(F.col("value")).cast("binary"))
    return streams.from_messages(log, s.schema)


@query("SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no, round(velocity * 2, 6) AS north_m, round(velocity + true_track, 6) AS east_m FROM states WHERE velocity IS NOT NULL")
def table_function(spark, sf_dir):
    """A Python model as a table function over Arrow batches; columns go by name, whatever their order."""
    rows = longs(states(spark, sf_dir), "snap_no").where("velocity is not null").select("event_id", "snap_no", "true_track", "velocity")
    return rounded(model.as_table_function(rows, _Toy(), ["velocity", "true_track"]), 6, "north_m", "east_m").select("event_id", "snap_no", "north_m", "east_m")


class _Toy:
    def predict(self, x):
        return np.column_stack([2 * x["velocity"], x["velocity"] + x["true_track"]])


@query(f"WITH {_LIVE} SELECT icao24 FROM live WHERE coalesce(on_ground, FALSE) = FALSE AND coalesce(country, 'Unknown') = 'NATION_3'")
def airborne_in_country(spark, sf_dir):
    return live.in_country(live.airborne_only(latest(spark, sf_dir)), "NATION_3").select("icao24")


@query(f"""WITH d AS (SELECT DISTINCT snap_epoch AS t FROM states ORDER BY t DESC LIMIT 13), g AS (SELECT CAST(t - lag(t) OVER (ORDER BY t) AS DOUBLE) AS s FROM d),
  n AS (SELECT s, row_number() OVER (ORDER BY s) AS r, count(*) OVER () AS c FROM g WHERE s IS NOT NULL)
  SELECT max(c) AS intervals, CASE WHEN max(c) >= 3 THEN max(s) FILTER (r = c // 2 + 1) ELSE 10.0 END AS update_s FROM n""")
def cadence(spark, sf_dir):
    return live.cadence(states(spark, sf_dir), "snap_epoch")


@query(f"WITH {_LIVE} SELECT icao24, greatest(0, {AS_OF} - snap_epoch) AS since_s, CAST(greatest(0.0, 600.0 - greatest(0, {AS_OF} - snap_epoch)) AS DOUBLE) AS next_s, 600.0 - greatest(0, {AS_OF} - snap_epoch) <= 0 AS due FROM live")
def data_age(spark, sf_dir):
    return longs(live.ages(latest(spark, sf_dir), F.col("snap_epoch"), F.lit(AS_OF), 600.0), "since_s").select("icao24", "since_s", F.col("next_s").cast("double").alias("next_s"), "due")


@query(f"""WITH runs AS (SELECT *, max(rn) OVER (PARTITION BY icao24) AS last FROM (SELECT *, sum(ns) OVER (PARTITION BY icao24 ORDER BY time_position ROWS UNBOUNDED PRECEDING) AS rn FROM (
    SELECT *, CASE WHEN lag(time_position) OVER w IS NULL OR time_position - lag(time_position) OVER w > {GAP} THEN 1 ELSE 0 END AS ns FROM pos WHERE time_position <= {AS_OF} WINDOW w AS (PARTITION BY icao24 ORDER BY time_position)))),
  tail AS (SELECT *, min(time_position) OVER (PARTITION BY icao24) AS t0, max(time_position) OVER (PARTITION BY icao24) AS t1 FROM runs WHERE rn = last)
  SELECT icao24, time_position FROM tail WHERE time_position = t1 AND CAST(substr(icao24, 6, 1) = '0' AS INT) * {AS_OF} < t1 AND {AS_OF} - t1 <= 86400 AND t1 - t0 >= 3600 AND velocity IS NOT NULL AND true_track IS NOT NULL""")
def prediction_eligible(spark, sf_dir):
    p = positions(spark, sf_dir).where(F.col("time_position") <= AS_OF)
    last = p.select("icao24").distinct().withColumn("last_ti", F.when(F.substring("icao24", 6, 1) == "0", F.lit(AS_OF)).otherwise(F.lit(0)))
    return live.eligible(segments.last_runs(p, gap=GAP), last, F.lit(AS_OF), 86400, 3600).select("icao24", "time_position")


# --- movement --------------------------------------------------------------------------------------------------------


@query("""SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no, round(velocity * 10 * cos(radians(true_track)), 6) + 0.0 AS north_m, round(velocity * 10 * sin(radians(true_track)), 6) + 0.0 AS east_m FROM states""")
def dead_reckoning(spark, sf_dir):
    n, e = geo.dead_reckoning(F.col("velocity"), F.col("true_track"), F.lit(10.0))
    return longs(states(spark, sf_dir), "snap_no").select("event_id", "snap_no", (F.round(n, 6) + 0.0).alias("north_m"), (F.round(e, 6) + 0.0).alias("east_m"))


_AGE = "least(30.0, greatest(0.0, CAST(snap_epoch + 20 - coalesce(time_position, snap_epoch) AS DOUBLE)))"


@query(f"""SELECT event_id, CAST(snap_no AS BIGINT) AS snap_no,
  round(CASE WHEN coalesce(on_ground, FALSE) OR velocity IS NULL THEN latitude ELSE latitude + velocity * {_AGE} * cos(radians(true_track)) / 111320.0 END, 6) AS lat,
  round(CASE WHEN coalesce(on_ground, FALSE) OR velocity IS NULL THEN longitude ELSE longitude + velocity * {_AGE} * sin(radians(true_track)) / (111320.0 * cos(radians(latitude))) END, 6) AS lon FROM states""")
def extrapolate_position(spark, sf_dir):
    c = F.col
    lat, lon = geo.extrapolated(c("latitude"), c("longitude"), c("velocity"), c("true_track"), c("on_ground"), c("time_position"), c("snap_epoch"), c("snap_epoch") + 20)
    return longs(states(spark, sf_dir), "snap_no").select("event_id", "snap_no", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query("""SELECT CASE WHEN coalesce(on_ground, FALSE) THEN 'ground' WHEN coalesce(baro_altitude, 0) < 3000 THEN 'low' WHEN coalesce(baro_altitude, 0) < 9000 THEN 'mid' ELSE 'high' END AS band, count(*) AS n FROM states GROUP BY 1""")
def altitude_band(spark, sf_dir):
    return states(spark, sf_dir).groupBy(geo.altitude_band(F.col("baro_altitude"), F.col("on_ground")).alias("band")).agg(F.count("*").alias("n"))


# --- samples and evaluation ------------------------------------------------------------------------------------------


@query("""SELECT segment_id, time_position, round(sin(radians(true_track)), 6) + 0.0 AS track_sin, round(cos(radians(true_track)), 6) + 0.0 AS track_cos, round(velocity * next_dt_s * cos(radians(true_track)), 3) + 0.0 AS dr_north_m,
  round(velocity * next_dt_s * sin(radians(true_track)), 3) + 0.0 AS dr_east_m, round((next_latitude - latitude) * 111320.0, 3) + 0.0 AS y_north_m, round((next_longitude - longitude) * 111320.0 * cos(radians(latitude)), 3) + 0.0 AS y_east_m
  FROM traj WHERE next_latitude IS NOT NULL AND next_longitude IS NOT NULL AND next_dt_s BETWEEN 1 AND 21600 AND velocity IS NOT NULL AND true_track IS NOT NULL""")
def next_report_features(spark, sf_dir):
    rows = samples.next_report(traj(spark, sf_dir), 1, GAP)
    return rounded(rounded(rows, 6, "track_sin", "track_cos"), 3, "dr_north_m", "dr_east_m", "y_north_m", "y_east_m").select(
        "segment_id", "time_position", "track_sin", "track_cos", "dr_north_m", "dr_east_m", "y_north_m", "y_east_m"
    )


_BRACKET = """WITH q AS (SELECT DISTINCT icao24, time_position + 1800 AS asked FROM pos), r AS (SELECT icao24, time_position AS t, velocity AS v FROM pos),
  b AS (SELECT q.icao24, q.asked, max(t) FILTER (t <= asked) AS t0, max_by(v, t) FILTER (t <= asked) AS v0, min(t) FILTER (t >= asked) AS t1, min_by(v, t) FILTER (t >= asked) AS v1 FROM q JOIN r USING (icao24) GROUP BY 1, 2)
  SELECT icao24, asked, round(CASE WHEN v0 IS NULL THEN v1 WHEN v1 IS NULL THEN v0 WHEN t0 = t1 THEN v0 ELSE v0 + (v1 - v0) * CAST(asked - t0 AS DOUBLE) / (t1 - t0) END, 6) AS velocity FROM b"""


@query(_BRACKET)
def interp_bracket(spark, sf_dir):
    p = positions(spark, sf_dir)
    asked = p.select("icao24", (F.col("time_position") + 1800).alias("asked")).distinct()
    return rounded(samples.bracketed(p, asked, ["icao24"], "time_position", ["velocity"], "asked"), 6, "velocity")


_ERRORS = """SELECT 'method_' || CAST(event_id % 3 AS VARCHAR) AS method, abs(velocity) + CAST(event_id % 190 AS DOUBLE) AS err, CAST(event_id % 211 AS DOUBLE) AS actual FROM states"""


def _errors(spark, sf_dir):
    s = states(spark, sf_dir)
    mod = lambda n: (F.col("event_id") % n).cast("double")
    return s.select(F.concat(F.lit("method_"), (F.col("event_id") % 3).cast("string")).alias("method"), (F.abs("velocity") + mod(190)).alias("err"), mod(211).alias("actual"), "event_id")


@query(f"""SELECT method, count(*) AS n, round(avg(err), 1) AS mean_m, round(quantile_cont(err, 0.5), 1) AS p50_m, round(quantile_cont(err, 0.9), 1) AS p90_m,
  round(avg(CASE WHEN err <= 50 THEN 1.0 ELSE 0.0 END) * 100, 1) AS hit_50m_pct, round(avg(CASE WHEN err <= 100 THEN 1.0 ELSE 0.0 END) * 100, 1) AS hit_100m_pct, round(avg(CASE WHEN err <= 200 THEN 1.0 ELSE 0.0 END) * 100, 1) AS hit_200m_pct,
  round((1 - quantile_cont(err / greatest(actual, 1e-9), 0.5)) * 100, 1) AS relative_accuracy_pct FROM ({_ERRORS}) GROUP BY 1""")
def error_summary(spark, sf_dir):
    return evaluate.error_summary(_errors(spark, sf_dir), ["method"])


@query(f"SELECT method, round(avg(CASE WHEN err <= 100 THEN 1.0 ELSE 0.0 END) * 100, 1) AS hit_pct FROM ({_ERRORS}) GROUP BY 1")
def hit_rate(spark, sf_dir):
    return evaluate.hit_rate(_errors(spark, sf_dir), ["method"], 100)


_PSI = """edges AS (SELECT list_distinct(quantile_cont(v, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0])) AS q FROM ref), cut AS (SELECT list_sort(q)[2:len(q) - 1] AS e FROM edges),
  bins AS (SELECT unnest(range(0, len(e) + 1)) AS bin FROM cut),
  r AS (SELECT len(list_filter(e, lambda x: x <= v)) AS bin, count(*) AS n FROM ref, cut GROUP BY 1), l AS (SELECT len(list_filter(e, lambda x: x <= v)) AS bin, count(*) AS n FROM live, cut GROUP BY 1),
  j AS (SELECT greatest(1e-4, coalesce(r.n, 0) / (SELECT CAST(count(*) AS DOUBLE) FROM ref)) AS pr, greatest(1e-4, coalesce(l.n, 0) / (SELECT CAST(count(*) AS DOUBLE) FROM live)) AS pl FROM bins LEFT JOIN r USING (bin) LEFT JOIN l USING (bin))
  SELECT CASE WHEN (SELECT count(*) FROM live) >= 20 THEN round(sum((pl - pr) * ln(pl / pr)), 4) END AS psi"""


@query(f"WITH ref AS (SELECT velocity AS v FROM pos WHERE event_id % 2 = 0 AND velocity IS NOT NULL), live AS (SELECT velocity * 1.1 AS v FROM pos WHERE event_id % 2 = 1 AND velocity IS NOT NULL), {_PSI}, (SELECT count(*) FROM live) AS n_live FROM j")
def psi(spark, sf_dir):
    p = positions(spark, sf_dir)
    return evaluate.psi(p.where("event_id % 2 = 0").select("velocity"), p.where("event_id % 2 = 1").select((F.col("velocity") * F.lit(1.1)).alias("velocity")), "velocity")


@query(f"""WITH rates AS (SELECT method, round(avg(CASE WHEN err <= 100 THEN 1.0 ELSE 0.0 END) * 100, 1) AS h FROM ({_ERRORS}) GROUP BY 1),
  g AS (SELECT (SELECT h FROM rates WHERE method = 'method_0') AS c, (SELECT h FROM rates WHERE method = 'method_1') AS b, (SELECT h FROM rates WHERE method = 'method_2') AS p)
  SELECT c AS candidate, b AS baseline, p AS champion, c > b AND (p IS NULL OR c > p) AS promoted, CASE WHEN NOT c > b THEN 'not above baseline' WHEN p IS NOT NULL AND NOT c > p THEN 'not above champion' WHEN p IS NULL THEN 'first champion' ELSE 'above both' END AS reason FROM g""")
def promotion_gate(spark, sf_dir):
    rates = evaluate.hit_rate(_errors(spark, sf_dir), ["method"], 100)
    of = lambda k: F.max(F.when(F.col("method") == f"method_{k}", F.col("hit_pct")))
    one = rates.agg(of(0).alias("candidate"), of(1).alias("baseline"), of(2).alias("champion"))
    return one.withColumns(evaluate.gate(F.col("candidate"), F.col("baseline"), F.col("champion")))


@query(f"""WITH w AS (SELECT method, CAST(event_id AS BIGINT) % 10 AS win, avg(CASE WHEN err <= 100 THEN 1.0 ELSE 0.0 END) AS rate, count(*) AS n FROM (SELECT event_id, {_ERRORS.removeprefix('SELECT ')}) GROUP BY 1, 2)
  SELECT method, round(sum(rate * n) / sum(n), 6) AS pooled FROM w GROUP BY 1""")
def pooled_hit_rate(spark, sf_dir):
    hit = F.avg(F.when(F.col("err") <= 100, 1.0).otherwise(0.0))
    windows = _errors(spark, sf_dir).groupBy("method", (F.col("event_id") % 10).alias("win")).agg(hit.alias("rate"), F.count("*").alias("n"))
    return rounded(evaluate.pooled(windows, ["method"], "rate", "n"), 6, "pooled")


@query(f"""WITH s AS (SELECT method, round(avg(err), 1) AS mean_m, round(quantile_cont(err, 0.9), 1) AS p90_m FROM ({_ERRORS}) GROUP BY 1)
  SELECT method || '/mean_m' AS name, mean_m AS value FROM s UNION ALL SELECT method || '/p90_m', p90_m FROM s""")
def metric_rows(spark, sf_dir):
    return evaluate.metric_rows(evaluate.error_summary(_errors(spark, sf_dir), ["method"]), "method", ["mean_m", "p90_m"])


@query(f"""WITH s AS (SELECT method, round(avg(CASE WHEN err <= 50 THEN 1.0 ELSE 0.0 END) * 100, 1) AS h, round(quantile_cont(err, 0.5), 1) AS p FROM ({_ERRORS}) GROUP BY 1)
  SELECT method, h = max(h) OVER () AS best_hit, p = min(p) OVER () AS best_p50, round(((SELECT p FROM s WHERE method = 'method_0') - p) * 100 / (SELECT p FROM s WHERE method = 'method_0'), 6) AS improvement_pct FROM s""")
def best_metric_flags(spark, sf_dir):
    s = evaluate.error_summary(_errors(spark, sf_dir), ["method"])  # a row per method
    flagged_rows = evaluate.best_flags(s, {"hit_50m_pct": "max", "p50_m": "min"})
    base = s.where("method = 'method_0'").select("p50_m").scalar()
    return flagged_rows.select("method", F.col("best_hit_50m_pct").alias("best_hit"), F.col("best_p50_m").alias("best_p50"), F.round(evaluate.improvement_pct(base, F.col("p50_m")), 6).alias("improvement_pct"))


def _pending(spark, sf_dir):
    p = positions(spark, sf_dir).where("latitude is not null")
    return p.select(
        "icao24", F.col("time_position").alias("ti"), F.col("latitude").alias("lat_i"), F.col("longitude").alias("lon_i"), F.col("latitude").alias("lat0"),
        F.lit(1000.0).alias("pred_n"), F.lit(-500.0).alias("pred_e"), F.lit(0.0).alias("dr_n"), F.lit(0.0).alias("dr_e"),
    )


@query(f"""WITH p AS (SELECT icao24, time_position AS ti, latitude AS la, longitude AS lo FROM pos WHERE latitude IS NOT NULL), r AS (SELECT icao24, time_position AS t, latitude AS a, longitude AS o FROM pos WHERE latitude IS NOT NULL),
  m AS (SELECT icao24, ti, la, lo, min(t) AS t0, max(t) AS t1, max(t) FILTER (t <= ti + 3600) AS ta, max_by(a, t) FILTER (t <= ti + 3600) AS aa, max_by(o, t) FILTER (t <= ti + 3600) AS oa,
    min(t) FILTER (t >= ti + 3600) AS tb, min_by(a, t) FILTER (t >= ti + 3600) AS ab, min_by(o, t) FILTER (t >= ti + 3600) AS ob FROM p JOIN r USING (icao24) GROUP BY 1, 2, 3, 4),
  s AS (SELECT *, CASE WHEN t0 <= ti AND t1 >= ti + 3600 THEN 'scored' WHEN {AS_OF} - (ti + 3600) > 120 THEN 'giveup' ELSE 'keep' END AS state, CASE WHEN ta = tb THEN 0.0 ELSE CAST(ti + 3600 - ta AS DOUBLE) / (tb - ta) END AS f FROM m),
  d AS (SELECT icao24, ti, state, (aa + (ab - aa) * f - la) * 111320.0 AS yn, (oa + (ob - oa) * f - lo) * 111320.0 * cos(radians(la)) AS ye FROM s)
  SELECT icao24, ti, state, CASE WHEN state = 'scored' THEN round(sqrt((1000 - yn) * (1000 - yn) + (-500 - ye) * (-500 - ye)), 3) END AS err_model, CASE WHEN state = 'scored' THEN round(sqrt(yn * yn + ye * ye), 3) END AS moved FROM d""")
def score_pending(spark, sf_dir):
    reports = positions(spark, sf_dir).where("latitude is not null").select("icao24", "time_position", "latitude", "longitude")
    rows = samples.score_pending(_pending(spark, sf_dir), reports, F.lit(AS_OF), 3600)
    return rounded(rows, 3, "err_model", "moved").select("icao24", "ti", "state", "err_model", "moved")


_GRID = f"""WITH r0 AS (SELECT segment_id, time_position AS t, latitude, longitude, velocity, true_track FROM traj WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
  r1 AS (SELECT *, count(*) OVER (PARTITION BY segment_id) AS n, first_value(latitude) OVER s AS lat0, first_value(longitude) OVER s AS lon0, CASE WHEN lag(t) OVER s IS NULL OR t - lag(t) OVER s > 86400 THEN 1 ELSE 0 END AS nb FROM r0 WINDOW s AS (PARTITION BY segment_id ORDER BY t)),
  r2 AS (SELECT *, (latitude - lat0) * 111320.0 AS no, (longitude - lon0) * 111320.0 * cos(radians(lat0)) AS ea, sum(nb) OVER (PARTITION BY segment_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM r1 WHERE n >= 3),
  r3 AS (SELECT *, min(t) OVER w AS t0, max(t) OVER w AS t1 FROM r2 WINDOW w AS (PARTITION BY segment_id, run)),
  o AS (SELECT *, least(64, (t - t0) // 3600) AS context FROM r3 WHERE t + 3600 <= t1 AND t - 6 * 3600 >= t0 AND velocity IS NOT NULL AND true_track IS NOT NULL),
  g AS (SELECT segment_id, run, t, k, t + k * 3600 AS g FROM o, (SELECT unnest(range(-64, 2)) AS k) WHERE k >= -context),
  a AS (SELECT g.*, r3.t AS ta, r3.no AS na, r3.ea AS xa FROM g ASOF JOIN r3 ON g.segment_id = r3.segment_id AND g.run = r3.run AND g.g >= r3.t),
  b AS (SELECT a.*, r3.t AS tb, r3.no AS nb, r3.ea AS xb FROM a ASOF JOIN r3 ON a.segment_id = r3.segment_id AND a.run = r3.run AND a.g <= r3.t),
  p AS (SELECT segment_id, t, k, CASE WHEN ta = tb THEN na ELSE na + (nb - na) * CAST(g - ta AS DOUBLE) / (tb - ta) END AS n, CASE WHEN ta = tb THEN xa ELSE xa + (xb - xa) * CAST(g - ta AS DOUBLE) / (tb - ta) END AS e FROM b),
  moved AS (SELECT segment_id, t, max(n) FILTER (k = 0) - max(n) FILTER (k = -1) AS mn, max(e) FILTER (k = 0) - max(e) FILTER (k = -1) AS me, max(n) FILTER (k = 1) AS n1, max(e) FILTER (k = 1) AS e1, count(*) AS points FROM p GROUP BY 1, 2)
  SELECT segment_id, t AS time_position, CAST(context AS BIGINT) AS context, points, round(mn, 3) + 0.0 AS move_n_t_minus_1, round(me, 3) + 0.0 AS move_e_t_minus_1, round(velocity * 3600 * cos(radians(true_track)), 3) + 0.0 AS dr_north_m,
    round(n1 - no, 3) + 0.0 AS y_north_m, round(e1 - ea, 3) + 0.0 AS y_east_m FROM o JOIN moved USING (segment_id, t)"""


@query(_GRID, gap=86_400)
def grid_samples(spark, sf_dir):
    rows = samples.grid_samples(segments.trajectory(positions(spark, sf_dir), 86_400), 3600, 86_400, 6, 64)
    points = (F.size("move_n") + 2).cast("long").alias("points")  # a move less than points, and the one ahead
    return rows.select("segment_id", "time_position", F.col("context").cast("long").alias("context"), points, *((F.round(c, 3) + 0.0).alias(c) for c in ("move_n_t_minus_1", "move_e_t_minus_1", "dr_north_m", "y_north_m", "y_east_m")))


def _hash_sql(*keys: str) -> str:
    text = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5('42/' || {text}), 1, 8) AS BIGINT)"


@query(f"SELECT is_train, count(*) AS n, count(DISTINCT segment_id) AS segments FROM (SELECT segment_id, {_hash_sql('segment_id')} % 100 < 80 AS is_train FROM traj) GROUP BY 1")
def group_split(spark, sf_dir):
    return samples.group_split(traj(spark, sf_dir), "segment_id").groupBy("is_train").agg(F.count("*").alias("n"), F.countDistinct("segment_id").alias("segments"))


@query(f"SELECT count(*) AS overlap FROM (SELECT segment_id FROM traj WHERE {_hash_sql('segment_id')} % 100 < 80 INTERSECT SELECT segment_id FROM traj WHERE {_hash_sql('segment_id')} % 100 >= 80)")
def group_overlap(spark, sf_dir):
    rows = samples.group_split(traj(spark, sf_dir), "segment_id")
    return samples.group_overlap(rows.where("is_train"), rows.where("not is_train"), "segment_id")


@query(f"SELECT event_id, icao24 FROM (SELECT * FROM pos ORDER BY {_hash_sql('event_id', 'snap_no')}, event_id, snap_no LIMIT 500)")
def seeded_sample(spark, sf_dir):
    return samples.seeded_sample(positions(spark, sf_dir), ["event_id", "snap_no"], 500).select("event_id", "icao24")
