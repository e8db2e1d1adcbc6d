"""The ``states`` fixture: position reports derived from the events table, in both dialects.

Integer arithmetic only, so both engines agree: a quarter stale repeats (snap_no 1), null positions, null event times and
a three-valued on_ground.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Scaled constants: the events are hours apart, not seconds.
GAP, RUN_GAP, STEP = 21_600, 86_400, 3_600

_BODY = """
SELECT e.event_id, s.k AS snap_no, lower(lpad({hex}(e.user_id), 6, '0')) AS icao24,
  CASE e.event_type
    WHEN 'click'    THEN 'KAL' || CAST(100 + e.user_id % 900 AS {str})
    WHEN 'view'     THEN 'CPA' || CAST(100 + e.user_id % 900 AS {str})
    WHEN 'purchase' THEN 'JAL' || CAST(100 + e.user_id % 900 AS {str})
    WHEN 'signup'   THEN 'HL'  || CAST(7000 + e.user_id % 900 AS {str})
    ELSE 'N/A' END AS callsign,
  'NATION_' || CAST(e.user_id % 25 AS {str}) AS origin_country,
  CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE {epoch} END AS time_position,
  {epoch} + s.k * 10 AS snap_epoch,
  CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE CAST(33000 + e.event_id * 7919 % 5500 AS DOUBLE) / 1000 END AS latitude,
  CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE CAST(126000 + e.event_id * 104729 % 4000 AS DOUBLE) / 1000 END AS longitude,
  CASE WHEN e.event_type = 'signup' OR e.event_id % 83 = 0 THEN NULL ELSE CAST(e.event_id * 37 % 12000 AS DOUBLE) END AS baro_altitude,
  CASE WHEN e.event_id % 79 = 0 THEN NULL ELSE e.event_type = 'signup' END AS on_ground,
  e.value AS velocity,
  CAST(e.event_id * 31 % 3600 AS DOUBLE) / 10 AS true_track,
  CAST(e.event_id % 21 - 10 AS DOUBLE) AS vertical_rate
FROM {source} e JOIN (VALUES (0),(1)) AS s(k) ON s.k = 0 OR e.event_id % 4 = 0
"""

_DUCK = _BODY.format(hex="to_hex", str="VARCHAR", epoch="CAST(floor(epoch(e.ts)) AS BIGINT)", source="events")
_POSITIONS = """pos AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY icao24, time_position ORDER BY snap_epoch, event_id) AS rn FROM states WHERE time_position IS NOT NULL) WHERE rn = 1)"""

#: Fixed SQL of the trajectory, shared by the oracles that build on it.
_TRAJ = """seg0 AS (SELECT *, CASE WHEN lag(time_position) OVER w IS NULL OR time_position - lag(time_position) OVER w > {gap} THEN 1 ELSE 0 END AS ns
  FROM pos WHERE on_ground = FALSE WINDOW w AS (PARTITION BY icao24 ORDER BY time_position)),
seg1 AS (SELECT *, sum(ns) OVER (PARTITION BY icao24 ORDER BY time_position ROWS UNBOUNDED PRECEDING) AS sn FROM seg0),
seg2 AS (SELECT *, min(time_position) OVER (PARTITION BY icao24, sn) AS seg_start FROM seg1),
traj0 AS (SELECT *, row_number() OVER s - 1 AS point_idx, lag(time_position) OVER s AS pt, lag(latitude) OVER s AS pla, lag(longitude) OVER s AS plo,
    lag(true_track) OVER s AS ptr, lag(baro_altitude) OVER s AS pal, lag(velocity) OVER s AS pve,
    lead(time_position) OVER s AS nt, lead(latitude) OVER s AS next_latitude, lead(longitude) OVER s AS next_longitude, lead(baro_altitude) OVER s AS next_baro_altitude
  FROM seg2 WINDOW s AS (PARTITION BY icao24, sn ORDER BY time_position)),
traj1 AS (SELECT *, icao24 || '_' || CAST(seg_start AS VARCHAR) AS segment_id, time_position - pt AS dt_s,
    2 * 6371000.0 * asin(sqrt(pow(sin((radians(latitude) - radians(pla)) / 2), 2) + cos(radians(pla)) * cos(radians(latitude)) * pow(sin((radians(longitude) - radians(plo)) / 2), 2))) AS dist_m,
    (true_track - ptr + 540) - 360 * floor((true_track - ptr + 540) / 360) - 180 AS heading_change_deg,
    baro_altitude - pal AS alt_change_m, velocity - pve AS velocity_change_mps, nt - time_position AS next_dt_s FROM traj0),
traj AS (SELECT *, dist_m / nullif(dt_s, 0) AS calc_speed_mps, coalesce(dist_m / nullif(dt_s, 0) > 340, FALSE) AS is_outlier FROM traj1)"""


def duck(query: str, gap: int = GAP) -> str:
    """DuckDB SQL over states, and pos and traj (segments by ``gap``) where the query names them."""
    parts = [f"states AS ({_DUCK})"]
    if "pos" in query or "traj" in query:
        parts.append(_POSITIONS)
    if "traj" in query:
        parts.append(_TRAJ.format(gap=gap))
    body = query.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(_BODY.format(hex="hex", str="STRING", epoch="unix_timestamp(e.ts)", source="{events}"), events=events)


def with_clock(df: DataFrame) -> DataFrame:
    """The snapshot clock as a timestamp."""
    return df.withColumn("timestamp", F.timestamp_seconds("snap_epoch"))
