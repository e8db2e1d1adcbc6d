"""Counts, profiles and daily or hourly aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftglass.operators.segments import airborne

NO_CALLSIGN = "N/A"


def drop_reasons(df: DataFrame, snapshot: str = "timestamp") -> DataFrame:
    """One pass over flagged rows: all, valid, and why the others are not (a row may have several reasons)."""
    no_key, no_place, no_time = F.col("icao24").isNull(), F.col("latitude").isNull() | F.col("longitude").isNull(), F.col(snapshot).isNull()
    return df.agg(
        F.count("*").alias("total"),
        F.count_if("_valid").alias("valid"),
        F.count_if(no_key & no_place & no_time).alias("unparsed"),
        F.count_if(no_key).alias("no_key"),
        F.count_if(no_place).alias("no_coord"),
        F.count_if(no_time).alias("no_time"),
    )


def quality_profile(df: DataFrame, owner: Column, snapshot: Column, *by: str) -> DataFrame:
    """Data-quality counts of one date's rows, or of each group's."""
    lat, lon, alt, vel = (F.col(c) for c in ("latitude", "longitude", "baro_altitude", "velocity"))
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.to_date(snapshot) != owner).alias("date_mismatch"),
        F.count_if(lat.isNull() | lon.isNull()).alias("null_position"),
        F.count_if(alt.isNull()).alias("null_baro_altitude"),
        F.count_if(vel.isNull()).alias("null_velocity"),
        F.count_if((F.abs(lat) > 90) | (F.abs(lon) > 180)).alias("bad_position"),
        F.count_if((alt < -500) | (alt > 20000)).alias("bad_altitude"),
        F.count_if((vel < 0) | (vel > 400)).alias("bad_velocity"),
        F.countDistinct("icao24").alias("aircraft"),
    )


def daily(positions: DataFrame, traj: DataFrame, event: Column, *by: str) -> DataFrame:
    """Per object: last known callsign and country, first and last report, counts, flown distance and segments.

    Both inputs are hashed by the key, so the join adds no shuffle to the aggregates'. ``by``: a row per these and object.
    """
    air, ground = airborne(F.col("on_ground")), F.col("on_ground").eqNullSafe(F.lit(True))
    base = positions.groupBy(*by, "icao24").agg(
        F.coalesce(F.max_by("callsign", F.when(F.col("callsign") != NO_CALLSIGN, F.col("time_position"))), F.lit(NO_CALLSIGN)).alias("callsign"),
        F.max_by("origin_country", "time_position").alias("origin_country"),
        F.min(event).alias("first_seen"),
        F.max(event).alias("last_seen"),
        F.count("*").alias("obs_count"),
        F.count_if(air).alias("airborne_obs"),
        F.count_if(ground).alias("ground_obs"),
        F.max("baro_altitude").alias("max_baro_altitude"),
        F.avg(F.when(air, F.col("velocity"))).alias("avg_airborne_velocity"),
    )
    flown = traj.groupBy(*by, "icao24").agg(F.countDistinct("segment_id").alias("segment_count"), F.sum("dist_m").alias("distance_m"))
    return base.join(flown, [*by, "icao24"], "left").fillna({"segment_count": 0, "distance_m": 0.0})


def hourly(positions: DataFrame, snapshot: Column, *by: str) -> DataFrame:
    """Distinct objects, distinct flying objects and reports by UTC hour of the snapshot and country."""
    return positions.groupBy(*by, F.hour(snapshot).alias("hour_utc"), "origin_country").agg(
        F.countDistinct("icao24").alias("aircraft_count"),
        F.countDistinct(F.when(airborne(F.col("on_ground")), F.col("icao24"))).alias("airborne_aircraft"),
        F.count("*").alias("obs_count"),
    )


def hourly_approx(positions: DataFrame, snapshot: Column, error: float = 0.02) -> DataFrame:
    """The same with HyperLogLog counts: one exchange of sketches, whatever the number of objects."""
    return positions.groupBy(F.hour(snapshot).alias("hour_utc"), "origin_country").agg(
        F.approx_count_distinct("icao24", error).alias("aircraft_count"),
        F.approx_count_distinct(F.when(airborne(F.col("on_ground")), F.col("icao24")), error).alias("airborne_aircraft"),
        F.count("*").alias("obs_count"),
    )


def fast_digest(columns: list[str]) -> Column:
    return F.xxhash64(*columns).cast("decimal(38,0)")


def portable_digest(columns: list[str]) -> Column:
    """48 bits of the md5 of the values as text, in column order: the same in any engine, for values that print alike."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, columns: list[str] | None = None, digest: Callable[[list[str]], Column] = fast_digest) -> DataFrame:
    """Order-independent content fingerprint: rows and the sum of row digests; duplicates count."""
    total = F.sum(digest(columns or sorted(df.columns)))
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(total, F.lit(0)).cast("decimal(38,0)").alias("hash_sum"))


def null_keys(df: DataFrame, *by: Column, key: str = "icao24") -> DataFrame:
    """Reports (polls) and those without a key, for the groups that have such."""
    return df.groupBy(*by).agg(F.count("*").alias("polls"), F.count_if(F.col(key).isNull()).alias("null_keys")).where("null_keys > 0")


def running_total(df: DataFrame, at: str, n: str) -> DataFrame:
    """Add so_far, the sum of ``n`` up to each ``at``. ``df`` is a small aggregate: a row per period."""
    return df.withColumn("so_far", F.sum(n).over(Window.orderBy(at)))


def heartbeat(df: DataFrame, as_of: Column, busy: Column, snapshot: str = "timestamp", stale_s: int = 60) -> DataFrame:
    """One row on a writer's life: rows, the seconds they span, whether the newest is recent, and whether it is busy."""
    return df.agg(
        F.count("*").alias("n"),
        (F.max(snapshot) - F.min(snapshot)).alias("span_s"),
        ((as_of - F.max(snapshot)) < stale_s).alias("healthy"),
        (F.count_if(busy) > 0).alias("busy"),
    )


def health(df: DataFrame, snapshot: Column, as_of: Column, stale_s: int = 120) -> DataFrame:
    """Newest snapshot, its age and a verdict: starting, ok or stale."""
    out = df.agg(F.max(snapshot).alias("last_snapshot")).withColumn("age_s", F.greatest(F.lit(0), as_of - F.col("last_snapshot")))
    return out.withColumn("status", F.when(F.col("last_snapshot").isNull(), "starting").when(F.col("age_s") <= stale_s, "ok").otherwise("stale"))
