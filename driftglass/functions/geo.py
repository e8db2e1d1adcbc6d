"""Scalar functions on positions and movement, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
M_PER_DEGREE = 111_320.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), F.lit(2)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(h))


def fold_degrees(delta: Column) -> Column:
    """An angle folded to [-180, 180)."""
    return F.pmod(delta + 540.0, F.lit(360.0)) - 180.0


def dead_reckoning(velocity: Column, track: Column, seconds: Column) -> tuple[Column, Column]:
    """Metres north and east after ``seconds`` at constant speed and track."""
    way = velocity * seconds
    return way * F.cos(F.radians(track)), way * F.sin(F.radians(track))


def planar_m(lat: Column, lon: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """Metres north and east of (lat0, lon0) on a plane."""
    return (lat - lat0) * M_PER_DEGREE, (lon - lon0) * M_PER_DEGREE * F.cos(F.radians(lat0))


def euclidean_m(n: Column, e: Column) -> Column:
    return F.sqrt(n * n + e * e)


def speed_mps(distance: Column, seconds: Column) -> Column:
    return F.try_divide(distance, seconds)


def outlier(speed: Column, limit: float = 340.0) -> Column:
    return F.coalesce(speed > limit, F.lit(False))


def extrapolated(lat: Column, lon: Column, velocity: Column, track: Column, on_ground: Column, event: Column, snapshot: Column, now: Column, most_s: float = 30.0) -> tuple[Column, Column]:
    """Position moved on by the report's age, held to [0, most_s]; on the ground or without movement it stays.

    The age counts from the event time, from the snapshot where there is none.
    """
    age = F.least(F.lit(most_s), F.greatest(F.lit(0.0), (now - F.coalesce(event, snapshot)).cast("double")))
    north, east = dead_reckoning(velocity, track, age)
    stays = F.coalesce(on_ground, F.lit(False)) | velocity.isNull() | track.isNull()
    return (
        F.when(stays, lat).otherwise(lat + north / M_PER_DEGREE),
        F.when(stays, lon).otherwise(lon + east / (M_PER_DEGREE * F.cos(F.radians(lat)))),
    )


def altitude_band(altitude: Column, on_ground: Column) -> Column:
    """Display band: ground first, a null altitude counts as 0."""
    a = F.coalesce(altitude, F.lit(0.0))
    return F.when(F.coalesce(on_ground, F.lit(False)), "ground").when(a < 3000, "low").when(a < 9000, "mid").otherwise("high")


def sql_altitude_band(altitude: Column) -> Column:
    """Report band; null stays null."""
    return F.when(altitude < 3000, "1) <3,000m").when(altitude < 9000, "2) 3,000-9,000m").when(altitude.isNotNull(), "3) >=9,000m")


def interpolated(t: Column, t0: Column, v0: Column, t1: Column, v1: Column) -> Column:
    """Value at t on the line through (t0, v0) and (t1, v1); v0 where they coincide."""
    return F.coalesce(v0 + (v1 - v0) * F.try_divide((t - t0).cast("double"), (t1 - t0).cast("double")), v0)


def kmh(mps: Column) -> Column:
    return mps * 3.6
