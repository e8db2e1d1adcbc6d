"""Analytic queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.functions.geo import sql_altitude_band
from driftglass.operators.quantiles import FEW, quantiles


def top_traffic(hourly: DataFrame, n: int = 10) -> DataFrame:
    return hourly.orderBy(F.desc("aircraft_count"), "event_date", "hour_utc", "origin_country").limit(n)


def local_hours(hourly: DataFrame, offset_h: int = 9) -> DataFrame:
    """Objects per local hour start, then days and mean per hour of the day."""
    start = F.timestamp_add("HOUR", F.col("hour_utc") + offset_h, F.col("event_date").cast("timestamp"))
    per = hourly.groupBy(start.alias("start")).agg(F.sum("aircraft_count").alias("aircraft"))
    return per.groupBy(F.hour("start").alias("hour_local")).agg(F.count("*").alias("days"), F.round(F.avg("aircraft"), 1).alias("avg_aircraft"))


def top_hours(hourly: DataFrame, n: int = 10, offset_h: int = 9) -> DataFrame:
    return local_hours(hourly, offset_h).orderBy(F.desc("avg_aircraft"), "hour_local").limit(n)


def top_distance(daily: DataFrame, n: int = 10) -> DataFrame:
    rows = daily.orderBy(F.desc("distance_m"), "icao24").limit(n)
    return rows.withColumn("distance_km", F.round(F.col("distance_m") / 1000, 1))


def band_speeds(traj: DataFrame, most_dt_s: int = 60, few: int = FEW) -> DataFrame:
    """Exact medians of computed and reported speed per altitude band."""
    rows = traj.where(F.col("dt_s").isNotNull() & (F.col("dt_s") <= most_dt_s) & F.col("baro_altitude").isNotNull())
    rows = rows.withColumn("altitude_band", sql_altitude_band(F.col("baro_altitude"))).select("altitude_band", "calc_speed_mps", "velocity")
    medians = quantiles(rows, ["altitude_band"], {"_calc": F.col("calc_speed_mps"), "_reported": F.col("velocity")}, [0.5], few)
    sizes = rows.groupBy("altitude_band").agg(F.count("*").alias("points"))
    return sizes.join(F.broadcast(medians), "altitude_band").select(  # three bands
        "altitude_band", "points", F.round(F.get("_calc", F.lit(0)), 1).alias("calc_speed_p50"), F.round(F.get("_reported", F.lit(0)), 1).alias("reported_speed_p50")
    )


def date_list(df: DataFrame, day: str = "event_date") -> DataFrame:
    """Rows and the comma-joined distinct dates in order."""
    per = df.groupBy(F.col(day).cast("string").alias("d")).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.array_join(F.array_sort(F.collect_list("d")), ",").alias("event_dates"))


def sorted_dates(df: DataFrame, column: str) -> DataFrame:
    """Every distinct date of a column, in order, as text."""
    return df.select(F.to_date(column).cast("string").alias("dt")).where("dt is not null").distinct().orderBy("dt")
