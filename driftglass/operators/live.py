"""Queries over the latest state: freshness, trails, search, order, facets, statistics, envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftglass.operators.dedup import first_per
from driftglass.operators.segments import not_grounded

UNKNOWN = "Unknown"


def fresh(latest: DataFrame, as_of: Column, span_s: int = 300, snapshot: str = "timestamp") -> DataFrame:
    """Rows seen within ``span_s``, with the altitude shown."""
    out = latest.where(F.col(snapshot) >= as_of - span_s)
    altitude = [F.col(c) for c in ("geo_altitude", "baro_altitude") if c in latest.columns]
    return out.withColumn("altitude", F.coalesce(*altitude))


def trail(history: DataFrame, icao24: str, as_of: Column, minutes: int = 10, snapshot: str = "timestamp", ties: list | None = None) -> DataFrame:
    """One row per snapshot of one object over the last 1 to 30 minutes, oldest first."""
    span = 60 * max(1, min(30, minutes))
    rows = history.where((F.col("icao24") == icao24) & (F.col(snapshot) >= as_of - span))
    return first_per(rows, [snapshot], ties or ["time_position"]).orderBy(snapshot)


def airborne_only(df: DataFrame) -> DataFrame:
    return df.where(not_grounded(F.col("on_ground")))


def in_country(df: DataFrame, country: str, column: str = "country") -> DataFrame:
    return df.where(F.coalesce(F.col(column), F.lit(UNKNOWN)) == country)


def search(df: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Case-insensitive substring in any of ``columns``; a blank query keeps all."""
    q = query.strip().lower()
    if not q:
        return df
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(q)), F.lit(False))
    return df.where(hit)


def ordered(df: DataFrame, by: str, pinned: list[str] | None = None) -> DataFrame:
    """Order by country, altitude or callsign; pinned objects first, then the key, so the order is total."""
    keys = {
        "country": [F.col("country").asc_nulls_last(), F.col("callsign").asc_nulls_last()],
        "altitude": [F.col("altitude").desc_nulls_last()],
        "callsign": [F.col("callsign").asc_nulls_last()],
        "icao24": [],
    }[by]
    return df.orderBy(F.col("icao24").isin(pinned or []).desc(), *keys, "icao24")


def facets(df: DataFrame, column: str = "country") -> DataFrame:
    """Counts per value, most first, then by name."""
    return df.groupBy(F.coalesce(F.col(column), F.lit(UNKNOWN)).alias(column)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def statistics(df: DataFrame, altitude: str = "altitude", country: str = "country") -> DataFrame:
    """Counts and means: altitude over flying rows that have one, speed over all rows with null as 0."""
    grounded = ~not_grounded(F.col("on_ground"))
    return df.agg(
        F.count("*").alias("total"),
        F.avg(F.when(~grounded & F.col(altitude).isNotNull(), F.col(altitude))).alias("avg_altitude"),
        F.count_if(grounded).alias("grounded"),
        F.avg(F.coalesce("velocity", F.lit(0.0))).alias("avg_speed"),
        F.countDistinct(country).alias("countries"),
    )


def cadence(snapshots: DataFrame, snapshot: str = "timestamp", last: int = 12, default: float = 10.0) -> DataFrame:
    """Upper median of the last intervals between distinct snapshots; the default while there are fewer than three."""
    recent = snapshots.select(snapshot).distinct().orderBy(F.desc(snapshot)).limit(last + 1)
    steps = recent.agg(F.array_sort(F.collect_list(snapshot)).alias("t"))
    gaps = F.array_sort(F.transform(F.slice("t", F.lit(2), F.greatest(F.size("t") - 1, F.lit(0))), lambda x, k: (x - F.get("t", k)).cast("double")))
    steps = steps.withColumn("gaps", gaps)
    value = F.when(F.size("gaps") >= 3, F.element_at("gaps", (F.size("gaps") / 2).cast("int") + 1)).otherwise(F.lit(default))
    return steps.select(F.size("gaps").cast("long").alias("intervals"), value.alias("update_s"))


def envelope(df: DataFrame, columns: list[str]) -> DataFrame:
    """The push message: one JSON text with all rows in key order. The live set is one row per object in view."""
    return df.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("flights")).select(F.to_json(F.struct(F.size("flights").alias("count"), "flights")).alias("message"))


def ages(df: DataFrame, snapshot: Column, as_of: Column, period_s: float) -> DataFrame:
    """Seconds since the update and seconds to the next one, or due."""
    out = df.withColumn("since_s", F.greatest(F.lit(0), as_of - snapshot))
    left = F.lit(period_s) - F.col("since_s")
    return out.withColumn("next_s", F.greatest(F.lit(0.0), left)).withColumn("due", left <= 0)


def eligible(df: DataFrame, last_origin: DataFrame, as_of: Column, fresh_s: int = 60, context_s: int = 60) -> DataFrame:
    """Objects to predict for: a report newer than the last prediction's, recent, with enough unbroken context.

    ``df`` has the rows of each object's last run (segments.last_runs); ``last_origin`` has icao24 and last_ti.
    """
    w = Window.partitionBy("icao24")
    tail = df.withColumn("_t0", F.min("time_position").over(w)).withColumn("_t1", F.max("time_position").over(w)).where("time_position = _t1")
    joined = tail.join(last_origin, "icao24", "left")
    ok = (F.col("_t1") > F.coalesce("last_ti", F.lit(-1))) & (as_of - F.col("_t1") <= fresh_s) & (F.col("_t1") - F.col("_t0") >= context_s)
    return joined.where(ok & F.col("velocity").isNotNull() & F.col("true_track").isNotNull()).drop("_t0", "_t1", "last_ti")
