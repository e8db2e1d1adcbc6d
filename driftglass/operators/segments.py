"""Gap-based segments, runs within them, and trajectories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftglass.functions import geo


def gap_segments(df: DataFrame, key: str, t: str, gap: float, ties: list | None = None, start: str = "seg_start", number: str = "seg_no", span: tuple[str, ...] = ()) -> DataFrame:
    """Add the number and start of the segment: a new one begins after more than ``gap`` (exactly ``gap`` stays).

    Both windows partition by ``key`` (the second by a superset), so one exchange serves them and whatever follows by
    (key, start). ``df`` should hold a bounded time span per key: the daily plan reads two dates. Rows that differ in a
    column of ``span`` don't see each other.
    """
    order = [t, *(ties or [])]
    w = Window.partitionBy(*span, key).orderBy(*order)
    before = F.lag(t).over(w)
    df = df.withColumn("_new", F.when(before.isNull() | ((F.col(t) - before) > gap), 1).otherwise(0))
    df = df.withColumn(number, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")
    return df.withColumn(start, F.min(t).over(Window.partitionBy(*span, key, number)))


def segment_id(key: Column, start: Column) -> Column:
    return F.concat_ws("_", key, start.cast("string"))


def airborne(c: Column) -> Column:
    """Known to fly: null is neither flying nor on the ground."""
    return c.eqNullSafe(F.lit(False))


def not_grounded(c: Column) -> Column:
    """Display rule: only a true flag counts as ground."""
    return ~F.coalesce(c, F.lit(False))


LAGS = ["time_position", "latitude", "longitude", "true_track", "baro_altitude", "velocity"]
LEADS = ["time_position", "latitude", "longitude", "baro_altitude"]


def trajectory(positions: DataFrame, gap: float = 300, fastest: float = 340.0, ties: list | None = None, span: tuple[str, ...] = ()) -> DataFrame:
    """Flying positions in segments, with what changed since the previous report and where the next one is.

    Null keys belong to no object and are left out. The partition is (key, segment start), not the text id: the one hash
    exchange on the key serves every window.
    """
    air = positions.where(airborne(F.col("on_ground")) & F.col("icao24").isNotNull())
    seg = gap_segments(air, "icao24", "time_position", gap, ties, span=span)
    s = Window.partitionBy(*span, "icao24", "seg_no").orderBy("time_position", *(ties or []))
    seg = seg.withColumns({f"prev_{c}": F.lag(c).over(s) for c in LAGS} | {f"next_{c}": F.lead(c).over(s) for c in LEADS} | {"point_idx": (F.row_number().over(s) - 1).cast("long")})
    dt = F.col("time_position") - F.col("prev_time_position")
    seg = seg.withColumns({
        "segment_id": segment_id(F.col("icao24"), F.col("seg_start")),
        "dt_s": dt,
        "dist_m": geo.haversine_m(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude")),
        "heading_change_deg": geo.fold_degrees(F.col("true_track") - F.col("prev_true_track")),
        "alt_change_m": F.col("baro_altitude") - F.col("prev_baro_altitude"),
        "velocity_change_mps": F.col("velocity") - F.col("prev_velocity"),
        "next_dt_s": F.col("next_time_position") - F.col("time_position"),
    }).withColumn("calc_speed_mps", geo.speed_mps(F.col("dist_m"), F.col("dt_s")))
    seg = seg.withColumn("is_outlier", geo.outlier(F.col("calc_speed_mps"), fastest))
    return seg.drop(*(f"prev_{c}" for c in LAGS), "next_time_position", "seg_no")


def session_counts(df: DataFrame, key: str, ts: Column, gap_s: int) -> DataFrame:
    """Native sessions: they merge where one ends as the other begins, so a gap of exactly ``gap_s`` does not split."""
    return df.groupBy(key, F.session_window(ts, f"{gap_s} seconds").alias("_s")).agg(F.count("*").alias("n_points"), F.unix_timestamp("_s.start").alias("seg_start")).drop("_s")


def last_runs(df: DataFrame, key: str = "icao24", t: str = "time_position", gap: float = 30) -> DataFrame:
    """The rows of each key's last unbroken run."""
    runs = gap_segments(df.where(F.col(key).isNotNull()), key, t, gap, start="run_start", number="run_no")
    last = F.max("run_no").over(Window.partitionBy(key))
    return runs.withColumn("_last", last).where("run_no = _last").drop("_last")
