"""Training samples: next-report features, interpolation on a regular grid, group split, pending predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftglass.functions import geo
from driftglass.operators.segments import gap_segments


def next_report(traj: DataFrame, least_s: int = 1, most_s: int = 60) -> DataFrame:
    """Features and labels for the next report of each trajectory point."""
    rows = traj.where(F.col("next_latitude").isNotNull() & F.col("next_longitude").isNotNull() & F.col("next_dt_s").between(least_s, most_s) & F.col("velocity").isNotNull() & F.col("true_track").isNotNull())
    north, east = geo.dead_reckoning(F.col("velocity"), F.col("true_track"), F.col("next_dt_s"))
    y_north, y_east = geo.planar_m(F.col("next_latitude"), F.col("next_longitude"), F.col("latitude"), F.col("longitude"))
    return rows.withColumns({
        "track_sin": F.sin(F.radians("true_track")), "track_cos": F.cos(F.radians("true_track")),
        "dr_north_m": north, "dr_east_m": east, "y_north_m": y_north, "y_east_m": y_east,
    })


def bracketed(rows: DataFrame, asked: DataFrame, keys: list[str], t: str, values: list[str], at: str = "at") -> DataFrame:
    """As-of interpolation: ``values`` at the times ``at`` of ``asked``, held beyond the first and last row.

    Union and sort instead of a range join: one exchange on the keys, no pairs. Other columns of ``asked`` are kept.
    """
    carried = [c for c in asked.columns if c not in (*keys, at)]
    whole = Window.partitionBy(*keys)
    report = F.struct(F.col(t).alias("_t"), *values)
    known = rows.select(*keys, F.col(t).alias("_t"), report.alias("_r"), F.lead(report).over(whole.orderBy(t)).alias("_next"), F.lit(0).alias("_q"))
    marked = known.unionByName(asked.select(*keys, F.col(at).alias("_t"), *carried, F.lit(1).alias("_q")), allowMissingColumns=True)
    # one sort: a time's last report knows the one after it; before the first report there is only that
    up = whole.orderBy("_t", "_q").rowsBetween(Window.unboundedPreceding, 0)
    both = F.when(F.col("_q") == 0, F.struct(F.col("_r").alias("a"), F.coalesce("_next", "_r").alias("b")))
    out = marked.withColumns({"_x": F.last(both, ignorenulls=True).over(up), "_first": F.min("_r").over(whole)}).where("_q = 1")
    for v in values:
        a, b = F.col("_x.a"), F.col("_x.b")
        line = geo.interpolated(F.col("_t"), a["_t"], a[v], b["_t"], b[v])
        held = F.when(F.col("_x").isNull(), F.col("_first")[v]).when(a["_t"] == F.col("_t"), a[v])
        out = out.withColumn(v, held.when(a[v].isNull(), b[v]).when(b[v].isNull(), a[v]).otherwise(line))
    return out.select(*keys, F.col("_t").alias(at), *values, *carried)


def grid_samples(traj: DataFrame, step: int = 10, gap: float = 30, least: int = 6, most: int = 64) -> DataFrame:
    """One sample per report: displacements on a grid that ends at the report, and the position one step later.

    A report needs ``least`` steps of unbroken context behind it and a report at least one step ahead in its run. The
    run's reports within reach are one array per report; each stretch between two of them gives the grid points in it, so
    the work is that of the reports and points together (at most ``most`` + 2 points a report).
    """
    t, lat, lon = F.col("time_position"), F.col("latitude"), F.col("longitude")
    rows = traj.where(t.isNotNull() & lat.isNotNull() & lon.isNotNull()).dropDuplicates(["segment_id", "time_position"])
    seg = Window.partitionBy("segment_id").orderBy("time_position")
    size = F.count("*").over(Window.partitionBy("segment_id"))
    rows = rows.withColumn("_n", size).where("_n >= 3").drop("_n")
    rows = rows.withColumns({"_lat0": F.first("latitude").over(seg), "_lon0": F.first("longitude").over(seg)})
    north, east = geo.planar_m(lat, lon, F.col("_lat0"), F.col("_lon0"))
    rows = rows.withColumns({"_north": north, "_east": east})
    rows = gap_segments(rows, "segment_id", "time_position", gap, start="run_start", number="run_no")
    run = Window.partitionBy("segment_id", "run_no")
    reach = run.orderBy("time_position").rangeBetween(-(most + 1) * step - int(gap), step + int(gap))
    rows = rows.withColumns({
        "_end": F.max("time_position").over(run),
        "_prev_track": F.lag("true_track").over(run.orderBy("time_position")),
        "_prev_velocity": F.lag("velocity").over(run.orderBy("time_position")),
        "_near": F.collect_list(F.struct(t.alias("t"), F.col("_north").alias("n"), F.col("_east").alias("e"))).over(reach),
    })
    ok = (t + step <= F.col("_end")) & (t - least * step >= F.col("run_start")) & F.col("velocity").isNotNull() & F.col("true_track").isNotNull()
    rows = rows.where(ok).withColumn("context", F.least(F.lit(most), F.floor((t - F.col("run_start")) / step)).cast("int"))

    def points(a: Column, place: Column) -> Column:
        """Grid points from report ``a`` up to, and without, the one after it."""
        b = F.get("_near", place + 1)
        first = F.greatest(-F.col("context"), F.ceil((a["t"] - t) / step).cast("int"))
        # the last report in reach has only the point on it
        last = F.least(F.lit(1), F.when(b.isNull(), F.floor((a["t"] - t) / step)).otherwise(F.ceil((b["t"] - t) / step) - 1).cast("int"))
        steps = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        at = lambda k, axis: F.coalesce(geo.interpolated(t + k * step, a["t"], a[axis], b["t"], b[axis]), a[axis])
        return F.transform(steps, lambda k: F.struct(at(k, "n").alias("n"), at(k, "e").alias("e")))

    rows = rows.withColumn("_grid", F.flatten(F.transform("_near", points)))  # oldest first, the report itself, one step ahead
    moves = lambda axis: F.transform(F.slice("_grid", F.lit(2), F.size("_grid") - 2), lambda p, k: p[axis] - F.get("_grid", k)[axis])
    rows = rows.withColumns({"move_n": moves("n"), "move_e": moves("e")})
    ahead = F.element_at("_grid", -1)
    dr_n, dr_e = geo.dead_reckoning(F.col("velocity"), F.col("true_track"), F.lit(step))
    back = {f"move_{a}_t_minus_{k}": F.element_at(f"move_{a}", -k) for k in (1, 2, 3) for a in ("n", "e")}
    return rows.select(
        "segment_id", "time_position", "context", "move_n", "move_e", *(v.alias(k) for k, v in back.items()),
        "velocity", F.sin(F.radians("true_track")).alias("track_sin"), F.cos(F.radians("true_track")).alias("track_cos"), "baro_altitude", "vertical_rate",
        geo.fold_degrees(F.col("true_track") - F.col("_prev_track")).alias("heading_change_deg"), (F.col("velocity") - F.col("_prev_velocity")).alias("velocity_change_mps"),
        dr_n.alias("dr_north_m"), dr_e.alias("dr_east_m"), (ahead["n"] - F.col("_north")).alias("y_north_m"), (ahead["e"] - F.col("_east")).alias("y_east_m"),
    )


def hashed(keys: list[str], seed: int) -> Column:
    """32 bits of a digest of the keys as text: the same in any engine that has md5."""
    text = F.concat_ws("/", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def group_split(df: DataFrame, group: str, train_pct: int = 80, seed: int = 42) -> DataFrame:
    """Add is_train; a group is never on both sides."""
    return df.withColumn("is_train", hashed([group], seed) % 100 < train_pct)


def group_overlap(train: DataFrame, test: DataFrame, group: str) -> DataFrame:
    """Groups on both sides of a split; 0 for a sound one."""
    return train.select(group).intersect(test.select(group)).agg(F.count("*").alias("overlap"))


def seeded_sample(df: DataFrame, keys: list[str], most: int, seed: int = 42) -> DataFrame:
    """At most ``most`` rows, the same for every run, in key order."""
    return df.orderBy(hashed(keys, seed), *keys).limit(most).orderBy(*keys)


def score_pending(pending: DataFrame, reports: DataFrame, as_of: Column, step: int = 10, giveup_s: int = 120) -> DataFrame:
    """Pending predictions (icao24, ti, lat_i, lon_i, lat0, pred_n, pred_e, dr_n, dr_e) against the last runs' reports.

    scored: the run spans ti and ti + step, and the errors are against the interpolated position; giveup: the truth is
    overdue; keep: it may still come. Union and sort per object, so no prediction is paired with every report.
    """
    target = F.col("ti") + step
    report = F.struct(F.col("time_position").alias("t"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    seen = reports.select("icao24", F.col("time_position").alias("_t"), report.alias("_r"), F.lit(0).alias("_q"))
    asked = pending.withColumns({"_t": target, "_q": F.lit(1)})
    both = asked.unionByName(seen, allowMissingColumns=True)
    whole = Window.partitionBy("icao24")
    up = whole.orderBy("_t", "_q").rowsBetween(Window.unboundedPreceding, 0)
    down = whole.orderBy(F.desc("_t"), "_q").rowsBetween(Window.unboundedPreceding, 0)
    spans = both.withColumns({
        "_t0": F.min("_r.t").over(whole), "_t1": F.max("_r.t").over(whole),
        "_a": F.last("_r", ignorenulls=True).over(up), "_b": F.last("_r", ignorenulls=True).over(down),
    }).where("_q = 1")
    scored = (F.col("_t0") <= F.col("ti")) & (F.col("_t1") >= target)
    lat = geo.interpolated(target, F.col("_a.t"), F.col("_a.lat"), F.col("_b.t"), F.col("_b.lat"))
    lon = geo.interpolated(target, F.col("_a.t"), F.col("_a.lon"), F.col("_b.t"), F.col("_b.lon"))
    yn = (lat - F.col("lat_i")) * geo.M_PER_DEGREE
    ye = (lon - F.col("lon_i")) * geo.M_PER_DEGREE * F.cos(F.radians("lat0"))
    state = F.when(scored, "scored").when(as_of - target > giveup_s, "giveup").otherwise("keep")
    out = spans.withColumn("state", F.coalesce(state, F.lit("keep")))
    only = lambda c: F.when(F.col("state") == "scored", c)
    return out.withColumns({
        "err_model": only(geo.euclidean_m(F.col("pred_n") - yn, F.col("pred_e") - ye)),
        "err_dr": only(geo.euclidean_m(F.col("dr_n") - yn, F.col("dr_e") - ye)),
        "moved": only(geo.euclidean_m(yn, ye)),
    }).drop("_t", "_q", "_r", "_t0", "_t1", "_a", "_b")
