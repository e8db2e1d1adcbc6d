import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftglass.operators import aggregates, dedup, evaluate, live, merge, samples, segments

POS = "icao24 string, time_position long, timestamp long, latitude double, longitude double, true_track double, baro_altitude double, velocity double, on_ground boolean, callsign string, origin_country string, event_date string"


def row(k="a", t=0, snap=None, lat=37.0, lon=127.0, track=0.0, alt=1000.0, v=100.0, ground=False, call="KAL1", country="X", day="d"):
    return (k, t, t if snap is None else snap, lat, lon, track, alt, v, ground, call, country, day)


def frame(spark, rows):
    return spark.createDataFrame(rows, POS)


def test_earliest_snapshot_owns_the_position(spark):
    rows = [row(t=10, snap=30, day="2"), row(t=10, snap=12, day="1"), row(t=10, snap=20, day="1"), row(t=None, snap=5)]
    for order in itertools.permutations(rows):
        got = dedup.positions(frame(spark, list(order))).collect()
        assert [(r.timestamp, r.event_date) for r in got] == [(12, "1")]


@pytest.mark.parametrize(("gap", "n"), [(300, 1), (301, 2)])
def test_gap_is_strict(spark, gap, n):
    traj = segments.trajectory(frame(spark, [row(t=0), row(t=gap)]))
    assert traj.select("segment_id").distinct().count() == n
    sessions = segments.session_counts(frame(spark, [row(t=0), row(t=gap)]), "icao24", F.timestamp_seconds("time_position"), 300)
    assert sessions.count() == n


def test_trajectory_leaves_ground_unknown_and_keyless_out(spark):
    rows = [row(t=0, ground=True), row(t=5, ground=None), row(k=None, t=6), row(t=10), row(t=20, lat=37.001), row(k="b", t=3)]
    got = segments.trajectory(frame(spark, rows)).orderBy("icao24", "time_position").collect()
    assert [(r.icao24, r.time_position, r.point_idx, r.segment_id) for r in got] == [("a", 10, 0, "a_10"), ("a", 20, 1, "a_10"), ("b", 3, 0, "b_3")]
    assert got[1].dist_m == pytest.approx(111.19, abs=0.01) and got[1].calc_speed_mps == pytest.approx(11.119, abs=1e-3)
    assert got[0].next_dt_s == 10 and got[0].dt_s is None and got[2].is_outlier is False


def test_one_exchange_serves_all_windows(spark):
    plan = segments.trajectory(frame(spark, [row()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_daily_callsign_and_counts(spark):
    pos = frame(spark, [row(t=1, call="KAL1"), row(t=5, call="N/A", ground=True, v=None), row(k="b", t=2, call="N/A", ground=None)])
    got = {r.icao24: r for r in aggregates.daily(pos, segments.trajectory(pos), F.col("time_position")).collect()}
    assert got["a"].callsign == "KAL1" and got["b"].callsign == "N/A"
    assert (got["a"].obs_count, got["a"].airborne_obs, got["a"].ground_obs, got["a"].segment_count) == (2, 1, 1, 1)
    assert got["b"].segment_count == 0 and got["b"].distance_m == 0.0


def test_hourly_sketch_is_near(spark):
    df = spark.range(5000).select((F.col("id") % 700).cast("string").alias("icao24"), F.lit(False).alias("on_ground"), F.lit("X").alias("origin_country"), (F.col("id") * 0).cast("timestamp").alias("ts"))
    exact, near = aggregates.hourly(df, F.col("ts")).first(), aggregates.hourly_approx(df, F.col("ts")).first()
    assert exact.aircraft_count == 700 and abs(near.aircraft_count - 700) < 60


LATEST = "icao24 string, timestamp long, v string"


def test_upsert_rules(spark):
    stored = spark.createDataFrame([("a", 10, "old"), ("b", 10, "old"), ("c", 10, "old")], LATEST)
    batch = spark.createDataFrame([("a", 9, "new"), ("b", 10, "new"), ("c", 11, "y"), ("c", 11, "x"), ("d", 1, "new"), (None, 5, "new")], LATEST)
    once = merge.upsert_latest(stored, batch, ties=["v"])
    assert {r.icao24: r.v for r in once.collect()} == {"a": "old", "b": "old", "c": "x", "d": "new"}
    assert sorted(map(tuple, merge.upsert_latest(once, batch, ties=["v"]).collect())) == sorted(map(tuple, once.collect()))


def test_history_never_conflicts_on_null_event_time(spark):
    s = "icao24 string, time_position long, timestamp long"
    stored = spark.createDataFrame([("a", 1, 1), ("a", None, 1)], s)
    batch = spark.createDataFrame([("a", 1, 2), ("a", 2, 4), ("a", 2, 3), ("a", None, 5), ("a", None, 6)], s)
    assert sorted(map(tuple, merge.insert_absent(stored, batch).collect()), key=str) == [("a", 2, 3), ("a", None, 5), ("a", None, 6)]


@pytest.mark.parametrize(("times", "want"), [([0, 10], 10.0), ([0, 10, 30], 10.0), ([0, 5, 25, 26], 5.0), ([0, 1, 3, 6, 10], 3.0), ([], 10.0)])
def test_cadence_is_the_upper_median(spark, times, want):
    assert live.cadence(spark.createDataFrame([(t,) for t in times], "timestamp long")).first().update_s == want


def test_statistics_are_asymmetric(spark):
    df = spark.createDataFrame([(False, 100.0, 10.0, "X"), (None, None, None, "X"), (True, 900.0, 20.0, None)], "on_ground boolean, altitude double, velocity double, country string")
    r = live.statistics(df).first()
    assert (r.total, r.avg_altitude, r.grounded, r.avg_speed, r.countries) == (3, 100.0, 1, 10.0, 1)


def test_order_search_facets(spark):
    df = spark.createDataFrame([("b", 5.0, "Z1", None), ("a", None, None, "Y"), ("c", 9.0, "A1", "Y")], "icao24 string, altitude double, callsign string, country string")
    assert [r.icao24 for r in live.ordered(df, "altitude").collect()] == ["c", "b", "a"]
    assert [r.icao24 for r in live.ordered(df, "callsign", ["a"]).collect()] == ["a", "c", "b"]
    assert [tuple(r) for r in live.facets(df).collect()] == [("Y", 2), ("Unknown", 1)]
    assert live.search(df, " ", ["callsign"]).count() == 3 and live.search(df, "z", ["callsign"]).count() == 1
    assert live.in_country(df, "Unknown").count() == 1


def test_trail_span_is_held(spark):
    df = spark.createDataFrame([("a", 100 * k, k) for k in range(40)] + [("a", 3900, 99)], "icao24 string, timestamp long, time_position long")
    assert live.trail(df, "a", F.lit(3900), 99).count() == 19
    assert [r.time_position for r in live.trail(df, "a", F.lit(3900), 0).collect()] == [39]


def test_summary_edges(spark):
    df = spark.createDataFrame([("m", 50.0, 0.0), ("m", 100.0, 100.0), ("m", 201.0, 100.0)], "method string, err double, actual double")
    r = evaluate.error_summary(df, ["method"]).first()
    assert (r.hit_50m_pct, r.hit_100m_pct, r.hit_200m_pct) == (33.3, 66.7, 66.7)
    assert r.relative_accuracy_pct == -101.0  # 1 - median of ratios


def test_psi(spark):
    values = lambda n, k=1.0: spark.createDataFrame([(k * x,) for x in range(n)], "v double")
    assert evaluate.psi(values(500), values(500), "v").first().psi == 0.0
    assert evaluate.psi(values(500), values(19), "v").first().psi is None
    ref, cur = np.arange(500.0), np.arange(300.0) * 2.5
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    r, c = (np.clip(np.histogram(x, edges)[0] / len(x), 1e-4, None) for x in (ref, cur))
    assert evaluate.psi(values(500), values(300, 2.5), "v").first().psi == pytest.approx(round(float(((c - r) * np.log(c / r)).sum()), 4))


@pytest.mark.parametrize(("n", "k", "want"), [(199, 1.0, "insufficient"), (200, 1.0, "stable"), (200, 3.0, "shifted")])
def test_drift(spark, n, k, want):
    df = lambda m, f: spark.createDataFrame([(str(i), f * i) for i in range(m)], "icao24 string, v double")
    assert evaluate.drift_verdict(df(200, 1.0), df(n, k), ["v"]).first().status == want


def test_gate_is_strict(spark):
    g = lambda c, b, p: spark.range(1).select(*[x.alias(n) for n, x in evaluate.gate(F.lit(c), F.lit(b), F.lit(p).cast("double")).items()]).first().promoted
    assert [g(2.0, 1.0, None), g(1.0, 1.0, None), g(2.0, 1.0, 2.0), g(2.1, 1.0, 2.0)] == [True, False, False, True]


def test_interpolation_against_numpy(spark):
    rng = np.random.default_rng(0)
    t = np.unique(rng.integers(0, 1000, 40))
    v = rng.normal(size=len(t))
    q = np.arange(-20, 1020, 7)
    rows = spark.createDataFrame([("a", int(a), float(b)) for a, b in zip(t, v)], "k string, t long, v double")
    got = samples.bracketed(rows, spark.createDataFrame([("a", int(x)) for x in q], "k string, at long"), ["k"], "t", ["v"]).orderBy("at").collect()
    assert np.allclose([r.v for r in got], np.interp(q, t, v))


def test_grid_samples_against_numpy(spark):
    rng = np.random.default_rng(1)
    t = np.cumsum(rng.integers(3, 34, 120))
    lat, lon = 37 + np.cumsum(rng.normal(0, 1e-3, 120)), 127 + np.cumsum(rng.normal(0, 1e-3, 120))
    trk, vel = rng.uniform(0, 360, 120), rng.uniform(50, 200, 120)
    rows = [("s", int(a), float(b), float(c), float(d), float(e), 1000.0, 0.0) for a, b, c, d, e in zip(t, lat, lon, trk, vel)]
    df = spark.createDataFrame(rows, "segment_id string, time_position long, latitude double, longitude double, true_track double, velocity double, baro_altitude double, vertical_rate double")
    got = {r.time_position: r for r in samples.grid_samples(df).collect()}
    north, east = (lat - lat[0]) * 111_320.0, (lon - lon[0]) * 111_320.0 * np.cos(np.radians(lat[0]))
    run = np.concatenate([[0], np.cumsum(np.diff(t) > 30)])
    seen = 0
    for i in range(120):
        own = np.flatnonzero(run == run[i])
        rt, rn, re = t[own], north[own], east[own]
        if t[i] + 10 > rt[-1] or t[i] - 60 < rt[0]:
            assert int(t[i]) not in got
            continue
        seen += 1
        r = got[int(t[i])]
        n = int(min(64, (t[i] - rt[0]) // 10))
        grid = t[i] - 10 * np.arange(n, -1, -1)
        assert r.context == n and np.allclose(r.move_n, np.diff(np.interp(grid, rt, rn))) and np.allclose(r.move_e, np.diff(np.interp(grid, rt, re)))
        assert r.y_north_m == pytest.approx(np.interp(t[i] + 10, rt, rn) - north[i]) and r.move_n_t_minus_2 == pytest.approx(r.move_n[-2])
    assert seen == len(got) > 5


def test_split_keeps_groups_whole(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") % 400).cast("string"))
    got = samples.group_split(df, "g").groupBy("g").agg(F.countDistinct("is_train").alias("n"), F.first("is_train").alias("train")).collect()
    assert all(r.n == 1 for r in got) and 0.7 < sum(r.train for r in got) / 400 < 0.9


def test_pending_predictions(spark):
    p = spark.createDataFrame([("a", 100, 37.0, 127.0, 37.0, 0.0, 0.0, 0.0, 0.0), ("b", 100, 37.0, 127.0, 37.0, 0.0, 0.0, 0.0, 0.0), ("c", 900, 37.0, 127.0, 37.0, 0.0, 0.0, 0.0, 0.0)], "icao24 string, ti long, lat_i double, lon_i double, lat0 double, pred_n double, pred_e double, dr_n double, dr_e double")
    reports = spark.createDataFrame([("a", 95, 37.0, 127.0), ("a", 105, 37.0, 127.0), ("a", 115, 37.001, 127.0), ("c", 890, 37.0, 127.0)], "icao24 string, time_position long, latitude double, longitude double")
    got = {r.icao24: r for r in samples.score_pending(p, reports, F.lit(1000)).collect()}
    assert [got[k].state for k in "abc"] == ["scored", "giveup", "keep"]
    assert got["a"].moved == pytest.approx(0.0005 * 111_320) and got["b"].err_model is None


def test_fingerprint_ignores_order_and_counts_duplicates(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    a, b = aggregates.fingerprint(df).first(), aggregates.fingerprint(df.orderBy(F.rand(1)).repartition(5)).first()
    assert a == b and aggregates.fingerprint(df.union(df.limit(1))).first() != a
    assert tuple(aggregates.fingerprint(df.limit(0)).first()) == (0, 0)


def test_drop_reasons(spark):
    from driftglass.schema import flag_valid

    df = flag_valid(spark.createDataFrame([(None, None, None, None), ("a", 1.0, 2.0, None), (None, 1.0, 2.0, 3), ("a", 1.0, 2.0, 3)], "icao24 string, latitude double, longitude double, timestamp long"))
    assert tuple(aggregates.drop_reasons(df).first()) == (4, 2, 1, 2, 1, 2)
