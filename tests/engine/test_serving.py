import math

import pytest
from pyspark.sql import functions as F

from driftglass.operators import evaluate, quantiles, samples
from driftglass.plans import adhoc
from driftglass.streaming import serving

COLUMNS = "icao24 string, time_position long, latitude double, longitude double, velocity double, true_track double, baro_altitude double, vertical_rate double, on_ground boolean"


def flight(key, start, n, every=10, v=100.0):
    """North-bound reports at constant speed."""
    return [(key, start + every * k, 37.0 + v * every * k / 111_320.0, 127.0, v, 0.0, 1000.0 + k, 0.0, False) for k in range(n)]


def loop(spark, folder, champion, **options):
    return serving.Serving(spark, folder, champion, window_s=100, **options)


def off_by(metres):
    return lambda df: df.withColumns({"pred_n": F.col("dr_n") + metres, "pred_e": F.col("dr_e")})


def test_predictions_are_scored_or_given_up(spark, tmp_path):
    versions = [None]
    s = loop(spark, f"file://{tmp_path}", lambda: versions[0])
    rows = flight("a", 1000, 12) + flight("b", 1000, 9)  # b falls silent
    live = lambda now: spark.createDataFrame([r for r in rows if r[1] <= now], COLUMNS)
    assert s.cycle(live(1090), 1090) == {"status": "waiting_for_champion"}
    versions[0] = (1, off_by(30.0))
    first = s.cycle(live(1090), 1090)
    assert (first["pending"], first["scored"], first["closed"]) == (2, 0, None)
    second = s.cycle(live(1095), 1095)
    assert (second["pending"], second["scored"]) == (2, 0)  # nothing new is predicted twice
    third = s.cycle(live(1102), 1102)
    assert (third["scored"], third["pending"], third["closed"]) == (1, 2, 1000)  # a's truth came, and a was predicted anew
    versions[0] = (2, off_by(60.0))
    assert s.cycle(live(1112), 1112)["version"] == 1  # not within the window
    last = s.cycle(live(1215), 1215)
    assert last["closed"] == 1100 and last["version"] == 2 and s.notes == ["champion v1 -> v2"]
    assert last["unscorable"] == 1
    w = {r.version: r for r in s.windows().collect()}
    assert w[1].scored == 2 and w[1].model_p50_m == pytest.approx(30.0, abs=0.1) and w[1].baseline_p50_m == pytest.approx(0.0, abs=0.1) and w[1].model_hit_50m_pct == 100.0


def test_a_killed_cycle_is_done_again(spark, tmp_path, monkeypatch):
    s = loop(spark, f"file://{tmp_path}", lambda: (1, serving.dead_reckoning_predictor))
    rows = spark.createDataFrame(flight("a", 1000, 10), COLUMNS)
    s.cycle(rows, 1092)
    before = s.pointer()
    monkeypatch.setattr(s.store, "write_json", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        s.cycle(spark.createDataFrame(flight("a", 1000, 11), COLUMNS), 1104)
    again = loop(spark, f"file://{tmp_path}", lambda: (1, serving.dead_reckoning_predictor))
    assert again.pointer() == before
    got = again.cycle(spark.createDataFrame(flight("a", 1000, 11), COLUMNS), 1104)
    assert got["scored"] == 1 and got["pending"] == 1


def test_rolling_drift_takes_the_span(spark):
    rows = [(end, f"o{k}", float(k + (100 if end < 500 else 0)), float(k)) for end in (100, 600, 900) for k in range(60)]
    windows = spark.createDataFrame(rows, "window_end long, icao24 string, velocity double, baro_altitude double")
    reference = spark.createDataFrame([(f"o{k}", float(k), float(k)) for k in range(60)], "icao24 string, velocity double, baro_altitude double")
    ask = lambda now, span: evaluate.rolling_drift(reference, windows, ["velocity", "baro_altitude"], F.lit(now), span, 50).first()
    assert ask(1000, 450).status == "stable" and ask(150, 450).status == "shifted" and ask(5000, 10).status == "insufficient"


@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles_are_the_same_by_either_way(spark, by):
    rows = [(None if k % 7 == 0 else "ab"[k % 2], None if k % 11 == 0 else float(k * 37 % 101)) for k in range(900)] + [("none", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    ask = lambda few: sorted(map(str, quantiles.quantiles(df, by, {"q": F.col("v"), "w": 100 - F.col("v")}, [0, 0.1, 0.5, 0.9, 1.0], few).collect()))
    assert quantiles._few(df, 10) is False
    assert ask(10) == ask(10**9)
    if not by:
        v = sorted(x for _, x in rows if x is not None)
        assert quantiles.quantiles(df, [], {"q": F.col("v")}, [0.5], 10).first().q == [pytest.approx((v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2)]


def test_reports_by_ranks(spark):
    rows = [(f"m{k % 3}", abs(math.sin(k)) * 200, 1.0 + k % 9) for k in range(500)]
    df = spark.createDataFrame(rows, "method string, err double, actual double").repartition(4)
    assert sorted(evaluate.error_summary(df, ["method"], few=10).collect()) == sorted(evaluate.error_summary(df, ["method"]).collect())
    traj = spark.createDataFrame([(10, 100.0 * k, float(k), float(k % 50)) for k in range(200)], "dt_s long, baro_altitude double, calc_speed_mps double, velocity double")
    assert sorted(adhoc.band_speeds(traj, 60, few=10).collect()) == sorted(adhoc.band_speeds(traj, 60).collect())


def test_as_of_holds_beyond_the_ends(spark):
    rows = spark.createDataFrame([("a", 10, 1.0), ("a", 20, 3.0), ("b", 5, 7.0)], "k string, t long, v double")
    asked = spark.createDataFrame([("a", 0, "x"), ("a", 15, "y"), ("a", 20, "z"), ("a", 99, "w"), ("b", 5, "u"), ("c", 1, "n")], "k string, at long, tag string")
    got = {r.tag: r.v for r in samples.bracketed(rows, asked, ["k"], "t", ["v"]).collect()}
    assert got == {"x": 1.0, "y": 2.0, "z": 3.0, "w": 3.0, "u": 7.0, "n": None}
