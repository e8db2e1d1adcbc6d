import json
import urllib.error
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from driftglass.plans import lake, medallion, model, planner
from driftglass.plans.store import Store, work_folder
from driftglass.sources import poll

BRONZE = "icao24 string, callsign string, origin_country string, time_position long, latitude double, longitude double, baro_altitude double, geo_altitude double, velocity double, true_track double, vertical_rate double, squawk string, on_ground boolean, timestamp timestamp, ingested_at timestamp"
DAY = 1_704_067_200  # 2024-01-01


def reports(spark, times, key="a"):
    rows = [(key, "KAL1", "X", t, 37.0 + t % 97 / 1000, 127.0, 1000.0, 1000.0, 100.0, 0.0, 0.0, None, False, s) for t, s in times]
    df = spark.createDataFrame(rows, BRONZE.replace("timestamp timestamp, ingested_at timestamp", "s long"))
    return df.withColumns({"timestamp": F.timestamp_seconds("s"), "ingested_at": F.timestamp_seconds("s")}).drop("s")


@pytest.fixture
def folder(spark, tmp_path):
    return f"file://{tmp_path}"


def test_segment_over_midnight_keeps_one_id(spark, folder):
    mid = DAY + 86_400
    df = reports(spark, [(mid - 600 + 60 * k, mid - 595 + 60 * k) for k in range(20)])
    lake.append_cold(df, f"{folder}/bronze")
    for day in ("2024-01-01", "2024-01-02"):
        assert medallion.silver_date(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/m/s", day, "v1")["status"] == "success"
        assert medallion.gold_date(spark, f"{folder}/silver", f"{folder}/gold", f"{folder}/m/g", day, "v1")["status"] == "success"
    traj = spark.read.parquet(f"{folder}/gold/trajectory")
    assert traj.select("segment_id").distinct().count() == 1
    first = traj.where("event_date = date'2024-01-02'").orderBy("time_position").first()
    assert first.dt_s == 60 and first.dist_m is not None and first.point_idx == 10
    assert lake.completed_dates(spark, f"{folder}/m/g") == {"2024-01-01", "2024-01-02"}
    again = medallion.gold_date(spark, f"{folder}/silver", f"{folder}/gold", f"{folder}/m/g", "2024-01-02", "v1")
    assert again["trajectory"] == 10 and spark.read.parquet(f"{folder}/gold/trajectory").count() == 20


def test_mismatch_stops_before_the_write(spark, folder):
    lake.append_cold(reports(spark, [(DAY, DAY)]), f"{folder}/bronze")
    reports(spark, [(DAY + 90_000, DAY + 90_000)]).write.mode("append").parquet(f"{folder}/bronze/dt=2024-01-01")
    results, code = medallion.run_dates(lambda d: medallion.silver_date(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/m", d, "v1"), ["2024-01-01", "2024-01-09"])
    assert code == 1 and "DateMismatch" in results[0]["error"] and "FileNotFound" in results[1]["error"]
    assert not Store(spark).exists(f"{folder}/silver") and lake.completed_dates(spark, f"{folder}/m") == set()


def test_empty_date_has_no_marker(spark, folder):
    reports(spark, [(DAY, DAY)]).limit(0).write.parquet(f"{folder}/bronze/dt=2024-01-01")
    assert medallion.silver_date(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/m", "2024-01-01", "v1")["status"] == "empty"
    assert lake.completed_dates(spark, f"{folder}/m") == set()


def test_silver_keeps_the_first_received(spark):
    df = reports(spark, [(1, DAY), (1, DAY)]).withColumn("ingested_at", F.timestamp_seconds(F.monotonically_increasing_id() % 2 + DAY + 5))
    assert medallion.to_silver(df, "2024-01-01").count() == 1


@pytest.mark.parametrize("crash", ["manifest", "first move", "moves"])
def test_compaction_recovers(spark, folder, crash):
    df = reports(spark, [(DAY + k, DAY + k) for k in range(300)]).repartition(6)
    df.write.parquet(f"{folder}/b/dt=2024-01-01")
    kw = {"sort": ["icao24", "timestamp"], "target_bytes": 8000}
    try:
        lake.compact(spark, f"{folder}/b", "2024-01-01", stop_after=crash, **kw)
    except lake.Crash:
        assert lake.compact(spark, f"{folder}/b", "2024-01-01", **kw) == ("finished" if crash == "moves" else "merged")
    while lake.compact(spark, f"{folder}/b", "2024-01-01", **kw) == "merged":
        pass
    got = spark.read.parquet(f"{folder}/b/dt=2024-01-01")
    assert got.count() == 300 and sorted(got.columns) == sorted(df.columns)
    assert not Store(spark).exists(f"{folder}/b/_compaction/2024-01-01.json")


@pytest.mark.parametrize("crash", ["manifest", "first move", "moves"])
def test_daily_run_after_a_crashed_compaction(spark, folder, crash):
    """The date of a crashed compaction is compacted by the next daily run, and only then marked."""
    lake.append_cold(reports(spark, [(DAY + k, DAY + k) for k in range(200)]), f"{folder}/bronze")
    for k in range(5):
        lake.append_cold(reports(spark, [(DAY + 300 + k, DAY + 300 + k)]), f"{folder}/bronze")
    try:
        lake.compact(spark, f"{folder}/bronze", "2024-01-01", ["icao24", "timestamp"], target_bytes=8000, stop_after=crash)
    except lake.Crash:
        pass
    paths = [f"{folder}/{x}" for x in ("bronze", "silver", "gold", "markers")]
    out = medallion.run_daily(spark, *paths, "2024-01-02", "v1")
    assert {r["status"] for r in out["merge"]} <= {"merged", "finished", "skipped"}
    assert lake.completed_dates(spark, f"{folder}/markers/merge") == {"2024-01-01"}
    names = [e.name for e in lake.data_files(spark, f"{folder}/bronze/dt=2024-01-01")]
    assert names and all(n.startswith("merged-") for n in names) and lake.read_date(spark, f"{folder}/bronze", "2024-01-01").count() == 205


@pytest.mark.parametrize("crash", ["next", "delete"])
def test_text_survives_a_crash_between_its_steps(spark, folder, crash):
    store, path = Store(spark), f"{folder}/pointer.json"
    assert not store.has_text(path)
    store.write_text(path, "one")
    with pytest.raises(RuntimeError):
        store.write_text(path, "two", stop_after=crash)
    assert store.has_text(path) and store.read_text(path) == ("one" if crash == "next" else "two")
    store.write_text(path, "three")
    assert store.read_text(path) == "three" and not store.exists(f"{path}.next")


def test_a_cluster_needs_a_shared_folder():
    def fake(master, base=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, other=None: base), sparkContext=SimpleNamespace(master=master))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(fake("spark://host:7077"))
    assert work_folder(fake("yarn", "hdfs:///work")).startswith("hdfs:///work/driftglass-")
    assert work_folder(fake("local[2]")).startswith("file://")


def test_run_records_are_added(spark, folder):
    for status in ("failed", "success"):
        assert lake.append_run(spark, f"{folder}/runs", "silver", "2024-01-01", {"status": status})
    got = lake.run_records(spark, f"{folder}/runs").collect()
    assert [(r.stage, r.dt, r.status) for r in got] == [("silver", "2024-01-01", "failed"), ("silver", "2024-01-01", "success")]
    assert lake.run_records(spark, f"{folder}/none").count() == 0
    spark.range(1).write.parquet(f"{folder}/taken")
    assert lake.write_record(spark, f"{folder}/ok.json", {}) is True
    assert lake.write_record(spark, f"{folder}/ok.json/below.json", {}) is False


def test_dates_skip_bad_names(spark, folder):
    for name in ("dt=2024-01-01", "dt=2024-13-01", "dt=x", "other"):
        spark.range(1).write.parquet(f"{folder}/t/{name}")
    assert lake.dates_under(spark, f"{folder}/t") == {"2024-01-01"}


def test_backup_keeps_the_newest(spark, folder):
    spark.range(3).write.parquet(f"{folder}/src")
    for k in range(4):
        kept = lake.backup(spark, f"{folder}/src", f"{folder}/bak", f"b{k}", 2)
    assert kept == ["b2", "b3"] and [e.name for e in Store(spark).list(f"{folder}/bak")] == kept


def dates(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "dt string")


def test_gold_plan(spark):
    bronze = dates(spark, "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-09")
    silver = dates(spark, "2024-01-01", "2024-01-03", "2024-01-05", "2024-01-09")
    got = {r.dt: r.status for r in planner.gold_plan(bronze, silver, dates(spark), "2024-01-09").collect()}
    assert got == {"2024-01-01": "ready", "2024-01-02": "held: not refined", "2024-01-03": "held: day before not refined", "2024-01-05": "ready"}


def test_reprocess_cascade(spark):
    req = spark.createDataFrame([(0, "silver", "2024-01-31"), (1, "gold", "2024-02-01"), (2, "silver", "2024-01-31")], "pos long, stage string, dt string")
    got = [(r.stage, r.dt) for r in planner.reprocess(req).orderBy("pos").collect()]
    assert got == [("silver", "2024-01-31"), ("gold", "2024-01-31"), ("gold", "2024-02-01")]
    assert [(r.stage, r.dt) for r in planner.reprocess(req, False).orderBy("pos").collect()] == [("silver", "2024-01-31"), ("gold", "2024-02-01")]
    excluded = spark.createDataFrame([("gold", "2024-02-01")], "stage string, dt string")
    assert planner.reprocess_allowed(planner.reprocess(req), excluded).count() == 2
    assert planner.reprocess_allowed(planner.reprocess(req), excluded, force=True).count() == 3


@pytest.mark.parametrize(("snapshot", "mark", "want"), [(100, None, "send"), (None, 5, "send"), (100, 100, "repeat"), (99, 100, "older"), (101, 100, "send")])
def test_decisions(snapshot, mark, want):
    assert poll.decide(snapshot, mark) == want


def test_poll_alignment():
    s = poll.PollState()
    wait, s = poll.next_poll("sent", 1000.0, s, 1004.0)
    assert s.offset == pytest.approx(2.9) and wait == pytest.approx(8.9)
    wait, s = poll.next_poll("repeat", None, s, 1012.0)
    assert (wait, s.retried) == (1.5, True) and s.offset == pytest.approx(3.9)
    wait, s = poll.next_poll("repeat", None, s, 1013.5)
    assert not s.retried and wait == pytest.approx(1023.9 - 1013.5)
    wait, _ = poll.next_poll("error", None, poll.PollState(), 5.0)
    assert wait == 10.0
    for now in (1000.0, 1013.4, 2000.7, 5000.0):
        for outcome in ("sent", "repeat", "older", "error"):
            assert 1 <= poll.next_poll(outcome, 1000.0, s, now)[0] <= 15
    low = poll.PollState(offset=0.5)
    assert poll.next_poll("sent", 1.0, low, 1.0)[1].offset == 0.5


def test_poll_watermark_moves_only_after_the_send():
    body = {"time": 7, "states": [["a"]]}
    sent = []
    assert poll.poll(lambda: body, lambda s, v: sent.append(s), 6) == ("sent", 7, None)
    assert poll.poll(lambda: body, lambda s, v: sent.append(s), 7) == ("repeat", 7, None) and sent == [7]

    def refuse(s, v):
        raise type("KafkaTimeoutError", (Exception,), {})()

    assert poll.poll(lambda: body, refuse, 6) == ("error", 6, {"kind": "kafka", "status": None})

    def fail(e):
        def fetch():
            raise e

        return poll.poll(fetch, refuse, 1)[2]

    assert fail(urllib.error.HTTPError("u", 429, "", None, None)) == {"kind": "http", "status": 429}
    assert fail(json.JSONDecodeError("x", "y", 0))["kind"] == "parse"
    assert fail(TimeoutError())["kind"] == "network" and fail(KeyError())["kind"] == "other"


def test_model_guards_and_table_function(spark):
    rows = spark.range(150).select(*[(F.col("id") % (k + 3)).cast("double").alias(c) for k, c in enumerate([*model.FEATURES, "y_north_m", "y_east_m"])])
    with pytest.raises(model.TooFewRows):
        model.train(rows.limit(99))
    got = model.predict(model.train(rows, trees=2), rows)
    assert got.count() == 150 and {"north_m", "east_m"} <= set(got.columns)

    class Twice:
        def predict(self, x):
            return 2 * x[["velocity", "track_sin"]].to_numpy()

    r = model.as_table_function(rows, Twice(), ["track_sin", "velocity"]).first()
    assert r.north_m == 2 * r.velocity


def test_champion_is_scored_on_the_same_rows(spark):
    rows = spark.range(150).select(*[(F.col("id") % (k + 3)).cast("double").alias(c) for k, c in enumerate([*model.FEATURES, "y_north_m", "y_east_m"])])
    good, poor = model.train(rows, trees=5), model.train(rows.withColumn("y_north_m", F.lit(500.0)), trees=1)
    first = model.judged(good, None, rows, 3.0).first()
    assert first.n == 150 and first.champion_hit_pct is None and first.reason in ("first champion", "not above baseline")
    same = model.judged(good, good, rows, 3.0).first()
    assert same.champion_hit_pct == same.model_hit_pct and not same.promoted
    assert model.judged(good, poor, rows, 3.0).first().champion_hit_pct != same.champion_hit_pct
    other = model.train(rows.withColumn("extra", F.col("dr_north_m")), features=["extra", "dr_north_m", "dr_east_m"], trees=1)
    assert model.judged(good, other, rows.drop("extra"), 3.0).first().champion_hit_pct is None
    with pytest.raises(model.TooFewRows):
        model.train(rows, trees=1, task="compare_10s")


def test_gold_of_a_date_without_flights(spark, folder):
    lake.append_cold(reports(spark, [(DAY + 5, DAY + 6)]).withColumn("on_ground", F.lit(True)), f"{folder}/bronze")
    medallion.silver_date(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/m/s", "2024-01-01", "v1")
    got = medallion.gold_date(spark, f"{folder}/silver", f"{folder}/gold", f"{folder}/m/g", "2024-01-01", "v1")
    assert (got["status"], got["trajectory"], got["aircraft_daily"], got["traffic_hourly"]) == ("success", 0, 1, 1)
    assert medallion.gold_date(spark, f"{folder}/silver", f"{folder}/gold", f"{folder}/m/g", "2024-01-02", "v1")["status"] == "empty"


def test_daily_run_catches_up(spark, folder, capsys):
    from driftglass.__main__ import main

    for d in range(3):
        lake.append_cold(reports(spark, [(DAY + 86_400 * d + 60 * k, DAY + 86_400 * d + 60 * k + 1) for k in range(5)]).repartition(2), f"{folder}/bronze")
        lake.append_cold(reports(spark, [(DAY + 86_400 * d + 4000, DAY + 86_400 * d + 4001)], "b"), f"{folder}/bronze")
    paths = [f"{folder}/{x}" for x in ("bronze", "silver", "gold", "markers")]
    first = medallion.run_daily(spark, *paths, "2024-01-03", "v1")
    assert [r["date"] for r in first["silver"]] == [r["date"] for r in first["gold"]] == [r["date"] for r in first["merge"]] == ["2024-01-01", "2024-01-02"]
    assert {r["status"] for r in first["merge"]} == {"merged"}
    again = medallion.run_daily(spark, *paths, "2024-01-04", "v1")
    assert [len(again[k]) for k in ("silver", "gold", "merge")] == [1, 1, 1]
    assert main(["counts", "--lake", folder]) == 0 and '"n_rows": 18' in capsys.readouterr().out
    assert main(["reprocess", "--lake", folder, "--date", "2024-01-02"]) == 0 and capsys.readouterr().out.count("gold") == 2
    assert main(["gold", "--lake", folder, "--date", "2024-01-02", "2030-01-01"]) == 0


def test_report(spark, tmp_path):
    from driftglass.plans import reports as r

    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps({"run_id": f"r{k}", "model": "m", "version": k, "started": f"2024-01-0{3 - k}T00:00:00Z", "metrics": {"p50": 10.0 - k}, "promoted": k == 1, "reason": "x"}))
    (tmp_path / "bad.json").write_text("{nope")
    runs = r.read_runs(spark, f"file://{tmp_path}")
    body = json.loads(r.export_report(runs, spark.createDataFrame([("m", 1)], "model string, champion long")).first().report)
    assert body["n_runs"] == 3 and [x["run_id"] for x in body["runs"]] == ["r2", "r1", "r0"] and [x["is_champion"] for x in body["runs"]] == [False, True, False]
    assert [x.run_id for x in r.ranked(runs, "p50").collect()] == ["r2", "r1", "r0"]


def test_batches_of_dates_equal_single_dates(spark, folder):
    """Three dates at once give what they give one by one; a date without folder, with a foreign row or without rows stands alone."""
    from driftglass.catalog import lakehouse

    bronze = lakehouse._bronze(spark, "/root/testdata/sf0.001", folder, 2)
    days = ["2024-01-03", "2024-01-04", "2024-01-05"]
    lake.read_date(spark, bronze, "2024-01-05").write.parquet(f"{bronze}/dt=2024-02-01")
    lake.read_date(spark, bronze, "2024-01-05").where("false").write.parquet(f"{bronze}/dt=2024-02-02")
    for day in days:
        medallion.silver_date(spark, bronze, f"{folder}/s1", f"{folder}/m1", day, "v1")
    one = [medallion.gold_date(spark, f"{folder}/s1", f"{folder}/g1", f"{folder}/m1", day, "v1", 21_600) for day in days]
    others = ["2024-02-01", "2024-02-02", "2030-01-01"]
    silver, code = medallion.run_batches(lambda d: medallion.silver_dates(spark, bronze, f"{folder}/s2", f"{folder}/m2", d, "v1"), [days + others])
    assert [r["status"] for r in silver] == ["success"] * 3 + ["failed", "empty", "failed"] and code == 1
    assert "DateMismatch" in silver[3]["error"] and "FileNotFoundError" in silver[5]["error"] and lake.completed_dates(spark, f"{folder}/m2") == set(days)
    gold, code = medallion.run_batches(lambda d: medallion.gold_dates(spark, f"{folder}/s2", f"{folder}/g2", f"{folder}/m2", d, "v1", 21_600), [days + others])
    assert gold[:3] == one and [r["status"] for r in gold[3:]] == ["empty"] * 3 and code == 0
    for a, b in [("s1", "s2")] + [(f"g1/{t}", f"g2/{t}") for t in ("trajectory", "aircraft_daily", "traffic_hourly")]:
        a, b = lake.read_table(spark, f"{folder}/{a}"), lake.read_table(spark, f"{folder}/{b}")
        assert sorted(a.columns) == sorted(b.columns)
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect()))


def test_medallion_run_takes_few_jobs(spark):
    """Thirty dates: jobs by the batch, not by the date."""
    from driftglass.catalog import lakehouse

    spark.sparkContext.setJobGroup("medallion", "")
    try:
        assert len(lakehouse.medallion_run(spark, "/root/testdata/sf0.001").collect()) == 30
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("medallion")) < 60
