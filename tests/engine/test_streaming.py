import json

import pytest
from pyspark.sql import functions as F

from driftglass import schema
from driftglass.catalog import streams
from driftglass.catalog.states import states
from driftglass.operators import dedup
from driftglass.sources.poll import SnapshotSource
from driftglass.sources.streams import file_stream
from driftglass.streaming import progress, sinks

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("files", [1, 4])
def test_hot_sink_equals_batch(spark, tmp_path, files):
    folder = f"file://{tmp_path}"
    notified = []
    sink = sinks.HotSink(spark, f"{folder}/hot", "snap_epoch", ties=["event_id"], keep_s=86_400, notify=notified.append)
    sinks.start(streams.feed(spark, SF, folder, files), sink.write, f"{folder}/cp").awaitTermination()
    want = dedup.last_per(states(spark, SF).where("latitude is not null"), ["icao24"], ["snap_epoch", -F.col("event_id")])
    pick = lambda df: sorted((r.icao24, r.event_id, r.snap_epoch) for r in df.collect())
    assert pick(sink.latest()) == pick(want) and notified == list(range(files))
    assert sum(r["total"] for r in sink.reasons) == states(spark, SF).count()
    before = (pick(sink.latest()), sink.history().count())
    sink.write(states(spark, SF).limit(50), files - 1)  # a replayed batch
    assert (pick(sink.latest()), sink.history().count()) == before
    newest = sink.history().agg(F.max("snap_epoch")).first()[0]
    assert 0 < sink.vacuum(newest) < before[1] and sink.history().agg(F.min("snap_epoch")).first()[0] >= newest - 86_400


def batch_of(spark, rows):
    """(icao24, event time, snapshot) as valid reports."""
    df = spark.createDataFrame(rows, "icao24 string, time_position long, snap_epoch long")
    return df.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0), "event_id": F.monotonically_increasing_id()})


def test_readers_of_the_last_pointer_keep_their_files(spark, tmp_path):
    sink = sinks.HotSink(spark, f"file://{tmp_path}/hot", "snap_epoch", ties=["event_id"], keep_s=100)
    sink.write(batch_of(spark, [("a", 1, 1), ("b", 1, 1)]), 0)
    old_latest, old_history = sink.latest(), sink.history()
    sink.write(batch_of(spark, [("a", 900, 900)]), 1)  # the first part leaves the history with this batch
    assert old_latest.count() == 2 and old_history.count() == 2 and sink.history().count() == 1
    sink.write(batch_of(spark, [("a", 901, 901)]), 2)
    assert sink.latest().count() == 2 and sink.history().count() == 2 and not sink.store.exists(f"file://{tmp_path}/hot/history/0")


def test_history_reads_only_parts_that_can_hold_a_report(spark, tmp_path):
    sink = sinks.HotSink(spark, f"file://{tmp_path}/hot", "snap_epoch", ties=["event_id"], most_parts=4)
    for k in range(4):
        sink.write(batch_of(spark, [("a", 100 * k, 100 * k), ("a", 100 * k + 5, 100 * k)]), k)
    sink.store.delete(f"file://{tmp_path}/hot/history/0")  # not read again: its times are far off
    parts = sink.pointer()["history"]
    sink.store.write_json(f"{sink.folder}/pointer.json", {**sink.pointer(), "history": parts[1:]})
    sink.write(batch_of(spark, [("a", 205, 500), ("a", 301, 500)]), 9)  # 205 is a repeat out of order
    assert sorted(r.time_position for r in sink.history().collect()) == [100, 105, 200, 205, 300, 301, 305]
    assert len(sink.pointer()["history"]) == 4
    sink.write(batch_of(spark, [("b", 1, 501)]), 10)
    assert len(sink.pointer()["history"]) == 1 and sink.history().count() == 8


@pytest.mark.parametrize("crash", ["next", "delete"])
def test_pointer_survives_a_crash(spark, tmp_path, crash, monkeypatch):
    sink = sinks.HotSink(spark, f"file://{tmp_path}/hot", "snap_epoch", ties=["event_id"], waits=())
    sink.write(batch_of(spark, [("a", 1, 1)]), 0)
    whole = sink.store.write_text
    monkeypatch.setattr(sink.store, "write_text", lambda path, text: whole(path, text, crash if path.endswith("pointer.json") else ""))
    with pytest.raises(RuntimeError):
        sink.write(batch_of(spark, [("b", 2, 2)]), 1)
    again = sinks.HotSink(spark, sink.folder, "snap_epoch", ties=["event_id"])
    assert again.latest().count() == (1 if crash == "next" else 2)
    again.write(batch_of(spark, [("b", 2, 2)]), 1)  # the replay
    assert again.latest().count() == 2 and again.history().count() == 2


def test_retention_runs_when_due(spark, tmp_path):
    now = [1000.0]
    sink = sinks.HotSink(spark, f"file://{tmp_path}/hot", "snap_epoch", ties=["event_id"], keep_s=2100, latest_keep_s=1800)
    job = sinks.Retention(sink, 600, lambda: now[0])
    assert job.due() == 0  # nothing written yet
    sink.write(batch_of(spark, [("a", 100, 100), ("b", 1500, 1500)]), 0)
    now[0] = 1200.0
    assert job.due() is None
    now[0] = 2250.0
    assert job.due() == 1 and [r.icao24 for r in sink.latest().collect()] == ["b"]
    sink.write(batch_of(spark, [("a", 2300, 2300)]), 1)
    assert sink.latest().count() == 2 and sink.history().count() == 2


def test_supervise_tells_the_error(spark, tmp_path):
    folder = f"file://{tmp_path}"
    assert sinks.fresh_checkpoint(spark, f"{folder}/cp")

    def fail(df, k):
        raise ValueError("broken sink")

    good = sinks.start(spark.readStream.format("rate").load(), lambda df, k: None, f"{folder}/cp2", "1 second")
    bad = sinks.start(streams.feed(spark, SF, folder), fail, f"{folder}/cp", "0 seconds")
    try:
        assert "broken sink" in sinks.supervise([good, bad], 60, 0.1)
        assert sinks.supervise([good], 0.3, 0.1) is None
    finally:
        good.stop()
    assert sinks.supervise([good], 5, 0.1) is None
    spark.range(3).write.parquet(f"{folder}/in")
    done = sinks.start(file_stream(spark, f"{folder}/in", "id long"), lambda df, k: None, f"{folder}/cp3")
    done.awaitTermination()
    assert not sinks.fresh_checkpoint(spark, f"{folder}/cp3")


def test_retry_reports_and_gives_up():
    tries, log = [], []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("no")

    assert sinks.retrying(work, (1, 2, 4), sleep=log.append) == 3 and log == [1, 2]
    seen = []
    with pytest.raises(ZeroDivisionError):
        sinks.retrying(lambda: 1 / 0, (1, 2), sleep=lambda s: None, report=lambda ok, n: seen.append((ok, n)))
    assert seen == [(False, 1), (False, 2), (False, 3)]


def test_snapshot_source(spark, tmp_path):
    vector = ["abc123", "KAL123  ", "Nowhere", 1700000000, 1700000000, 127.0, 37.0, 10000.0, False, 250.0, 90.0, 0.0, None, 10500.0, "1234", False, 0]
    (tmp_path / "in").mkdir()
    for k in range(5):
        (tmp_path / "in" / f"{k:03d}.json").write_text(json.dumps({"time": 1700000000 + 10 * k, "states": [vector, vector[:3]]}))
    (tmp_path / "in" / "005.json").write_text(json.dumps({"time": 1, "states": None}))
    spark.dataSource.register(SnapshotSource)
    raw = spark.readStream.format("snapshots").option("maxFilesPerTrigger", 2).load(str(tmp_path / "in"))
    rows = raw.select(*schema.record_from_vector(F.col("vector"), F.col("snapshot"), F.lit(0.0)))
    out = []
    q = rows.writeStream.foreachBatch(lambda df, k: out.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="0 seconds").start()
    try:
        for _ in range(100):
            q.awaitTermination(0.2)
            if len(out) == 10:
                break
    finally:
        q.stop()
    assert len(out) == 10 and {r.timestamp for r in out} == {1700000000 + 10 * k for k in range(5)}
    full = [r for r in out if r.latitude is not None]
    assert len(full) == 5 and full[0].callsign == "KAL123" and full[0].velocity == 250.0 and full[0].on_ground is False and full[0].position_source == 0


def test_recorded_snapshots_are_replayed(spark, tmp_path):
    from driftglass.sources import poll

    folder = str(tmp_path / "rec")
    bodies = iter([{"time": 20, "states": [["a", 1]]}, {"time": 20, "states": []}, {"time": 100, "states": [["b", None], ["c", 2.5]]}, {"time": 100, "states": None}])
    send, mark, outcomes = poll.file_sender(folder), None, []
    for _ in range(4):
        what, mark, _ = poll.poll(lambda: next(bodies), send, mark)
        outcomes.append(what)
    assert outcomes == ["sent", "repeat", "sent", "repeat"] and mark == 100
    spark.dataSource.register(SnapshotSource)
    out = []
    q = spark.readStream.format("snapshots").load(folder).writeStream.foreachBatch(lambda df, k: out.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="0 seconds").start()
    try:
        for _ in range(100):
            q.awaitTermination(0.2)
            if len(out) == 3:
                break
    finally:
        q.stop()
    assert [(r.snapshot, r.vector) for r in out] == [(20, ["a", "1"]), (100, ["b", None]), (100, ["c", "2.5"])]


def test_progress_gaps_and_skips(spark):
    rows = spark.createDataFrame([("r", 0), ("r", 1), ("r", 4), ("s", 7)], "run string, batch_id long")
    assert sorted(map(tuple, progress.gaps(rows).collect())) == [("r", 2), ("r", 3)]
    p = {"sources": [{"startOffset": {"t": {"0": 5, "1": 5}}, "endOffset": {"t": {"0": 25, "1": 10}}, "numInputRows": 20}]}
    assert progress.skipped_rows(p, False) == 5 and progress.skipped_rows(p, True) == 0
    assert progress.skipped_rows({"sources": [{"startOffset": None, "endOffset": {"logOffset": 3}, "numInputRows": 2}]}, False) == 0


def test_predictions_meet_their_truth_or_expire(spark, tmp_path):
    from driftglass.streaming import native

    ts = F.timestamp_seconds
    spark.createDataFrame([("a", 100), ("b", 100), ("c", 5000)], "icao24 string, t long").select("icao24", ts("t").alias("made")).write.parquet(f"{tmp_path}/p")
    spark.createDataFrame([("a", 112), ("b", 400), ("c", 5010), ("z", 9000)], "icao24 string, t long").select("icao24", ts("t").alias("seen")).write.parquet(f"{tmp_path}/r")
    spark.createDataFrame([("y", 9000)], "icao24 string, t long").select("icao24", ts("t").alias("made")).write.mode("append").parquet(f"{tmp_path}/p")
    p = file_stream(spark, f"{tmp_path}/p", "icao24 string, made timestamp", 50)
    r = file_stream(spark, f"{tmp_path}/r", "icao24 string, seen timestamp", 50)
    out = []
    q = native.truths(p, r, 10, 120, "10 seconds").writeStream.foreachBatch(lambda df, k: out.extend(df.toDF("icao24", "made", "icao24_r", "seen").collect())).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(x.icao24, x.seen is not None) for x in out} == {("a", True), ("b", False), ("c", True)}
