"""Native streaming forms: sessions, tumbling windows, dedup, keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions(df: DataFrame, ts: str, key: str, gap_s: int, delay: str) -> DataFrame:
    """Gap sessions; a gap of exactly ``gap_s`` does not split."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(key, F.session_window(ts, f"{gap_s} seconds").alias("s"))
        .agg(F.count("*").alias("n_points"))
        .select(key, F.unix_timestamp("s.start").alias("seg_start"), "n_points")
    )


def tumbling(df: DataFrame, ts: str, width: str, delay: str, *aggregates: Column) -> DataFrame:
    return df.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w")).agg(*aggregates).select(F.unix_timestamp("w.start").alias("window_start"), F.col("*")).drop("w")


def first_reports(df: DataFrame, ts: str, delay: str, keys: list[str]) -> DataFrame:
    """One row per key within the watermark, whatever its replays."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


LATEST = "icao24 string, event_id long, snap_epoch long"


def _latest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    best = state.get if state.exists else None
    for frame in frames:
        # the newest snapshot of the frame; within one snapshot the lesser event
        snap = int(frame["snap_epoch"].max())
        event = int(frame.loc[frame["snap_epoch"] == snap, "event_id"].min())
        if best is None or snap > best[1] or (snap == best[1] and event < best[0]):
            best = (event, snap)
    state.update(best)
    yield pd.DataFrame({"icao24": [key[0]], "event_id": [best[0]], "snap_epoch": [best[1]]})


def latest_state(df: DataFrame) -> DataFrame:
    """Newest report per object as keyed state: late and repeated reports change nothing. Update mode."""
    return df.groupBy("icao24").applyInPandasWithState(_latest, LATEST, "event_id long, snap_epoch long", "update", GroupStateTimeout.NoTimeout)


DECISION = "source string, snapshot long, decision string"


def _decide(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    frame = pd.concat(list(frames)).sort_values("seq")
    snap = frame["snapshot"].to_numpy(np.int64)
    # the newest snapshot before each one: a running maximum, shifted, that begins with the state
    first = state.get[0] if state.exists else np.iinfo(np.int64).min
    before = np.maximum.accumulate(np.concatenate([[first], snap]))
    out = np.select([snap > before[:-1], snap == before[:-1]], ["send", "repeat"], "older")
    state.update((int(before[-1]),))
    yield pd.DataFrame({"source": key[0], "snapshot": snap, "decision": out})


def decisions(df: DataFrame) -> DataFrame:
    """send, repeat or older for every snapshot of a source, in sequence. ``df`` has source, seq and snapshot."""
    return df.groupBy("source").applyInPandasWithState(_decide, DECISION, "newest long", "append", GroupStateTimeout.NoTimeout)


def truths(predictions: DataFrame, reports: DataFrame, step_s: int, giveup_s: int, delay: str) -> DataFrame:
    """Stream-stream join of predictions (icao24, made) with reports (icao24, seen) up to the give-up time; a prediction
    without one comes out with nulls once the watermark has passed."""
    p = predictions.withWatermark("made", delay).alias("p")
    r = reports.withWatermark("seen", delay).alias("r")
    span = (F.col("r.seen") >= F.col("p.made") + F.expr(f"INTERVAL {step_s} SECONDS")) & (F.col("r.seen") <= F.col("p.made") + F.expr(f"INTERVAL {step_s + giveup_s} SECONDS"))
    return p.join(r, (F.col("p.icao24") == F.col("r.icao24")) & span, "leftOuter")
