"""The serving loop: predict, wait for the truth, score, give up, and close windows.

A cycle reads the live reports and leaves its state as versioned folders behind one pointer file, so it can be killed at
any time: what the pointer names is whole, and a cycle that was cut short is done again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftglass.functions import geo
from driftglass.operators import evaluate, live, samples, segments
from driftglass.plans.store import Store

PENDING = "icao24 string, ti long, lat_i double, lon_i double, lat0 double, pred_n double, pred_e double, dr_n double, dr_e double, velocity double, baro_altitude double, version long"
LAST = "icao24 string, last_ti long"

#: A model: adds pred_n and pred_e (metres in ``step`` seconds) to origins.
Predictor = Callable[[DataFrame], DataFrame]


class Serving:
    """One model's loop. ``champion`` gives (version, predictor), or None while there is none; it is asked before the first
    cycle and again whenever a window closes, so a new champion serves from the next window on."""

    def __init__(self, spark: SparkSession, folder: str, champion: Callable[[], tuple[int, Predictor] | None], step: int = 10, giveup_s: int = 120, fresh_s: int = 60, context_s: int = 60, gap: float = 30, window_s: int = 300, lookback_s: int = 900):
        self.spark, self.folder, self.store, self.ask = spark, folder, Store(spark), champion
        self.step, self.giveup_s, self.fresh_s, self.context_s, self.gap = step, giveup_s, fresh_s, context_s, gap
        self.window_s, self.lookback_s, self.current, self.notes = window_s, lookback_s, None, []

    def pointer(self) -> dict:
        path = f"{self.folder}/pointer.json"
        return self.store.read_json(path) if self.store.has_text(path) else {"cycle": -1, "window": None, "parts": [], "pending": None, "last": None}

    def _read(self, path: str | None, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path) if path else self.spark.createDataFrame([], schema)

    def reload(self) -> bool:
        """Take the champion there is now; whether there is one."""
        found = self.ask()
        if found and self.current and found[0] != self.current[0]:
            self.notes.append(f"champion v{self.current[0]} -> v{found[0]}")
        self.current = found or self.current
        return self.current is not None

    def origins(self, runs: DataFrame, last: DataFrame, now: int) -> DataFrame:
        """Objects to predict for, with dead reckoning and where their run began."""
        rows = live.eligible(runs, last, F.lit(now), self.fresh_s, self.context_s)
        first = runs.groupBy("icao24").agg(F.min_by("latitude", "time_position").alias("lat0"))
        north, east = geo.dead_reckoning(F.col("velocity"), F.col("true_track"), F.lit(self.step))
        return rows.join(first, "icao24").select(
            "icao24", F.col("time_position").alias("ti"), F.col("latitude").alias("lat_i"), F.col("longitude").alias("lon_i"), "lat0",
            north.alias("dr_n"), east.alias("dr_e"), "velocity", "true_track", "baro_altitude", "vertical_rate",
        )

    def cycle(self, reports: DataFrame, now: int) -> dict:
        """Score what is pending against ``reports``, predict for what is new, close the window if its time is over."""
        if self.current is None and not self.reload():
            return {"status": "waiting_for_champion"}
        p = self.pointer()
        k, window = p["cycle"] + 1, now // self.window_s * self.window_s
        closed, done = None, []
        if p["window"] is not None and window > p["window"]:
            closed, done = self._close(p), p["parts"]
            self.reload()
            p = {**p, "parts": []}
        version, predictor = self.current
        seen = reports.where((F.col("time_position") >= now - self.lookback_s) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        runs = segments.last_runs(seen, gap=self.gap).persist()
        try:
            pending = self._read(p["pending"], PENDING)
            scored = samples.score_pending(pending, runs, F.lit(now), self.step, self.giveup_s)
            part = f"{self.folder}/scored/{k}"
            scored.write.mode("overwrite").parquet(part)
            scored = self.spark.read.parquet(part)
            last = self._read(p["last"], LAST)
            made = predictor(self.origins(runs, last, now)).withColumn("version", F.lit(version).cast("long"))
            names = [c.split()[0] for c in PENDING.split(", ")]
            kept = scored.where("state = 'keep'").select(names).unionByName(made.select(names))
            kept.write.mode("overwrite").parquet(f"{self.folder}/pending/{k}")
            newest = last.unionByName(made.select("icao24", F.col("ti").alias("last_ti"))).groupBy("icao24").agg(F.max("last_ti").alias("last_ti"))
            newest.write.mode("overwrite").parquet(f"{self.folder}/last/{k}")
        finally:
            runs.unpersist()
        new = {"cycle": k, "window": window, "parts": [*p["parts"], part], "pending": f"{self.folder}/pending/{k}", "last": f"{self.folder}/last/{k}", "version": version}
        self.store.write_json(f"{self.folder}/pointer.json", new)
        # only now: a cycle that was killed before reads them again
        for old in (p["pending"], p["last"], *done):
            if old:
                self.store.delete(old)
        counts = {r.state: r["count"] for r in scored.groupBy("state").count().collect()}  # three rows
        return {"status": "running", "cycle": k, "pending": self.spark.read.parquet(new["pending"]).count(), "scored": counts.get("scored", 0), "unscorable": counts.get("giveup", 0), "closed": closed, "version": version}

    def _close(self, p: dict) -> int:
        """Store the window's summaries and its objects' medians. Its start."""
        done = self.spark.read.parquet(*p["parts"]).where("state != 'keep'").withColumn("_window", F.lit(p["window"]))
        summary = evaluate.close_windows(done, "_window", self.window_s)
        summary.withColumn("version", F.lit(p["version"]).cast("long")).write.mode("overwrite").parquet(f"{self.folder}/windows/start={p['window']}")
        medians = evaluate.window_medians(done, "_window", self.window_s, ["velocity", "baro_altitude"])
        medians.write.mode("overwrite").parquet(f"{self.folder}/medians/start={p['window']}")
        return p["window"]

    def windows(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.folder}/windows").drop("start")

    def drift(self, reference: DataFrame, now: int, span_s: float = 21_600, least_objects: int = 200) -> DataFrame:
        """The drift verdict over the windows closed in the last ``span_s`` seconds."""
        medians = self.spark.read.parquet(f"{self.folder}/medians").drop("start")
        return evaluate.rolling_drift(reference, medians, ["velocity", "baro_altitude"], F.lit(now), span_s, least_objects)


def dead_reckoning_predictor(origins: DataFrame) -> DataFrame:
    """The baseline as a model."""
    return origins.withColumns({"pred_n": F.col("dr_n"), "pred_e": F.col("dr_e")})
