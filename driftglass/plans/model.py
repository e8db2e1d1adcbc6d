"""Displacement models: training, the model as a table function, the champion registry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftglass.functions import geo
from driftglass.operators import evaluate

#: Inputs of the next-report model (fixed values).
FEATURES = [
    "latitude",
    "longitude",
    "baro_altitude",
    "geo_altitude",
    "velocity",
    "track_sin",
    "track_cos",
    "vertical_rate",
    "dt_s",
    "calc_speed_mps",
    "heading_change_deg",
    "alt_change_m",
    "velocity_change_mps",
    "next_dt_s",
    "dr_north_m",
    "dr_east_m",
]
#: Inputs of the model of one step ahead on the grid.
GRID_FEATURES = [
    *(f"move_{a}_t_minus_{k}" for k in (1, 2, 3) for a in ("n", "e")),
    "velocity",
    "track_sin",
    "track_cos",
    "baro_altitude",
    "vertical_rate",
    "heading_change_deg",
    "velocity_change_mps",
    "dr_north_m",
    "dr_east_m",
]
#: Rows below which a task isn't trained.
LEAST_ROWS = {"next_report": 100, "compare_10s": 500}


class TooFewRows(ValueError):
    pass


def train(df: DataFrame, features: list[str] | None = None, least: int | None = None, trees: int = 300, rate: float = 0.05, seed: int = 42, task: str = "next_report") -> dict[str, PipelineModel]:
    """Two boosted regressors, north and east, on the residual to dead reckoning. Below ``least`` rows (by default the
    task's) there is none."""
    features = features or FEATURES
    least = LEAST_ROWS[task] if least is None else least
    if df.limit(least).count() < least:
        raise TooFewRows(f"{task}: fewer than {least} rows")
    rows = df.fillna(0.0, features).withColumns({"north": F.col("y_north_m") - F.col("dr_north_m"), "east": F.col("y_east_m") - F.col("dr_east_m")})
    rows = rows.select(*features, "north", "east").persist()  # each tree reads them
    assemble = VectorAssembler(inputCols=features, outputCol="x", handleInvalid="keep")
    try:
        return {t: Pipeline(stages=[assemble, GBTRegressor(featuresCol="x", labelCol=t, predictionCol=f"p_{t}", maxIter=trees, stepSize=rate, maxDepth=4, seed=seed)]).fit(rows) for t in ("north", "east")}
    finally:
        rows.unpersist()


def predict(models: dict[str, PipelineModel], df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Add north_m and east_m."""
    out = df.fillna(0.0, features or FEATURES)
    for t, base in (("north", "dr_north_m"), ("east", "dr_east_m")):
        out = models[t].transform(out).drop("x").withColumn(f"{t}_m", F.col(f"p_{t}") + F.col(base)).drop(f"p_{t}")
    return out


def judged(candidate: dict[str, PipelineModel], champion: dict[str, PipelineModel] | None, test: DataFrame, threshold_m: float = 100.0, features: list[str] | None = None) -> DataFrame:
    """One row: hit rates and medians of the candidate, dead reckoning and the champion, all on the same test rows, and the
    gate's verdict. A champion that needs other inputs is not compared."""
    err = lambda n, e: geo.euclidean_m(F.col(n) - F.col("y_north_m"), F.col(e) - F.col("y_east_m"))
    rows = predict(candidate, test, features).withColumn("_model", err("north_m", "east_m")).withColumn("_base", err("dr_north_m", "dr_east_m")).drop("north_m", "east_m")
    known = champion is not None
    if known:
        try:
            rows = predict(champion, rows, features).withColumn("_champion", err("north_m", "east_m"))
        except Exception as e:  # other inputs: the baseline alone decides
            print(f"champion not comparable: {type(e).__name__}")
            known = False
    hit = lambda c: F.round(F.avg(F.when(F.col(c) <= threshold_m, 1.0).otherwise(0.0)) * 100, 1)
    out = rows.agg(
        F.count("*").alias("n"),
        F.round(F.percentile("_model", F.lit(0.5)), 1).alias("model_p50"),
        F.round(F.percentile("_base", F.lit(0.5)), 1).alias("baseline_p50"),
        hit("_model").alias("model_hit_pct"),
        hit("_base").alias("baseline_hit_pct"),
        (hit("_champion") if known else F.lit(None).cast("double")).alias("champion_hit_pct"),
    )
    return out.withColumns(evaluate.gate(F.col("model_hit_pct"), F.col("baseline_hit_pct"), F.col("champion_hit_pct")))


def as_table_function(df: DataFrame, model, columns: list[str]) -> DataFrame:
    """Any Python model with predict(pandas frame) -> two columns, applied by Arrow batches; columns go by name."""

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = model.predict(frame[columns])
            yield frame.assign(north_m=got[:, 0], east_m=got[:, 1])

    return df.mapInPandas(apply, StructType([*df.schema.fields]).add("north_m", "double").add("east_m", "double"))


class Registry:
    """Versions and the champion pointer as one small JSON file, replaced whole."""

    def __init__(self, store, path: str):
        self.store, self.path = store, path

    def load(self) -> dict:
        return self.store.read_json(self.path) if self.store.has_text(self.path) else {"versions": [], "champion": None, "notes": []}

    def record(self, metrics: dict, promote: bool, reason: str) -> dict:
        state = self.load()
        version = len(state["versions"]) + 1
        state["versions"].append({"version": version, "metrics": metrics, "promoted": promote, "reason": reason})
        if promote:
            if state["champion"]:
                state["notes"].append(f"champion v{state['champion']} -> v{version}")
            state["champion"] = version
        self.store.write_json(self.path, state)
        return state
