"""Idempotent merges of a batch into stored state, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftglass.operators.dedup import first_per


def upsert_latest(stored: DataFrame, batch: DataFrame, key: str = "icao24", version: str = "timestamp", ties: list | None = None) -> DataFrame:
    """The newest row per key. A stored row gives way only to a strictly newer one; within a batch the first in ``ties``.

    One exchange on the key; out-of-order and replayed batches change nothing.
    """
    rows = stored.withColumn("_side", F.lit(0)).unionByName(batch.where(F.col(key).isNotNull()).withColumn("_side", F.lit(1)))
    return first_per(rows, [key], [F.col(version).desc_nulls_last(), "_side", *(ties or [])]).drop("_side")


def insert_absent(stored: DataFrame, batch: DataFrame, key: str = "icao24", event: str = "time_position", order: list | None = None) -> DataFrame:
    """Rows of ``batch`` to append: (key, event) not stored yet, the first per key in the batch. Null event times never
    conflict, so all of them are appended."""
    dated = first_per(batch.where(F.col(event).isNotNull()), [key, event], order or ["timestamp"])
    new = dated.join(stored.where(F.col(event).isNotNull()).select(key, event).distinct(), [key, event], "left_anti").select(*batch.columns)
    return new.unionByName(batch.where(F.col(event).isNull()))


def retained(df: DataFrame, snapshot: str, as_of, keep_s: int) -> DataFrame:
    """Rows not older than ``keep_s``."""
    return df.where(F.col(snapshot) >= as_of - keep_s)
