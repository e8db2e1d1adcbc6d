"""Row selection per key. Every choice has a total order, so results don't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def first_per(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key in ``order``. Spark prunes the other rows before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def last_per(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The last row of each key in ``order`` (nulls first, so a null never wins)."""
    return first_per(df, keys, [c.desc_nulls_last() for c in _cols(order)])


def newest(df: DataFrame, keys: list, keep: int, order: list) -> DataFrame:
    """Keep-last-N retention per key (an empty key list: over the whole, small table)."""
    w = Window.partitionBy(*(_cols(keys) or [F.lit(1)])).orderBy(*[c.desc_nulls_last() for c in _cols(order)])
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= keep).drop("_nth")


def snapshot_rows(df: DataFrame, key: str = "icao24", snapshot: str = "timestamp", received: str = "ingested_at", by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (key, snapshot): the first received, then the least in full-row order. Null keys are kept, one each. ``by``: one for each of these."""
    rest = [c for c in df.columns if c not in (key, snapshot, received, *by)]
    return first_per(df, [*by, key, snapshot], [received, *rest])


def positions(df: DataFrame, key: str = "icao24", event: str = "time_position", order: list | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per position report: the earliest snapshot of each (key, event time); without event time there is none."""
    return first_per(df.where(F.col(event).isNotNull()), [*by, key, event], order or ["timestamp"])


def changes_only(df: DataFrame, keys: list, order: list, values: list[str]) -> DataFrame:
    """Consecutive rows with equal ``values`` become the first of them."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    same = F.lit(True)
    for v in values:
        same = same & F.lag(v).over(w).eqNullSafe(F.col(v))
    return df.withColumn("_first", F.row_number().over(w) == 1).withColumn("_same", same).where("_first or not _same").drop("_first", "_same")
