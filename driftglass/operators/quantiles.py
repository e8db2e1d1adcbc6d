"""Exact quantiles of any number of rows.

Up to ``few`` rows the built-in exact percentile does it: its last step holds the distinct values of a group in one task.
Beyond, values are counted, range-partitioned by (group, value) and ranked by the counts of the partitions before them, so
no task holds more than its range. Both give the same numbers (a zero has no sign): linear interpolation between the neighbouring ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftglass.plans.store import work_folder

FEW = 5_000_000


def quantiles(df: DataFrame, by: list[str], values: dict[str, Column], shares: list[float], few: int = FEW) -> DataFrame:
    """A row per group (one row without ``by``) with, per name in ``values``, an array of its quantiles at ``shares``.

    Nulls don't count; a group without values has null.
    """
    if _few(df, few):
        asked = F.array(*[F.lit(float(s)) for s in shares])
        return df.groupBy(*by).agg(*(F.percentile(v, asked).alias(name) for name, v in values.items()))
    out = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    for name, v in values.items():
        one = ranked_quantiles(df.select(*by, v.cast("double").alias("_v")), by, shares).withColumnRenamed("_q", name)
        if by:
            same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
            out = out.alias("l").join(one.alias("r"), same, "left").select("l.*", f"r.{name}")
        else:
            out = out.crossJoin(one)  # one row on either side
    return out


def _few(df: DataFrame, few: int) -> bool:
    """Whether ``df`` has at most ``few`` rows; rows are only counted where the plan's size does not tell. A row is taken
    for 50 bytes at least."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size <= 50 * few or df.limit(few + 1).count() <= few


def ranked_quantiles(df: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """(by..., _q): quantiles of _v by ranks over range partitions."""
    spark = df.sparkSession
    counted = df.where("_v is not null").groupBy(*by, "_v").agg(F.count("*").alias("_c"))
    path = f"{work_folder(spark)}/ranked"
    ordered = counted.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id())
    ordered.write.parquet(path)
    stored = spark.read.parquet(path)
    parts = stored.groupBy(*by, "_part").agg(F.sum("_c").alias("_n"))  # a row per partition and group in it
    whole = Window.partitionBy(*(by or [F.lit(1)]))
    parts = parts.withColumn("_before", F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).withColumn("_total", F.sum("_n").over(whole))
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    # a share lies between two ranks (from 0); a partition matters if it holds one of them
    parts = parts.withColumn("_ranks", F.flatten(F.transform(wanted, lambda s: F.array(F.floor(s * (F.col("_total") - 1)), F.ceil(s * (F.col("_total") - 1))))))
    parts = parts.withColumn("_ranks", F.filter("_ranks", lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))).where("size(_ranks) > 0")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*by, "_part"]]
    near = stored.alias("s").join(F.broadcast(parts).alias("p"), same).select(*(f"s.{c}" for c in [*by, "_part", "_v", "_c"]), "p._before", "p._total", "p._ranks")
    inside = Window.partitionBy(*by, "_part").orderBy("_v")
    near = near.withColumn("_end", F.col("_before") + F.sum("_c").over(inside))
    hits = near.withColumn("_rank", F.explode(F.array_distinct(F.filter("_ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_c"))))))
    at = hits.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"), F.first("_total").alias("_total"))

    def quantile(s: Column) -> Column:
        place = s * (F.col("_total") - 1)
        lo = F.element_at("_at", F.floor(place))
        return lo + (F.element_at("_at", F.ceil(place)) - lo) * (place - F.floor(place))

    return at.select(*by, F.transform(wanted, quantile).alias("_q"))
