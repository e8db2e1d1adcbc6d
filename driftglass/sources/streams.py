"""Streaming scans with a rate limit per query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema, most_files: int = 1, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).format(fmt).load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, most_offsets: int) -> DataFrame:
    """From the earliest offset on, at most ``most_offsets`` records a trigger; needs Spark's Kafka package."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": str(most_offsets)}
    return spark.readStream.format("kafka").options(**options).load()


def to_messages(df: DataFrame, key: str = "icao24") -> DataFrame:
    """Rows as (key, value) of a message log: the value is the row as JSON. What a Kafka sink takes."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def from_messages(messages: DataFrame, schema) -> DataFrame:
    """Rows of a message log, by ``schema``: a value that is no JSON record of it becomes a row of nulls, as counted by the
    drop reasons."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("_r")).select("_r.*")


def kafka_write(df: DataFrame, servers: str, topic: str, key: str = "icao24") -> None:
    """Append rows to a topic; needs Spark's Kafka package."""
    to_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def log_tail_watermark(log: DataFrame, now: int, snapshot: str = "timestamp") -> int | None:
    """Newest snapshot in a log, no later than now: where a restarted producer goes on."""
    return log.agg(F.least(F.max(snapshot), F.lit(now))).first()[0]
