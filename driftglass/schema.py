"""The position-report record: one declaration, from which every schema and projection follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Field name, Spark type on the wire, slot in the positional state vector (None: not in the vector).
FIELDS = [
    ("icao24", "string", 0),
    ("callsign", "string", 1),
    ("origin_country", "string", 2),
    ("time_position", "long", 3),
    ("last_contact", "long", 4),
    ("longitude", "double", 5),
    ("latitude", "double", 6),
    ("baro_altitude", "double", 7),
    ("on_ground", "boolean", 8),
    ("velocity", "double", 9),
    ("true_track", "double", 10),
    ("vertical_rate", "double", 11),
    ("sensors", "string", 12),
    ("geo_altitude", "double", 13),
    ("squawk", "string", 14),
    ("spi", "boolean", 15),
    ("position_source", "int", 16),
    ("timestamp", "long", None),
    ("ingested_at", "double", None),
]
NO_CALLSIGN = "N/A"
HISTORY_COLUMNS = ["icao24", "callsign", "time_position", "latitude", "longitude", "baro_altitude", "velocity", "true_track", "vertical_rate", "timestamp"]
LATEST_COLUMNS = [*HISTORY_COLUMNS, "origin_country", "on_ground", "geo_altitude", "squawk", "last_contact"]


def wire_schema() -> StructType:
    return StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind, _ in FIELDS))


def clean_callsign(c: Column) -> Column:
    """Trimmed; empty and null become the sentinel."""
    text = F.trim(c)
    return F.when(text.isNull() | (text == ""), F.lit(NO_CALLSIGN)).otherwise(text)


def record_from_vector(vector: Column, snapshot: Column, ingested: Column) -> list[Column]:
    """Named columns from an array<string> state vector; slots beyond its end are null."""
    out = []
    for name, kind, slot in FIELDS:
        if slot is None:
            value = snapshot if name == "timestamp" else ingested
        elif name == "sensors":
            value = F.array_join(F.from_json(F.get(vector, F.lit(slot)), "array<string>"), ",")
        else:
            value = F.get(vector, F.lit(slot))
        value = clean_callsign(value) if name == "callsign" else value
        out.append(value.try_cast(kind).alias(name))
    return out


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages to typed, flagged rows: bad JSON gives nulls, never a failure; nothing is filtered here."""
    parsed = messages.select(F.from_json(F.col(value).cast("string"), wire_schema()).alias("data")).select("data.*")
    parsed = parsed.withColumns({"timestamp": F.timestamp_seconds("timestamp"), "ingested_at": F.timestamp_seconds("ingested_at")})
    return flag_valid(parsed)


def flag_valid(df: DataFrame, snapshot: str = "timestamp") -> DataFrame:
    """Add _valid: a position and a snapshot time are there."""
    return df.withColumn("_valid", F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col(snapshot).isNotNull())


def hot_rows(df: DataFrame) -> DataFrame:
    """Valid rows with a key."""
    return df.where(F.col("_valid") & F.col("icao24").isNotNull()).drop("_valid")


def cold_rows(df: DataFrame) -> DataFrame:
    """Valid rows, keyless ones included."""
    return df.where("_valid").drop("_valid")
