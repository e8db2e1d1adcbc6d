"""Session construction and the settings every transformation relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC everywhere: epoch arithmetic and date ownership must not follow the host's zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "driftglass", master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``master`` and partition counts stay the deployer's choice."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SETTINGS, **extra)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
