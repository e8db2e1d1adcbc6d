"""Shared storage, stage tables and Arrow plumbing of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="driftglass-")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Only on one host (tests) below a folder of our own where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{_own_folder()}"
    return f"{base.rstrip('/')}/driftglass-{uuid.uuid4().hex}"


#: Bytes of a row group of stage tables: a task that writes buffers one, and rows of some megabytes are many of its kind.
ROW_GROUP = 32 << 20
#: Settings of the writes of stage tables: their shuffle files go when the write ends, and Python workers get small batches.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


@contextlib.contextmanager
def _stage_write(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in WRITE_CONF}
    for k, v in WRITE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keep(df: DataFrame, path: str, codec: str = "zstd", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: lineage ends at files that survive lost executors."""
    writer = df.write.mode("overwrite").option("compression", codec).option("parquet.block.size", str(ROW_GROUP))
    with _stage_write(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _table_name(path: str) -> str:
    return "driftglass_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex


def keep_bucketed(df: DataFrame, path: str, *keys: str) -> DataFrame:
    """``keep`` as a table bucketed by ``keys`` under ``path``: later joins on them read it in place, without a shuffle."""
    spark, name = df.sparkSession, _table_name(path)
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with _stage_write(spark):
        df.write.format("parquet").option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP)).option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def drop_folder(spark: SparkSession, *paths: str) -> None:
    """Delete stage tables nothing reads any more, and their names in the catalog where they are bucketed."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_others(spark: SparkSession, path: str, names: set[str]) -> None:
    """Delete the files of a folder whose last name is not that of one in ``names``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = {n.rsplit("/", 1)[-1] for n in names}
    for found in store.listStatus(where) if store.exists(where) else ():
        if found.getPath().getName() not in kept:
            store.delete(found.getPath(), False)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release_memory() -> None:
    """Give freed memory back: Python workers live on between tasks and stages, and their allocators keep what they had."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _tidied(batches: Iterator[pa.RecordBatch], fn: Callable) -> Iterator[pa.RecordBatch]:
    yield from fn(batches)
    release_memory()


def tidied(fn: Callable) -> Callable:
    """``fn`` for mapInArrow, with the worker's memory released at the end of the task."""
    return partial(_tidied, fn=fn)


def batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in columns.values()], names=list(columns))


def crc_remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus``: the fold rule. A null id has no remainder (null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))



def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    name = f"_{name}"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name
