"""Small files and listings on any store Spark can reach, through Hadoop's file system."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="driftglass-lake-")


def work_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; only on one host (tests) our own where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{_own_folder()}"
    return f"{base.rstrip('/')}/driftglass-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    size: int
    modified_ms: int
    is_dir: bool


class Store:
    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def list(self, path: str) -> list[Entry]:
        """Entries of a folder by name; a missing folder is empty."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        found = [Entry(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime(), s.isDirectory()) for s in fs.listStatus(p)]
        return sorted(found, key=lambda e: e.name)

    def has_text(self, path: str) -> bool:
        """Whether ``read_text`` finds something: the file, or its next version whose last step a crash left open."""
        return self.exists(path) or self.exists(f"{path}.next")

    def read_text(self, path: str) -> str:
        fs, p = self._at(path if self.exists(path) else f"{path}.next")
        stream = fs.open(p)
        try:
            return bytes(self.jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str, stop_after: str = "") -> None:
        """Whole or not at all, on any store: ``read_text`` finds the old text until the new one is complete.

        The text is written under a name of its own and renamed to ``.next``; only then does the old file go, and the new
        one takes its place. A crash between the last two steps leaves ``.next``, which counts as the file. The .next of a
        crash before them is older than what is written now and is replaced.
        """
        fs, p = self._at(path)
        path_of = self.jvm.org.apache.hadoop.fs.Path
        side, following = path_of(f"{path}.{uuid.uuid4().hex}.tmp"), path_of(f"{path}.next")
        stream = fs.create(side, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if fs.exists(following):
            if fs.exists(p):
                fs.delete(following, False)
            else:
                self._move(fs, following, p)
        self._move(fs, side, following)
        if stop_after == "next":
            raise RuntimeError(stop_after)
        fs.delete(p, False)
        if stop_after == "delete":
            raise RuntimeError(stop_after)
        self._move(fs, following, p)

    @staticmethod
    def _move(fs, a, b) -> None:
        if not fs.rename(a, b):
            raise OSError(f"can't write {b}")

    def rename(self, a: str, b: str) -> None:
        fs, p = self._at(a)
        target = self.jvm.org.apache.hadoop.fs.Path(b)
        fs.mkdirs(target.getParent())
        if not fs.rename(p, target):
            raise OSError(f"can't rename {a} to {b}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def read_json(self, path: str):
        return json.loads(self.read_text(path))

    def write_json(self, path: str, value) -> None:
        self.write_text(path, json.dumps(value, sort_keys=True, default=str))
