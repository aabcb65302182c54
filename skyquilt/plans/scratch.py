"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``, so a lost executor costs a re-read and
not a recomputation. Only where that setting is absent and the master is local does a temporary folder
stand in for it. The shuffles of a table's plan go as soon as it is written, and what an operator leaves in its folder, as
its lazy result may still read it, goes when the driver's Python ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}
_roots: list[tuple[SparkSession, str]] = []
#: Spark removes an execution's shuffle files at its end if this is set when its DataFrame is made.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


@atexit.register
def _clear() -> None:
    for spark, root in _roots:
        with suppress(Exception):  # a session that has ended can't delete
            _delete(spark, root)


@contextmanager
def _set(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    was = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, was)


def tidy(spark: SparkSession):
    """The shuffles of what is made and run inside go when it has run; nothing made inside may be run twice."""
    return _set(spark, _TIDY, "true", "false")


def batches_of(spark: SparkSession, rows: int):
    """What is run inside sends Python workers so many rows at once at most."""
    return _set(spark, _BATCH, str(rows), "10000")


def folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, without a trailing slash."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "path" not in _local:
        _local["path"] = tempfile.mkdtemp(prefix="skyquilt-")
        atexit.register(shutil.rmtree, _local["path"], ignore_errors=True)
    return f"file://{_local['path']}"


class Scratch:
    """Tables written during one operator call. ``drop`` removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{folder(spark)}/skyquilt-{uuid.uuid4().hex}"
        self._n = 0
        _roots.append((spark, self.root))

    def path(self) -> str:
        self._n += 1
        return f"{self.root}/{self._n}"

    def save(self, df: DataFrame) -> DataFrame:
        """Writes ``df`` and returns what reads it back; its lineage starts there."""
        path = self.path()
        with tidy(self.spark):
            df.where(F.lit(True)).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for table in tables:
            if table is not None:
                self.remove(table._scratch_path)

    def remove(self, path: str) -> None:
        _delete(self.spark, path)
