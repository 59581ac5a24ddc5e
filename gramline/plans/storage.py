"""Where intermediate tables live.

A table that several jobs read is written once, as parquet, to the shared folder named by `spark.checkpoint.dir`: it
cuts lineage, survives the loss of executors and gives exact sizes to later decisions.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for this application, never used before."""
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None) or _own_folders.get(app)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folders[app] = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/gramline/{app}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables written inside it. What outlives it must be collected, saved or `kept`."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """`written`, but no scope deletes the table."""
    return _written(df, name, None)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table written now, which the scope it is written in deletes."""
    return _written(df, name, _scope.get())


def _written(df: DataFrame, name: str, paths: list[str] | None) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than there are cores, spread over them. Any larger scan is returned as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
