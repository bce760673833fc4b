"""Where intermediate results go: a folder that outlives any one executor."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own. A cluster
    session must name one, because a folder on one machine is lost with it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if named.startswith("file:") and not sc.master.startswith("local"):
            warnings.warn(f"{named} must be mounted on every machine of {sc.master}", stacklevel=2)
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakeops-"))
    return sc.getCheckpointDir().rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor never replays earlier rounds."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Paths given out inside each open scratch scope.
_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was written to new paths inside, also by threads: for work whose result lies elsewhere by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        # By identity: two scopes may hold equal lists.
        _scopes[:] = [held for held in _scopes if held is not paths]
        for path in paths:
            remove_path(spark, path)


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet."""
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    for paths in _scopes:
        paths.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove what was written to :func:`new_path`."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written_out(df: DataFrame) -> DataFrame:
    """The rows as a parquet table in the shared folder: for data that is scanned many times."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spooled(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType, size: int = 1000) -> DataFrame:
    """Rows that arrive one by one on the driver, as a table in the shared folder; the driver holds ``size`` of them."""
    path = new_path(spark)
    spark.createDataFrame([], schema).write.parquet(path)
    for batch in batched(rows, size):
        spark.createDataFrame(list(batch), schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def scratch_database(spark: SparkSession, label: str) -> str:
    """New database under the shared folder; its name is unique per call."""
    name = f"{label}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{shared_dir(spark)}/tables/{name}'")
    return name
