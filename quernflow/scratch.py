"""Cutting lineage with tables in the folder that the cluster shares.

The folder is the session's ``spark.checkpoint.dir``; only where that is unset and the master is local (tests, a laptop) is
one made below ``/tmp/checkpoints``. A table written here survives the loss of any executor, unlike a cached or locally checkpointed one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from quernflow.session import setting

_RUN = uuid.uuid4().hex[:12]
_OWN = f"file:///tmp/checkpoints/quernflow-{_RUN}"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths written since the innermost ``settled`` began.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: the cluster's setting; on a single machine, where there is none, one of our own."""
    found = setting(spark, "spark.checkpoint.dir")
    if found is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (found or _OWN).rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/quernflow/{_RUN}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def _without_shuffle_files(spark: SparkSession):
    """Writes that begin here remove their shuffle files when they end, and not only when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later plans start from those files."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    with _without_shuffle_files(spark):
        df.write.parquet(path)
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """Materialize what ``make`` returns, then remove the scratch tables that were written on the way to it.

    Only for a ``make`` that leaves none of those tables to anybody else.
    """
    written: list[str] = []
    token = _PASSING.set(written)
    try:
        df = make()
    finally:
        _PASSING.reset(token)
    out = materialize(df, tag)
    for path in written:
        drop(df.sparkSession, path)
    return out


def drop(spark: SparkSession, path: str) -> None:
    """Remove one scratch path; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def sweep(spark: SparkSession) -> None:
    """Remove all scratch of this process; call it when no result that builds on it is needed any more."""
    drop(spark, f"{shared_dir(spark)}/quernflow/{_RUN}")
