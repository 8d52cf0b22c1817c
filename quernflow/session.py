"""Session settings that the engine relies on, and access to settings the cluster names."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "quernflow", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUERNFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def setting(spark: SparkSession, key: str, default: str | None = None) -> str | None:
    """A setting of the session, else of its context, else the default."""
    value = spark.conf.get(key, None)
    if value is None:
        value = spark.sparkContext.getConf().get(key, None)
    return default if value is None else value


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
