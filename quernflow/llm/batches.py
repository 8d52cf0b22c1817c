"""A bound on the Arrow batches that reach Python: whole texts are read, but only so many bytes of them at a time."""

from __future__ import annotations

from pyspark.sql import SparkSession

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST = 8 << 20


def bound(spark: SparkSession, most: int = MOST) -> None:
    """Lower the session's batch size to ``most`` bytes; a smaller setting, with or without a unit, stays. Results do not depend on it."""
    known = spark.conf.get(BYTES).strip()
    now = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(known))
    if now > most or now <= 0:
        spark.conf.set(BYTES, str(most))
