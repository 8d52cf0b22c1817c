"""Running totals over a whole table without putting it through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernflow.scratch import materialize


def running_sum(df: DataFrame, order: str, value: str, name: str, tasks: int | None = None) -> DataFrame:
    """``df`` with ``name``, the sum of ``value`` over all rows up to each in ``order`` (which must be unique).

    Rows are dealt by ranges of ``order``; each range adds the totals of those before it, of which there is one row a range.
    The ranges are written to the shared folder first, so that both sides see the same ones.
    """
    spark = df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(tasks, order).withColumn("__range", F.spark_partition_id()), "ranges")
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("__range").agg(F.sum(value).alias("__n"))
    totals = totals.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = W.partitionBy("__range").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    out = rows.join(F.broadcast(totals), "__range")
    return out.withColumn(name, F.sum(value).over(within) + F.col("__before")).drop("__range", "__before")
