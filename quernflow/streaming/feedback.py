"""An extension: coverage feedback as a stream. Each micro-batch of maps adds the edges that no earlier one had."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_seen(spark: SparkSession, path: str) -> DataFrame:
    """(edge_id, seq, batch) of all edges kept so far."""
    schema = "edge_id string, seq long, batch long"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def novelty_sink(path: str):
    """A function for ``foreachBatch`` over rows (seq, edge_id).

    A batch's new edges are those of no *other* batch, written to the batch's own folder: a batch that runs again writes the
    same rows over its own.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = first_seen(spark, path).where(F.col("batch") < number)
        new = batch.groupBy("edge_id").agg(F.min("seq").cast("long").alias("seq")).join(known, "edge_id", "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def start(rows: DataFrame, path: str, checkpoint: str):
    """Start the stream; ``rows`` is a streaming DataFrame (seq, edge_id)."""
    return rows.writeStream.foreachBatch(novelty_sink(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
