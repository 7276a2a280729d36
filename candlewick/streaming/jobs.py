"""Streaming VWAP, streaming router, and how to run them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.functions.scalars import time_to_iso
from candlewick.operators.vwap import priced, vwap_value
from candlewick.session import work_folder
from candlewick.sources.kafka import to_messages
from candlewick.streaming.corrections import greatest_time, log_time


def vwap_stream(
    candles: DataFrame, window: str = "5 minutes", slide: str = "1 minute", watermark: str = "1 minute"
) -> DataFrame:
    """VWAP per symbol and sliding window of a stream of candle events.

    In append mode a window comes out once, when the watermark has reached its
    end; rows that arrive later are dropped. :func:`split_late` keeps them.
    """
    return (
        priced(candles)
        .withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", window, slide), "symbol")
        .agg(vwap_value(F.col("close") * F.col("volume"), "volume").alias("vwap"))
        .select(
            time_to_iso("window.start").alias("window_start"),
            time_to_iso("window.end").alias("window_end"),
            "symbol",
            "vwap",
        )
    )


def vwap_messages(vwaps: DataFrame) -> DataFrame:
    """VWAP rows as messages keyed by symbol."""
    return to_messages(vwaps, "symbol")


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Append a stream to Parquet files, each row exactly once, also after a restart.

    Without ``every`` the query takes all input there is and stops.
    """
    writer = stream.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def drain(stream: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Run a stream over all its present input and return what it wrote."""
    spark = stream.sparkSession
    path, checkpoint = work_folder(spark, name), work_folder(spark, f"{name}-checkpoint")
    run_to_files(stream, path, checkpoint, partition_by).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def split_late(
    stream: DataFrame, path: str, checkpoint: str, time: str = "timestamp", watermark: str = "1 minute"
) -> StreamingQuery:
    """Write a stream's rows to ``path``, those behind the watermark apart: partition columns ``batch`` and ``late`` (0 or 1).

    A batch's watermark is the greatest event time of all earlier batches less the delay, as for a
    windowed query; a row is late if its time lies before it. ``watermark_ms`` says which it was; in the
    first batch it is null and nothing is late. Rows without a time are never late. Each batch replaces its own folders,
    so a batch that is run again after a failure leaves every row once. The greatest time comes from a ledger
    below ``path`` with one row per batch; earlier rows are not read again.
    """
    def write(rows: DataFrame, batch: int) -> None:
        seen = greatest_time(rows.sparkSession, f"{path}/_times", batch)
        log_time(rows, time, f"{path}/_times", batch, seen)
        limit = F.lit(seen).cast("long") - F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {watermark}"))
        marked = rows.withColumn("watermark_ms", limit).withColumn("batch", F.lit(batch))
        marked = marked.withColumn("late", F.coalesce((F.unix_millis(time) < F.col("watermark_ms")).cast("int"), F.lit(0)))
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch", "late").parquet(path)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows and late rows of every batch that ``split_late`` has written."""
    return spark.read.parquet(path).groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("late").cast("long").alias("n_late"))
