"""Windows of a stream kept right when rows come late: every change is a new version."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.operators.measures import latest_version
from candlewick.operators.ordering import DAY_MICROS
from candlewick.operators.vwap import priced

KEY = ("symbol", "window_start", "window_end")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def greatest_time(spark: SparkSession, path: str, before: int) -> int | None:
    """Milliseconds of the latest event of all batches before one, from the newest row of a ledger with one small row per batch."""
    ledger = _read(spark, f"{path}/batch={before - 1}") if before else None
    if ledger is None and before:
        ledger = _read(spark, path)
        ledger = None if ledger is None else ledger.filter(F.col("batch") < before)
    return None if ledger is None else ledger.agg(F.max("last_ms")).first()[0]


def log_time(rows: DataFrame, time: str, path: str, batch: int, seen: int | None) -> None:
    """Write the batch's row of the ledger: the latest event of it and of all batches before."""
    last = F.greatest(F.max(F.unix_millis(time)), F.lit(seen).cast("long"))
    rows.agg(last.alias("last_ms")).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def correct_vwap(
    candles: DataFrame, path: str, checkpoint: str, minutes: int = 5, slide_minutes: int = 1, watermark: str = "1 minute"
) -> StreamingQuery:
    """VWAP per symbol and sliding window as versions: each batch writes the windows that its rows, late ones too, belong to.

    A batch's rows become sums per slide-wide pane, stored by day. The windows they touch are put together again from
    the panes of all batches, read for the touched days only, and written with the batch as ``version``;
    ``correction`` marks those whose end the watermark had passed before, which an append-only stream would have lost. A batch
    that is run again replaces its own panes and versions.
    """
    if minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    pane_us, window_us = slide_minutes * 60_000_000, minutes * 60_000_000
    reach = -(-window_us // DAY_MICROS)  # days that a window can reach beyond its panes' days

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        seen = greatest_time(spark, f"{path}/times", batch)
        log_time(rows, "timestamp", f"{path}/times", batch, seen)
        limit = F.timestamp_millis(F.lit(seen).cast("long")) - F.expr(f"INTERVAL {watermark}")
        pane = F.floor(F.unix_micros("timestamp") / F.lit(pane_us)) * pane_us
        value = F.sum(F.col("close") * F.col("volume"))
        sums = priced(rows).filter("timestamp IS NOT NULL").groupBy("symbol", pane.alias("pane")).agg(value.alias("value"), F.sum("volume").alias("volume"))
        sums = sums.withColumns({"day": F.floor(F.col("pane") / F.lit(DAY_MICROS)), "batch": F.lit(batch)})
        writer = sums.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "batch").parquet(f"{path}/panes")
        panes = _read(spark, f"{path}/panes")
        if panes is None:
            return
        starts = F.explode(F.sequence(F.col("pane") - (window_us - pane_us), F.col("pane"), F.lit(pane_us).cast("long"))).alias("start")
        own = panes.filter(F.col("batch") == batch)
        touched = own.select("symbol", starts).distinct()
        days = own.agg(F.min("day"), F.max("day")).first()
        if days[0] is None:
            return
        near = panes.filter((F.col("batch") <= batch) & F.col("day").between(days[0] - reach, days[1] + reach))
        near = near.groupBy("symbol", "pane").agg(F.sum("value").alias("value"), F.sum("volume").alias("volume"))
        copies = near.select("symbol", "value", "volume", starts)
        same = copies["symbol"].eqNullSafe(touched["symbol"]) & (copies["start"] == touched["start"])
        windows = copies.join(touched, same, "left_semi").groupBy("symbol", "start").agg(F.try_divide(F.sum("value"), F.sum("volume")).alias("vwap"))
        end = F.timestamp_micros(F.col("start") + window_us)
        found = windows.select(
            "symbol",
            F.timestamp_micros("start").alias("window_start"),
            end.alias("window_end"),
            "vwap",
            F.lit(batch).cast("long").alias("version"),
            F.coalesce(end <= limit, F.lit(False)).alias("correction"),
        )
        found.write.mode("overwrite").parquet(f"{path}/versions/batch={batch}")

    return candles.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all windows that ``correct_vwap`` has written."""
    return spark.read.parquet(f"{path}/versions").drop("batch")


def corrected(spark: SparkSession, path: str) -> DataFrame:
    """The last version of every window: the VWAP over all rows so far, however late they came."""
    return latest_version(versions(spark, path), KEY, "version").select(*KEY, "vwap")
