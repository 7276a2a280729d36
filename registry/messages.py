"""Candle messages, topics, routing and measure records."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick import views
from candlewick.functions.scalars import format_symbol, iso_to_ms, ms_to_iso, ms_to_time, time_of_seconds, time_to_iso
from candlewick.operators import measures as M
from candlewick.schemas import MEASURE_SCHEMA
from candlewick.session import work_folder
from candlewick.sources.kafka import to_messages, topic_envelope
from candlewick.sources.versioned import VersionedTable
from candlewick.streaming.candles import closed_candles, live_candles, parse_candles
from candlewick.streaming.delivery import Delivery, folder_writer
from candlewick.streaming.jobs import drain, late_counts, split_late
from registry import TICKS_SQL, query

ROUTES = [M.Route("quotes", "quotes_raw", "close"), M.Route("averages", "vwap_5m", "vwap")]


def raw_candles(spark, folder):
    """Exchange messages: two thirds closed candles, some without a candle."""
    candle = F.struct(
        F.col("symbol").alias("s"),
        F.lit("1m").alias("i"),
        F.col("close").cast("string").alias("c"),
        F.col("volume").cast("string").alias("v"),
        F.unix_millis("datetime").alias("T"),
        (F.col("event_id") % 3 != 0).alias("x"),
    )
    ping = F.lit('{"e":"ping"}')
    value = F.when(F.col("event_id") % 11 == 0, ping).otherwise(F.to_json(F.struct(candle.alias("k"))))
    return views.ticks(spark, folder).select(value.alias("value"))


@query(
    "closed_candles",
    f"""WITH {TICKS_SQL}
SELECT symbol, strftime(datetime, '%Y-%m-%dT%H:%M:%SZ') AS "@timestamp", "close", volume,
       epoch_us(datetime) // 1000 AS timestamp_ms
FROM ticks WHERE event_id % 11 <> 0 AND event_id % 3 <> 0""",
)
def closed(spark, folder):
    return closed_candles(raw_candles(spark, folder))


@query(
    "live_candles",
    f"""WITH {TICKS_SQL}
SELECT '1m' AS interval, CAST("close" AS VARCHAR) AS "close", CAST(volume AS VARCHAR) AS volume
FROM ticks WHERE event_id % 11 <> 0""",
)
def live(spark, folder):
    return live_candles(raw_candles(spark, folder))


@query(
    "parse_events",
    f"""WITH {TICKS_SQL}
SELECT symbol, "close", volume, epoch_us(datetime) // 1000 AS timestamp_ms,
       date_trunc('millisecond', datetime) AS timestamp
FROM ticks WHERE event_id % 11 <> 0 AND event_id % 3 <> 0""",
)
def parse_events(spark, folder):
    sent = to_messages(closed_candles(raw_candles(spark, folder)), "symbol")
    return parse_candles(sent).drop("@timestamp")


@query(
    "topic_envelope",
    """SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       event_type AS key, CASE WHEN event_id % 9 <> 0 THEN props END AS value, ts AS timestamp FROM events""",
)
def envelope(spark, folder):
    messages = views.table(spark, folder, "events").select(
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_type").cast("binary").alias("key"),
        F.when(F.col("event_id") % 9 != 0, F.col("props")).cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return topic_envelope(messages)


@query(
    "write_messages",
    """SELECT 'cards' AS topic, CAST(o_orderkey AS VARCHAR) AS key,
       '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS value FROM orders""",
)
def write_messages(spark, folder):
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return to_messages(orders, "o_orderkey", "cards")


def routed_messages(ticks):
    """Ticks on three topics, one of them unknown, some empty, incomplete or with a bad value."""
    kind = F.col("event_id") % 13
    topic = F.when(F.col("event_id") % 7 == 0, "other").when(F.col("event_id") % 2 == 0, "quotes").otherwise("averages")
    number = F.when(kind == 3, "abc").when(kind != 2, F.col("close").cast("string"))
    fields = F.struct(
        F.when(kind != 4, F.col("symbol")).alias("symbol"),
        number.alias("close"),
        number.alias("vwap"),
        F.unix_millis("datetime").alias("timestamp_ms"),
    )
    value = F.when(kind == 0, "").when(kind == 1, "{}").otherwise(F.to_json(fields))
    return ticks.select(topic.alias("topic"), value.alias("value"), F.col("datetime").alias("timestamp"), "event_id")


_ROUTED = f"""WITH {TICKS_SQL}, messages AS (
    SELECT *, CASE WHEN event_id % 7 = 0 THEN 'other' WHEN event_id % 2 = 0 THEN 'quotes' ELSE 'averages' END AS topic,
           event_id % 13 AS kind FROM ticks),
judged AS (
    SELECT *, CASE WHEN kind IN (0, 1) THEN 'empty or malformed message' WHEN topic = 'other' THEN 'unknown topic'
                   WHEN kind = 2 THEN 'measure missing' WHEN kind = 3 THEN 'measure is not a number' END AS reason,
           CASE WHEN kind = 4 THEN 'UNKNOWN' ELSE symbol END AS named FROM messages),
routed AS (
    SELECT *, CASE WHEN reason IS NOT NULL THEN 'rejects' WHEN topic = 'quotes' THEN 'quotes_raw' ELSE 'vwap_5m' END AS "table"
    FROM judged)"""

_ROUTED_RECORDS = f"""{_ROUTED}
SELECT "table", topic, reason, CASE WHEN reason IS NULL THEN named END AS symbol,
       CASE WHEN reason IS NULL THEN CASE topic WHEN 'quotes' THEN 'close' ELSE 'vwap' END END AS measure,
       CASE WHEN reason IS NULL THEN CAST("close" AS VARCHAR) END AS measure_value,
       CASE WHEN reason IS NULL THEN CAST(epoch_us(datetime) // 1000 AS VARCHAR) END AS time_ms
FROM routed"""

_FLAT_RECORD = [
    "table",
    "topic",
    "reason",
    "record.Dimensions[0].Value AS symbol",
    "record.MeasureName AS measure",
    "record.MeasureValue AS measure_value",
    "record.Time AS time_ms",
]


@query("route_measures", _ROUTED_RECORDS)
def route_measures(spark, folder):
    routed = M.route_measures(routed_messages(views.ticks(spark, folder)), ROUTES)
    return routed.selectExpr(*_FLAT_RECORD)


@query("route_stream", _ROUTED_RECORDS)
def route_stream(spark, folder):
    """The router on a stream, one folder per table."""
    schema = views.table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    ticks = events.selectExpr(
        "event_id", "event_type AS symbol", "CAST(ts AS timestamp) AS datetime", "value AS close"
    )
    routed = M.route_measures(routed_messages(ticks), ROUTES)
    return drain(routed, "routed", partition_by="table").selectExpr(*_FLAT_RECORD)


@query(
    "measure_records",
    f"""WITH {TICKS_SQL}
SELECT symbol, strftime(datetime, '%Y-%m-%dT%H:%M:%S.%gZ') AS window_end, 'close' AS measure,
       CAST("close" * CASE event_id % 6 WHEN 0 THEN 1e-6 WHEN 1 THEN 1e6 WHEN 2 THEN -1e15 WHEN 3 THEN 1e-9 ELSE 1.0 END AS VARCHAR) AS measure_value,
       'DOUBLE' AS value_type, CAST(epoch_us(datetime) // 1000 AS VARCHAR) AS time_ms, 'MILLISECONDS' AS unit, event_id AS version
FROM ticks""",
)
def measure_records(spark, folder):
    """Values from a billionth to a quadrillion times the price, which are written with and without an exponent."""
    scale = "CASE event_id % 6 WHEN 0 THEN 1e-6D WHEN 1 THEN 1e6D WHEN 2 THEN -1e15D WHEN 3 THEN 1e-9D ELSE 1.0D END"
    ticks = views.ticks(spark, folder).withColumn("window_end", time_to_iso("datetime")).withColumn("close", F.expr(f"close * {scale}"))
    records = M.to_measure_records(
        ticks, "close", ["symbol", "window_end"], iso_to_ms("window_end"), F.col("event_id")
    )
    return records.selectExpr(
        "Dimensions[0].Value AS symbol",
        "Dimensions[1].Value AS window_end",
        "MeasureName AS measure",
        "MeasureValue AS measure_value",
        "MeasureValueType AS value_type",
        "Time AS time_ms",
        "TimeUnit AS unit",
        "Version AS version",
    )


@query(
    "latest_version",
    f"""WITH {TICKS_SQL}
SELECT symbol, CAST(epoch_us(date_trunc('hour', datetime)) // 1000 AS VARCHAR) AS time_ms,
       CAST(arg_max("close", event_id) AS VARCHAR) AS measure_value, max(event_id) AS version
FROM ticks GROUP BY 1, 2""",
)
def latest_version(spark, folder):
    """Per symbol and hour the record written last."""
    hour = F.unix_millis(F.date_trunc("hour", "datetime"))
    records = M.to_measure_records(views.ticks(spark, folder), "close", ["symbol"], hour, F.col("event_id"))
    return M.latest_version(records).selectExpr(
        "Dimensions[0].Value AS symbol", "Time AS time_ms", "MeasureValue AS measure_value", "Version AS version"
    )


@query(
    "format_symbol",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Binance:' || event_type
       WHEN 1 THEN 'NSE:' || event_type || CAST(event_id % 4 AS VARCHAR) || '!' ELSE 'A:' || event_type END AS full_symbol
FROM events""",
)
def symbols(spark, folder):
    kind = F.col("event_id") % 3
    ticks = views.ticks(spark, folder)
    symbol = F.when(kind == 2, F.concat(F.lit("A:"), "symbol")).otherwise(F.col("symbol"))
    exchange = F.when(kind == 0, "Binance").otherwise("NSE")
    contract = F.when(kind == 1, F.col("event_id") % 4)
    return ticks.select("event_id", format_symbol(symbol, exchange, contract).alias("full_symbol"))


@query(
    "time_scalars",
    """SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
       epoch_us(date_trunc('second', ts)) // 1000 AS iso_ms, date_trunc('millisecond', ts) AS event_time,
       date_trunc('second', ts) AS second_time FROM events""",
)
def time_scalars(spark, folder):
    ticks = views.ticks(spark, folder).withColumn("ms", F.unix_millis("datetime"))
    return ticks.select(
        "event_id",
        "ms",
        ms_to_iso("ms").alias("iso"),
        iso_to_ms(ms_to_iso("ms")).alias("iso_ms"),
        ms_to_time("ms").alias("event_time"),
        time_of_seconds(F.unix_seconds("datetime").cast("string")).alias("second_time"),
    )


_DROPS = """arrivals AS (
    SELECT event_id, event_type AS symbol, ts AS timestamp, CAST(event_id % 3 AS INTEGER) AS batch FROM events),
ends AS (SELECT batch, epoch_us(max(timestamp)) // 1000 - 60000 AS watermark_ms FROM arrivals GROUP BY 1),
marked AS (
    SELECT a.*, (SELECT max(watermark_ms) FROM ends WHERE ends.batch < a.batch) AS watermark_ms FROM arrivals a)"""


def arrivals(spark, folder, name):
    """The events, arriving in three drops that each span the whole time; the stream is started anew for each."""
    staged, inbox, out, checkpoint = (work_folder(spark, f"{name}-{part}") for part in ("staged", "inbox", "out", "checkpoint"))
    events = views.table(spark, folder, "events")
    events.withColumn("drop", F.col("event_id") % 3).write.partitionBy("drop").parquet(staged)
    for drop in range(3):
        spark.read.parquet(staged).filter(F.col("drop") == drop).drop("drop").write.mode("append").parquet(inbox)
        candles = spark.readStream.schema(events.schema).parquet(inbox)
        candles = candles.selectExpr("event_id", "event_type AS symbol", "CAST(ts AS timestamp) AS timestamp")
        split_late(candles, out, checkpoint).awaitTermination()
    return out


@query(
    "late_rows",
    f"""WITH {_DROPS} SELECT event_id, symbol, timestamp, batch, watermark_ms
FROM marked WHERE epoch_us(timestamp) // 1000 < watermark_ms""",
)
def late(spark, folder):
    """The rows that came behind the watermark."""
    return spark.read.parquet(arrivals(spark, folder, "late-rows")).filter("late = 1").drop("late")


@query(
    "late_audit",
    f"""WITH {_DROPS} SELECT batch, count(*) AS n_rows, count(*) FILTER (WHERE epoch_us(timestamp) // 1000 < watermark_ms) AS n_late
FROM marked GROUP BY 1""",
)
def late_audit(spark, folder):
    """Rows and late rows per batch, over three starts of one stream."""
    return late_counts(spark, arrivals(spark, folder, "late-audit"))


def deliveries(spark, folder, name):
    """The routed events, delivered in three drops; the writer of one table fails in the first, that of another in the second."""
    staged, inbox, out, checkpoint, tables = (work_folder(spark, f"{name}-{part}") for part in ("staged", "inbox", "out", "checkpoint", "tables"))
    events = views.table(spark, folder, "events")
    events.withColumn("drop", F.col("event_id") % 3).write.partitionBy("drop").parquet(staged)
    broken, to_folder = {("vwap_5m", 0), ("quotes_raw", 1)}, folder_writer(tables)

    def write(rows, table, batch):
        to_folder(rows, table, batch)
        if (table, batch) in broken:
            broken.discard((table, batch))
            raise OSError(f"{table} did not answer")

    delivery = Delivery(spark, out, write)
    for drop in range(3):
        spark.read.parquet(staged).filter(F.col("drop") == drop).drop("drop").write.mode("append").parquet(inbox)
        rows = spark.readStream.schema(events.schema).parquet(inbox)
        ticks = rows.selectExpr("event_id", "event_type AS symbol", "CAST(ts AS timestamp) AS datetime", "value AS close")
        delivery.run(M.route_measures(routed_messages(ticks), ROUTES), checkpoint).awaitTermination()
    delivery.deliver()
    return delivery, tables


@query("route_tables", _ROUTED_RECORDS)
def route_tables(spark, folder):
    """Every table's records, once each, though two writes failed after they had written."""
    _, tables = deliveries(spark, folder, "route-tables")
    done = None
    for name in [*dict.fromkeys(route.table for route in ROUTES), M.REJECTS]:
        rows = spark.read.parquet(f"{tables}/{name}").drop("batch").withColumn("table", F.lit(name))
        done = rows if done is None else done.unionByName(rows)
    return done.selectExpr(*_FLAT_RECORD)


@query(
    "route_ledger",
    f"""{_ROUTED}
SELECT event_id % 3 AS batch, "table", count(*) AS n_rows, 1 AS n_written,
       CASE WHEN "table" = 'vwap_5m' AND event_id % 3 = 0 OR "table" = 'quotes_raw' AND event_id % 3 = 1 THEN 1 ELSE 0 END AS n_failed
FROM routed GROUP BY ALL""",
)
def route_ledger(spark, folder):
    """What the ledger says of every batch and table: one write, and a failure before it where there was one."""
    events = deliveries(spark, folder, "route-ledger")[0].ledger()
    return events.groupBy("batch", "table").agg(
        F.max("n_rows").alias("n_rows"),
        F.count_if(F.col("event") == "written").cast("int").alias("n_written"),
        F.count_if(F.col("event") == "failed").cast("int").alias("n_failed"),
    )


def merged_table(spark, folder, name):
    """Hourly records in a kept table: three deltas, the third repeated."""
    hour = F.unix_millis(F.date_trunc("hour", "datetime"))
    records = M.to_measure_records(views.ticks(spark, folder), "close", ["symbol"], hour, F.col("event_id"))
    kept = VersionedTable(spark, work_folder(spark, name), MEASURE_SCHEMA, ["Dimensions", "MeasureName", "Time"], buckets=16)
    for drop in (2, 0, 1, 1):
        kept.merge(records.filter(F.col("Version") % 3 == drop))
    kept.compact()
    return kept


@query(
    "latest_table",
    f"""WITH {TICKS_SQL}
SELECT symbol, CAST(epoch_us(date_trunc('hour', datetime)) // 1000 AS VARCHAR) AS time_ms,
       CAST(arg_max("close", event_id) AS VARCHAR) AS measure_value, max(event_id) AS version
FROM ticks GROUP BY 1, 2""",
)
def latest_table(spark, folder):
    """Per symbol and hour the record written last, from a table that three deltas were merged into."""
    return merged_table(spark, folder, "latest-table").read().selectExpr(
        "Dimensions[0].Value AS symbol", "Time AS time_ms", "MeasureValue AS measure_value", "Version AS version"
    )
