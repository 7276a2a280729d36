"""Resampling, slices, indicators and VWAP."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from candlewick import views
from candlewick.operators import bars as B
from candlewick.operators import indicators as I
from candlewick.operators import vwap as V
from candlewick.operators.clean import dedup_bars
from candlewick.operators.continued import IndicatorStore
from candlewick.operators.sessions import Session, in_sessions, session_calendar
from candlewick.plans.gold import gold
from candlewick.schemas import VWAP_SCHEMA
from candlewick.sources.payloads import parse_bar_payloads
from candlewick.session import work_folder
from candlewick.streaming.candles import parse_candles
from candlewick.streaming.corrections import correct_vwap, corrected, versions
from candlewick.streaming.jobs import drain, vwap_messages, vwap_stream
from registry import DAY_SQL, HOUR_SQL, SQL, TICKS_SQL, bars_sql, near_sql, query, rounded


def _ema_sql(value: str, base: str, order: str = "i") -> str:
    over = f"(PARTITION BY symbol ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    return f"sum({value} * pow({base}, -i)) OVER {over} / sum(pow({base}, -i)) OVER {over}"


_NUMBERED = """numbered AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS DOUBLE) AS i,
           "close" - lag("close") OVER (PARTITION BY symbol ORDER BY datetime) AS delta
    FROM {source})"""

_MOVES = """moves AS (
    SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0.0 END AS gain,
           CASE WHEN delta < 0 THEN -delta ELSE 0.0 END AS loss
    FROM numbered)"""

_LINES = f"""lines AS (
    SELECT *, {_ema_sql('gain', '(1 - 1.0 / 14)')} AS avg_gain, {_ema_sql('loss', '(1 - 1.0 / 14)')} AS avg_loss,
           {_ema_sql('"close"', '(1 - 2.0 / 51)')} AS ema_50,
           avg("close") OVER (PARTITION BY symbol ORDER BY i ROWS 199 PRECEDING) AS sma_200,
           {_ema_sql('"close"', '(1 - 2.0 / 13)')} - {_ema_sql('"close"', '(1 - 2.0 / 27)')} AS macd
    FROM moves)"""

_SIGNALS = f"signals AS (SELECT *, {_ema_sql('macd', '0.8')} AS macd_signal FROM lines)"

_RSI = "100 - 100 / (1 + avg_gain / nullif(avg_loss, 0))"

_HOURS = f"WITH {TICKS_SQL}, {HOUR_SQL}, {_NUMBERED.format(source='bars')}, {_MOVES}, {_LINES}, {_SIGNALS}"


@query(
    "gold_indicators",
    f"""{_HOURS}
SELECT datetime, symbol, open, high, low, "close", volume, {near_sql('sma_200')} AS sma_200,
       {near_sql('ema_50')} AS ema_50, {near_sql(_RSI)} AS rsi_14, {near_sql('macd')} AS macd,
       {near_sql('macd_signal')} AS macd_signal, {near_sql('macd - macd_signal')} AS macd_hist,
       'all' AS crypto, CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month
FROM signals""",
)
def gold_indicators(spark, folder):
    table = gold(views.bars(spark, folder, "hour_1"), crypto="all", unique=True)
    return rounded(table, "sma_200", "ema_50", "rsi_14", "macd", "macd_signal", "macd_hist")


@query(
    "sma_trailing",
    f"{_HOURS} SELECT symbol, datetime, \"close\", {near_sql('sma_200')} AS sma_200 FROM signals",
)
def sma_trailing(spark, folder):
    bars = views.bars(spark, folder, "hour_1").select("symbol", "datetime", "close")
    return rounded(I.sma(bars, "close", 200), "sma_200")


@query(
    "ema_blocked",
    f"""WITH {TICKS_SQL}, {_NUMBERED.format(source='ticks')}
SELECT event_id, symbol, datetime, "close", {near_sql(_ema_sql('"close"', '0.8'))} AS ema_9 FROM numbered""",
)
def ema_blocked(spark, folder):
    return rounded(I.ema(views.ticks(spark, folder).drop("volume"), "close", span=9), "ema_9")


@query(
    "rsi_wilder",
    f"{_HOURS} SELECT symbol, datetime, \"close\", {near_sql(_RSI)} AS rsi_14 FROM signals",
)
def rsi_wilder(spark, folder):
    bars = views.bars(spark, folder, "hour_1").select("symbol", "datetime", "close")
    return rounded(I.rsi(bars, "close", 14), "rsi_14")


@query(
    "macd_full",
    f"""{_HOURS} SELECT symbol, datetime, {near_sql('macd')} AS macd, {near_sql('macd_signal')} AS macd_signal,
       {near_sql('macd - macd_signal')} AS macd_hist FROM signals""",
)
def macd_full(spark, folder):
    bars = views.bars(spark, folder, "hour_1").select("symbol", "datetime", "close")
    return rounded(I.macd(bars), "macd", "macd_signal", "macd_hist").drop("close")


# Long series: each mean is summed over the rows whose weight a double can tell from nothing, so no power overflows.
_LINES_OF = """lines AS (
    SELECT l_orderkey * 8 + l_linenumber AS line, l_returnflag AS symbol, CAST(l_shipdate AS TIMESTAMP) AS datetime,
           l_extendedprice AS "close" FROM lineitem)"""


def _long_sql(source: str, order: str) -> str:
    return f"""placed AS (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) - 1 AS i,
           "close" - lag("close") OVER (PARTITION BY symbol ORDER BY {order}) AS delta FROM {source}),
moved AS (SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0.0 END AS gain, CASE WHEN delta < 0 THEN -delta ELSE 0.0 END AS loss FROM placed)"""


def _long_mean(name: str, source: str, value: str, base: float, out: str) -> str:
    """Weighted mean of a numbered series over as many rows as weigh more than 1e-18 of the newest."""
    reach = int(42 / -math.log(base)) + 2
    return f"""{name} AS (
    SELECT a.symbol, a.i, sum(b.{value} * pow({base!r}, a.i - b.i)) * {1 - base!r} / (1 - pow({base!r}, a.i + 1)) AS {out}
    FROM {source} a JOIN {source} b ON a.symbol = b.symbol AND b.i BETWEEN a.i - {reach} AND a.i GROUP BY 1, 2)"""


_LONG_MACD = [
    _long_mean("fast", "moved", '"close"', 1 - 2 / 13, "fast"),
    _long_mean("slow", "moved", '"close"', 1 - 2 / 27, "slow"),
    "gap AS (SELECT symbol, i, fast - slow AS macd FROM fast JOIN slow USING (symbol, i))",
    _long_mean("signal", "gap", "macd", 0.8, "macd_signal"),
]
_LONG_RSI = [_long_mean("gains", "moved", "gain", 13 / 14, "avg_gain"), _long_mean("losses", "moved", "loss", 13 / 14, "avg_loss")]
_LONG_EMA = [_long_mean("ema", "moved", '"close"', 1 - 2 / 51, "ema_50")]
_LONG_SMA = "avg(\"close\") OVER (PARTITION BY symbol ORDER BY i ROWS 199 PRECEDING)"


def order_lines(spark, folder):
    """Order lines as a series with many rows of one day; the line's number decides their order."""
    return views.table(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS line", "l_returnflag AS symbol", "CAST(l_shipdate AS timestamp) AS datetime", "l_extendedprice AS close"
    )


_LONG = f"WITH {_LINES_OF}, {_long_sql('lines', 'datetime, line, "close"')}"


@query("sma_long", f"{_LONG} SELECT line, symbol, datetime, \"close\", {near_sql(_LONG_SMA)} AS sma_200 FROM moved")
def sma_long(spark, folder):
    return rounded(I.sma(order_lines(spark, folder), "close", 200), "sma_200")


@query(
    "rsi_long",
    f"""{_LONG}, {", ".join(_LONG_RSI)}
SELECT line, symbol, datetime, "close", {near_sql(_RSI)} AS rsi_14 FROM moved JOIN gains USING (symbol, i) JOIN losses USING (symbol, i)""",
)
def rsi_long(spark, folder):
    return rounded(I.rsi(order_lines(spark, folder), "close", 14), "rsi_14")


@query(
    "macd_long",
    f"""{_LONG}, {", ".join(_LONG_MACD)}
SELECT line, symbol, datetime, "close", {near_sql('macd')} AS macd, {near_sql('macd_signal')} AS macd_signal, {near_sql('macd - macd_signal')} AS macd_hist
FROM moved JOIN gap USING (symbol, i) JOIN signal USING (symbol, i)""",
)
def macd_long(spark, folder):
    return rounded(I.macd(order_lines(spark, folder)), "macd", "macd_signal", "macd_hist")


@query(
    "ema_ties",
    f"""WITH {TICKS_SQL}, hours AS (SELECT event_id, symbol, date_trunc('hour', datetime) AS datetime, "close" FROM ticks),
{_long_sql('hours', 'datetime, event_id')}, {", ".join(_LONG_EMA)}
SELECT event_id, symbol, datetime, "close", {near_sql('ema_50')} AS ema_50 FROM moved JOIN ema USING (symbol, i)""",
)
def ema_ties(spark, folder):
    """Ticks cut to the hour: many rows of one time, each with a value of its own."""
    ticks = views.ticks(spark, folder).select("event_id", "symbol", F.date_trunc("hour", "datetime").alias("datetime"), "close")
    return rounded(I.ema(ticks, "close", span=50), "ema_50")


@query(
    "gold_long",
    f"""WITH {TICKS_SQL}, {_long_sql('ticks', 'datetime, event_id')}, {", ".join([*_LONG_MACD, *_LONG_RSI, *_LONG_EMA])}
SELECT event_id, datetime, symbol, "close", {near_sql(_LONG_SMA)} AS sma_200, {near_sql('ema_50')} AS ema_50,
       {near_sql(_RSI)} AS rsi_14, {near_sql('macd')} AS macd, {near_sql('macd_signal')} AS macd_signal,
       {near_sql('macd - macd_signal')} AS macd_hist
FROM moved JOIN gap USING (symbol, i) JOIN signal USING (symbol, i) JOIN ema USING (symbol, i)
     JOIN gains USING (symbol, i) JOIN losses USING (symbol, i)""",
)
def gold_long(spark, folder):
    """All indicators of the raw ticks, which fill more than one block."""
    ticks = views.ticks(spark, folder).select("event_id", "datetime", "symbol", "close")
    return rounded(I.all_indicators(ticks), "sma_200", "ema_50", "rsi_14", "macd", "macd_signal", "macd_hist")


@query("gold_append", SQL["gold_long"])
def gold_append(spark, folder):
    """The indicators of ``gold_long``, appended in three parts by time; no part reads the rows of an earlier one."""
    ticks = views.ticks(spark, folder).select("event_id", "datetime", "symbol", "close")
    first, last = ticks.agg(F.min("datetime"), F.max("datetime")).first()
    store = IndicatorStore(spark, work_folder(spark, "gold-append"))
    edges = [first, first + (last - first) * 0.5, first + (last - first) * 0.8, None]
    for low, high in zip(edges, edges[1:], strict=False):
        part = ticks.filter(F.col("datetime") >= F.lit(low))
        store.append(part if high is None else part.filter(F.col("datetime") < F.lit(high)))
    return rounded(store.rows(), "sma_200", "ema_50", "rsi_14", "macd", "macd_signal", "macd_hist")


def _bucket_sql(width: str) -> str:
    if width in ("week", "month"):
        return f"CAST(date_trunc('{width}', datetime) AS TIMESTAMP)"
    return f"CAST(time_bucket(INTERVAL '{width}', datetime) AS TIMESTAMP)"


def _register_resample(interval: str, width: str) -> None:
    sql = f"WITH {TICKS_SQL}, {bars_sql(_bucket_sql(width))} SELECT * FROM bars"
    query(f"resample_{interval}", sql)(lambda spark, folder: views.bars(spark, folder, interval))


for _interval, _width in B.INTERVALS.items():
    _register_resample(_interval, _width)


@query(
    "last_n_bars",
    f"""WITH {TICKS_SQL}, {HOUR_SQL}
SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 50""",
)
def last_n_bars(spark, folder):
    return B.last_n_bars(views.bars(spark, folder, "hour_1"), 50)


@query(
    "last_n_ticks",
    f"""WITH {TICKS_SQL}
SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 1461""",
)
def last_n_ticks(spark, folder):
    return B.last_n_bars(views.ticks(spark, folder), 1461)


def _register_ties(n: int) -> None:
    sql = f"""SELECT event_id, event_type AS symbol, date_trunc('hour', ts) AS datetime FROM events
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC, event_id DESC) <= {n}"""

    def ties(spark, folder):
        hours = views.ticks(spark, folder).select("event_id", "symbol", F.date_trunc("hour", "datetime").alias("datetime"))
        return B.last_n_bars(hours, n)

    query(f"last_n_ties_{n}", sql)(ties)


# Many ticks have the same hour; both ways of cutting must agree on which come last.
for _n in (50, 1461):
    _register_ties(_n)


@query(
    "history",
    f"""WITH {TICKS_SQL}, {bars_sql(_bucket_sql("1 hour"))}
SELECT * FROM bars WHERE symbol = 'click' ORDER BY datetime DESC LIMIT 500""",
)
def history(spark, folder):
    return B.history(views.ticks(spark, folder), "click", "hour_1", 500)


_SPLITS = """splits AS (
    SELECT event_type AS symbol, ts AS effective, CASE (event_id // 400) % 3 WHEN 0 THEN 2.0 WHEN 1 THEN 0.5 ELSE 4.0 END AS factor
    FROM events WHERE event_id % 400 = 0),
later AS (
    SELECT event_id, product(factor) AS factor FROM raw JOIN splits ON raw.symbol = splits.symbol AND effective > datetime GROUP BY 1),
ticks AS (
    SELECT raw.* REPLACE ("close" / coalesce(factor, 1.0) AS "close", volume * coalesce(factor, 1.0) AS volume)
    FROM raw LEFT JOIN later USING (event_id))"""


@query(
    "history_adjusted",
    f"""WITH {TICKS_SQL.replace("ticks AS", "raw AS")}, {_SPLITS}, {bars_sql(_bucket_sql("1 hour"))}
SELECT * FROM bars WHERE symbol = 'click' ORDER BY datetime DESC LIMIT 500""",
)
def history_adjusted(spark, folder):
    """Hours of one symbol whose splits are every 400th event: two for one, one for two, four for one, in turn."""
    ticks = views.ticks(spark, folder)
    factor = F.element_at(F.array(F.lit(2.0), F.lit(0.5), F.lit(4.0)), (F.floor(F.col("event_id") / 400) % 3 + 1).cast("int"))
    splits = ticks.filter("event_id % 400 = 0").select("symbol", F.col("datetime").alias("effective"), factor.alias("factor"))
    return B.history(ticks, "click", "hour_1", 500, splits=splits)


WEEK = range(1, 6)
SESSIONS = [
    Session("XNYS", "regular", "America/New_York", WEEK, "09:30", "16:00"),
    Session("XNYS", "extended", "America/New_York", WEEK, "04:00", "20:00"),
    Session("XMAD", "regular", "Europe/Madrid", WEEK, "09:00", "17:35"),
    Session("XCME", "regular", "America/Chicago", [7, 1, 2, 3, 4], "17:00", "16:00"),
    Session("XNSE", "extended", "Asia/Kolkata", WEEK, "09:00", "16:00"),
]
EXCHANGES = {"view": "XNYS", "signup": "XMAD", "click": "XCME", "error": "XNSE"}
SHIFT_DAYS = 65  # moves the events over the clock changes of spring

_SESSION_SQL = f"""WITH {TICKS_SQL}, hours AS (
    SELECT exchange, kind, zone, unnest(weekdays) AS weekday, opens, closes, day_shift FROM (VALUES
        ('XNYS', 'regular', 'America/New_York', [1, 2, 3, 4, 5], 570, 960, 0), ('XNYS', 'extended', 'America/New_York', [1, 2, 3, 4, 5], 240, 1200, 0),
        ('XMAD', 'regular', 'Europe/Madrid', [1, 2, 3, 4, 5], 540, 1055, 0), ('XCME', 'regular', 'America/Chicago', [7, 1, 2, 3, 4], 1020, 1440, 0),
        ('XCME', 'regular', 'America/Chicago', [1, 2, 3, 4, 5], 0, 960, 1), ('XNSE', 'extended', 'Asia/Kolkata', [1, 2, 3, 4, 5], 540, 960, 0)
    ) t(exchange, kind, zone, weekdays, opens, closes, day_shift)),
zones AS (SELECT DISTINCT exchange, zone FROM hours),
placed AS (
    SELECT symbol, "close", volume, exchange, timezone(zone, timezone('UTC', datetime + INTERVAL {SHIFT_DAYS} DAY)) AS clock
    FROM ticks JOIN zones ON exchange = CASE symbol {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXCHANGES.items())} END),
open AS (
    SELECT symbol, "close", volume, clock, kind AS session, CAST(clock AS DATE) - day_shift AS trading_day
    FROM placed JOIN hours USING (exchange)
    WHERE isodow(clock) = weekday AND hour(clock) * 60 + minute(clock) >= opens AND hour(clock) * 60 + minute(clock) < closes)"""


@query(
    "history_sessions",
    f"""{_SESSION_SQL}
SELECT CAST(trading_day AS TIMESTAMP) AS datetime, symbol, session, arg_min("close", clock) AS open, max("close") AS high, min("close") AS low,
       arg_max("close", clock) AS "close", sum(volume) AS volume FROM open GROUP BY ALL""",
)
def history_sessions(spark, folder):
    """Daily bars of trading days on four exchanges, in regular and extended sessions, one of them overnight, across clock changes."""
    ticks = views.ticks(spark, folder).withColumn("datetime", F.col("datetime") + F.expr(f"INTERVAL {SHIFT_DAYS} DAYS"))
    names = F.create_map(*[F.lit(x) for pair in EXCHANGES.items() for x in pair])
    ticks = ticks.withColumn("exchange", F.try_element_at(names, F.col("symbol")))
    calendar = session_calendar(spark, SESSIONS)
    done = None
    for kind in ("regular", "extended"):
        rows = in_sessions(ticks, calendar, kind).withColumn("_clock", F.col("exchange_time"))
        bars = B.session_bars(rows.withColumn("datetime", F.col("trading_day").cast("timestamp")), "daily").withColumn("session", F.lit(kind))
        done = bars if done is None else done.unionByName(bars)
    return done


@query(
    "history_extended",
    f"""{_SESSION_SQL}
SELECT date_trunc('hour', clock) AS datetime, symbol, arg_min("close", clock) AS open, max("close") AS high, min("close") AS low,
       arg_max("close", clock) AS "close", sum(volume) AS volume
FROM open WHERE symbol = 'view' AND session = 'extended' GROUP BY ALL ORDER BY datetime DESC LIMIT 100""",
)
def history_extended(spark, folder):
    """The last hours of one symbol in its exchange's extended session, by the exchange's clock."""
    ticks = views.ticks(spark, folder).withColumn("datetime", F.col("datetime") + F.expr(f"INTERVAL {SHIFT_DAYS} DAYS"))
    named = ticks.withColumn("symbol", F.when(F.col("symbol") == "view", "XNYS:view").otherwise(F.col("symbol")))
    found = B.history(named, "view", "hour_1", 100, exchange="XNYS", calendar=session_calendar(spark, SESSIONS), session="extended")
    return found.withColumn("symbol", F.lit("view"))


@query(
    "week_slice",
    f"""WITH {TICKS_SQL}, {DAY_SQL}
SELECT *, dayname(datetime) AS dow, CAST(datetime AS DATE) AS date FROM bars
WHERE datetime BETWEEN date_trunc('week', DATE '2024-01-10') AND date_trunc('week', DATE '2024-01-10') + INTERVAL 7 DAY""",
)
def week_slice(spark, folder):
    """Only the ticks of the week and of the Monday after it are read."""
    monday, following = B.week_of("2024-01-10")
    bars = views.bars(spark, folder, "daily", monday, following + dt.timedelta(days=1))
    return B.week_slice(bars, None, "2024-01-10")


@query(
    "dedup_bars",
    f"""WITH best AS (
    SELECT o_custkey AS symbol, o_orderdate AS datetime, max(o_totalprice) AS "close" FROM orders GROUP BY 1, 2)
SELECT * FROM best""",
)
def dedup(spark, folder):
    orders = views.table(spark, folder, "orders")
    return dedup_bars(
        orders.selectExpr("o_custkey AS symbol", "CAST(o_orderdate AS timestamp) AS datetime", "o_totalprice AS close")
    )


@query(
    "vwap_total",
    f"""SELECT l_returnflag AS symbol,
       {near_sql('sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0)')} AS vwap
FROM lineitem GROUP BY 1""",
)
def vwap_total(spark, folder):
    return rounded(V.vwap(views.trades(spark, folder)), "vwap")


_WINDOWS = f"""WITH {TICKS_SQL}, windows AS (
    SELECT time_bucket(INTERVAL 1 MINUTE, datetime) - to_minutes(CAST(k AS INTEGER)) AS window_start,
           symbol, "close" * volume AS traded, volume
    FROM ticks, range(5) AS steps(k)),
vwaps AS (
    SELECT CAST(window_start AS TIMESTAMP) AS window_start,
           CAST(window_start + INTERVAL 5 MINUTE AS TIMESTAMP) AS window_end, symbol,
           {near_sql('sum(traded) / nullif(sum(volume), 0)')} AS vwap
    FROM windows GROUP BY window_start, symbol)"""


@query("vwap_batch", f"{_WINDOWS} SELECT * FROM vwaps")
def vwap_batch(spark, folder):
    return rounded(V.vwap_windows(views.ticks(spark, folder)), "vwap")


def candle_messages(spark, folder):
    """The events as a stream of candle messages."""
    schema = views.table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    fields = {
        "symbol": F.col("event_type"),
        "close": F.col("value"),
        "volume": F.get_json_object("props", "$.k").cast("double"),
        "timestamp_ms": F.unix_millis(F.col("ts").cast("timestamp")),
    }
    value = F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))
    return events.select(F.lit("candles").alias("topic"), value.alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))


@query(
    "vwap_stream",
    f"""{_WINDOWS}
SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S.%gZ') AS window_start,
       strftime(window_end, '%Y-%m-%dT%H:%M:%S.%gZ') AS window_end, symbol, vwap
FROM vwaps WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 MINUTE""",
)
def stream_vwap(spark, folder):
    vwaps = vwap_stream(parse_candles(candle_messages(spark, folder)))
    sent = drain(vwap_messages(vwaps), "vwap")
    return rounded(sent.select(F.from_json("value", VWAP_SCHEMA).alias("m")).select("m.*"), "vwap")


def _corrected(spark, folder, name):
    """The events as candles in three drops that each span the whole time, so most of the later two are late."""
    staged, inbox, out, checkpoint = (work_folder(spark, f"{name}-{part}") for part in ("staged", "inbox", "out", "checkpoint"))
    events = views.table(spark, folder, "events")
    events.withColumn("drop", F.col("event_id") % 3).write.partitionBy("drop").parquet(staged)
    for drop in range(3):
        spark.read.parquet(staged).filter(F.col("drop") == drop).drop("drop").write.mode("append").parquet(inbox)
        candles = spark.readStream.schema(events.schema).parquet(inbox).select(
            F.col("event_type").alias("symbol"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.col("value").alias("close"),
            F.get_json_object("props", "$.k").cast("double").alias("volume"),
        )
        correct_vwap(candles, out, checkpoint).awaitTermination()
    return out


@query("vwap_corrected", f"{_WINDOWS} SELECT window_start, window_end, symbol, vwap FROM vwaps")
def vwap_corrected(spark, folder):
    """The last version of every window of a stream whose rows mostly come late: the VWAP over all rows."""
    return rounded(corrected(spark, _corrected(spark, folder, "vwap-corrected")), "vwap")


@query(
    "vwap_versions",
    f"""WITH {TICKS_SQL}, windows AS (
    SELECT event_id % 3 AS version, symbol, time_bucket(INTERVAL 1 MINUTE, datetime) - to_minutes(k) AS window_start FROM ticks, range(5) t(k)
    WHERE "close" IS NOT NULL AND volume IS NOT NULL),
ends AS (SELECT event_id % 3 AS batch, max(datetime) AS last FROM ticks GROUP BY 1)
SELECT version, count(DISTINCT (symbol, window_start)) AS n_windows,
       count(DISTINCT (symbol, window_start)) FILTER (window_start + INTERVAL 6 MINUTE
           <= (SELECT date_trunc('millisecond', max(last)) FROM ends WHERE batch < version)) AS n_corrections
FROM windows GROUP BY 1""",
)
def vwap_versions(spark, folder):
    """How many windows each batch wrote, and how many of them the watermark had passed before."""
    written = versions(spark, _corrected(spark, folder, "vwap-versions"))
    return written.groupBy("version").agg(F.count(F.lit(1)).alias("n_windows"), F.count_if("correction").alias("n_corrections"))


@query(
    "parse_bar_payloads",
    f"""WITH {TICKS_SQL}, {DAY_SQL}, marked AS (
    SELECT *, (day(datetime) + length(symbol)) % 9 AS kind FROM bars),
broken AS (
    SELECT *, bool_or(kind < 4) OVER (PARTITION BY symbol, date_trunc('month', datetime) ORDER BY datetime) AS failed FROM marked)
SELECT datetime, symbol, CASE WHEN kind = 0 THEN 0.0 ELSE open END AS open, CASE WHEN kind = 1 THEN 0.0 ELSE high END AS high,
       CASE WHEN kind = 2 THEN 0.0 ELSE low END AS low, CASE WHEN kind = 2 THEN 0.0 ELSE "close" END AS "close",
       CASE WHEN failed THEN 0.0 ELSE volume END AS volume
FROM broken""",
)
def payloads(spark, folder):
    """Daily bars as one payload per symbol and month; of nine bars one has an empty open, one a junk high, one ends after the high, one has no volume."""
    kind = (F.dayofmonth("datetime") + F.length("symbol")) % 9
    fields = [
        F.format_string("%d.0", F.unix_seconds("datetime")),
        F.when(kind == 0, F.lit("")).otherwise(F.col("open").cast("string")),
        F.when(kind == 1, F.lit("abc")).otherwise(F.col("high").cast("string")),
        F.when(kind != 2, F.col("low").cast("string")),
        F.when(kind != 2, F.col("close").cast("string")),
        F.when((kind != 2) & (kind != 3), F.col("volume").cast("string")),
    ]
    bars = views.bars(spark, folder, "daily").withColumns({"month": F.date_trunc("month", "datetime"), "bar": F.concat_ws(",", *fields)})
    texts = (
        bars.groupBy("symbol", "month")
        .agg(F.array_sort(F.collect_list(F.struct("datetime", "bar"))).alias("days"))
        .withColumn(
            "series",
            F.array_join(F.expr("transform(days, (d, i) -> concat('{\"i\":', i, ',\"v\":[', d.bar, ']}'))"), ","),
        )
    )
    raw = F.concat(F.lit('~m~99~m~{"m":"timescale_update","p":["cs",{"s1":{"s":['), "series", F.lit('],"ns":{}}}]}\n'))
    return parse_bar_payloads(texts.select("symbol", raw.alias("raw")))
