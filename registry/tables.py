"""Cleaning, quality checks, layers and catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick import views
from candlewick.operators import bars as B
from candlewick.operators import clean as C
from candlewick.operators import quality as Q
from candlewick.operators.kept_stats import DescribeStore, year_folder
from candlewick.plans.gold import silver
from candlewick.schemas import BAR_SCHEMA, LAYER_PARTITIONS
from candlewick.session import work_folder
from candlewick.sources import footers, lake
from registry import DAY_SQL, HOUR_SQL, TICKS_SQL, near_sql, query, rounded

_BAD = [  # which rows of the dirty view get which fault
    ("datetime", "event_id % 17 = 0", "'not a date'"),
    ("symbol", "event_id % 17 = 3", "NULL"),
    ("close", "event_id % 17 = 1", "'n/a'"),
    ("close", "event_id % 17 = 4", "'NaN'"),
    ("volume", "event_id % 17 = 2", "NULL"),
]


def _dirty_columns(quote: str) -> str:
    columns = []
    for name in BAR_SCHEMA.names:
        source = "close" if name in ("open", "high", "low") else name
        column = f"CAST({quote}{source}{quote} AS {'string' if quote == '`' else 'VARCHAR'})"
        cases = "".join(f" WHEN {when} THEN {value}" for column_name, when, value in _BAD if column_name == name)
        columns.append(f"CASE{cases} ELSE {column} END AS {quote}{name}{quote}" if cases else f"{column} AS {quote}{name}{quote}")
    return ", ".join(columns)


_NUMBER = 'CASE WHEN NOT isnan(TRY_CAST("{0}" AS DOUBLE)) THEN TRY_CAST("{0}" AS DOUBLE) END AS "{0}"'
_TYPED = ", ".join(
    ["TRY_CAST(datetime AS TIMESTAMP) AS datetime", "symbol", *[_NUMBER.format(n) for n in BAR_SCHEMA.names[2:]]]
)
_DIRTY = f"""WITH {TICKS_SQL}, dirty AS (SELECT event_id, {_dirty_columns('"')} FROM ticks),
typed AS (SELECT event_id, {_TYPED} FROM dirty)"""


def _dirty(spark, folder):
    """Ticks as text with faults: bad dates, bad numbers, missing symbols and volumes."""
    ticks = views.ticks(spark, folder)
    return spark.sql(f"SELECT event_id, {_dirty_columns('`')} FROM {{ticks}}", ticks=ticks)


@query("coerce_types", f"{_DIRTY} SELECT * FROM typed WHERE datetime IS NOT NULL AND symbol IS NOT NULL AND \"close\" IS NOT NULL")
def coerce_types(spark, folder):
    return C.drop_incomplete(C.normalize_bars(_dirty(spark, folder)))


@query(
    "null_profile",
    f"{_DIRTY}, counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) FILTER (WHERE \"{name}\" IS NULL) AS null_count, count(*) AS n, "
        f"'{kind}' AS dtype FROM typed"
        for name, kind in [("event_id", "bigint"), *[(f.name, f.dataType.simpleString()) for f in BAR_SCHEMA.fields]]
    )
    + ') SELECT "column", null_count, round_even(100.0 * null_count / n, 3) AS null_pct, dtype FROM counts',
)
def null_profile(spark, folder):
    return Q.null_profile(C.normalize_bars(_dirty(spark, folder)))


@query(
    "quality_report",
    f"""{_DIRTY}, keys AS (SELECT symbol, datetime, count(*) AS n FROM typed GROUP BY 1, 2)
SELECT (SELECT count(*) FROM typed) AS n_rows, (SELECT CAST(sum(n - 1) AS BIGINT) FROM keys) AS duplicate_keys,
       count(*) FILTER (WHERE datetime IS NULL) AS invalid_datetimes,
       count(*) FILTER (WHERE high < low) AS high_below_low,
       count(*) FILTER (WHERE "close" < low OR "close" > high) AS close_outside
FROM typed""",
)
def quality_report(spark, folder):
    return Q.quality_report(C.normalize_bars(_dirty(spark, folder)))


@query(
    "normalize_bars",
    f"""WITH {TICKS_SQL}, {HOUR_SQL}
SELECT symbol, datetime, "close", CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month,
       'avalanche' AS crypto FROM bars""",
)
def normalize_bars(spark, folder):
    bars = views.bars(spark, folder, "hour_1")
    padded = bars.toDF(*[f" {name} " for name in bars.columns])
    typed = C.add_layer_columns(C.drop_incomplete(C.normalize_bars(padded), ["datetime"]), "avalanche")
    return C.sort_bars(typed.select("symbol", "datetime", "close", "year", "month", "crypto"))


_ORDERS = "dates AS (SELECT o_orderkey, o_custkey AS symbol, o_orderdate AS datetime, o_totalprice AS \"close\" FROM orders)"


def _dates(spark, folder):
    return views.table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey AS symbol", "CAST(o_orderdate AS timestamp) AS datetime", "o_totalprice AS close"
    )


@query("dup_keys", f"WITH {_ORDERS}, n AS (SELECT symbol, datetime, count(*) AS n FROM dates GROUP BY 1, 2) SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_keys FROM n")
def dup_keys(spark, folder):
    return Q.duplicate_count(_dates(spark, folder))


@query(
    "dup_rows",
    f"WITH {_ORDERS} SELECT * FROM dates QUALIFY count(*) OVER (PARTITION BY symbol, datetime) > 1",
)
def dup_rows(spark, folder):
    return Q.duplicated_rows(_dates(spark, folder))


@query(
    "mark_repeats",
    f"""WITH {_ORDERS}
SELECT *, row_number() OVER (PARTITION BY symbol, datetime ORDER BY o_orderkey) > 1 AS repeat FROM dates""",
)
def mark_repeats(spark, folder):
    return Q.mark_repeats(_dates(spark, folder), ["o_orderkey"])


@query(
    "top_duplicates",
    f"""WITH {_ORDERS}, copies AS (SELECT * FROM dates QUALIFY count(*) OVER (PARTITION BY symbol, datetime) > 1)
SELECT * FROM copies ORDER BY datetime, symbol, o_orderkey LIMIT 20""",
)
def top_duplicates(spark, folder):
    return B.first_rows(Q.duplicated_rows(_dates(spark, folder)), 20, "datetime", "symbol", "o_orderkey")


@query(
    "ohlc_sanity",
    f"""WITH {TICKS_SQL}, {HOUR_SQL}, swapped AS (
    SELECT symbol, datetime, open, "close", CASE WHEN hour(datetime) % 7 = 0 THEN low ELSE high END AS high,
           CASE WHEN hour(datetime) % 7 = 0 THEN high ELSE low END AS low FROM bars)
SELECT symbol, count(*) FILTER (WHERE high < low) AS high_below_low,
       count(*) FILTER (WHERE "close" < low OR "close" > high) AS close_outside
FROM swapped GROUP BY symbol""",
)
def ohlc_sanity(spark, folder):
    bars = views.bars(spark, folder, "hour_1")
    turned = F.hour("datetime") % 7 == 0
    swapped = bars.select(
        "symbol",
        "close",
        F.when(turned, F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(turned, F.col("high")).otherwise(F.col("low")).alias("low"),
    )
    return swapped.groupBy("symbol").agg(*Q.ohlc_sanity())


def _describe_sql(name: str, column: str) -> str:
    stats = {
        "mean": f"avg({column})",
        "std": f"stddev_samp({column})",
        "min": f"min({column})",
        "q25": f"quantile_cont({column}, 0.25)",
        "q50": f"quantile_cont({column}, 0.5)",
        "q75": f"quantile_cont({column}, 0.75)",
        "max": f"max({column})",
    }
    parts = ", ".join(f"{near_sql(sql)} AS {alias}" for alias, sql in stats.items())
    return f"SELECT l_returnflag AS symbol, '{name}' AS \"column\", count({column}) AS count, {parts} FROM lineitem GROUP BY 1"


_DESCRIBE = f"{_describe_sql('close', 'l_extendedprice')} UNION ALL {_describe_sql('volume', 'l_quantity')}"
_STATS = ["mean", "std", "min", "q25", "q50", "q75", "max"]


@query("describe_by_symbol", _DESCRIBE)
def describe_by_symbol(spark, folder):
    stats = Q.describe_by(views.trades(spark, folder))
    return rounded(stats, *_STATS)


@query("describe_kept", _DESCRIBE)
def describe_kept(spark, folder):
    """The same, from what was kept of each year's trades; the years from 1997 come as an addition."""
    trades = views.trades(spark, folder).withColumn("folder", year_folder())
    store = DescribeStore(spark, work_folder(spark, "kept-describe"), chunk=256)
    store.add(trades.filter("year(datetime) < 1997"), ["close", "volume"])
    store.add(trades.filter("coalesce(year(datetime), 9999) >= 1997"), ["close", "volume"])
    return rounded(store.read().withColumnRenamed("key", "symbol"), *_STATS)


@query(
    "coverage_4y",
    f"""WITH {_ORDERS}, spans AS (
    SELECT symbol, min(datetime) AS "start", max(datetime) AS "end" FROM dates GROUP BY symbol)
SELECT symbol, "start", "end", CAST("start" + INTERVAL 4 YEAR AS TIMESTAMP) AS target_end,
       CAST(epoch_us("end") - epoch_us("start") AS DOUBLE) / 86400000000 AS delta_days,
       abs(epoch_us("end") - epoch_us("start" + INTERVAL 4 YEAR)) <= 172800000000 AS ok,
       CAST(2 AS INTEGER) AS tolerance_days, CAST(NULL AS VARCHAR) AS reason
FROM spans""",
)
def coverage_4y(spark, folder):
    return Q.coverage_check(_dates(spark, folder))


@query(
    "gap_check",
    """WITH dates AS (
    SELECT o_custkey AS symbol, CASE WHEN o_orderkey % 5 <> 0 AND o_custkey % 7 <> 0 THEN o_orderdate END AS datetime FROM orders),
spans AS (
    SELECT symbol, count(*) AS n_rows, count(DISTINCT datetime) AS n_times, count(*) FILTER (WHERE datetime IS NULL) AS n_null,
           coalesce(date_diff('day', min(datetime), max(datetime)) + 1, 0) AS expected
    FROM dates GROUP BY symbol)
SELECT symbol, n_rows, n_times, n_rows - n_times - CAST(n_null > 0 AS BIGINT) AS n_repeated, expected, expected - n_times AS missing FROM spans""",
)
def gap_check(spark, folder):
    """Order dates per customer; a fifth of the dates and all of some customers' are missing."""
    known = (F.col("o_orderkey") % 5 != 0) & (F.col("symbol") % 7 != 0)
    return Q.gap_check(_dates(spark, folder).withColumn("datetime", F.when(known, F.col("datetime"))))


@query(
    "missing_days",
    """WITH dates AS (
    SELECT c_nationkey AS symbol, o_orderdate AS datetime FROM orders JOIN customer ON o_custkey = c_custkey),
spans AS (SELECT symbol, min(datetime) AS a, max(datetime) AS b FROM dates GROUP BY symbol),
spine AS (SELECT symbol, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS datetime FROM spans)
SELECT symbol, datetime FROM spine ANTI JOIN dates USING (symbol, datetime)""",
)
def missing_days(spark, folder):
    """Days between a nation's first and last order without any order."""
    customers = views.table(spark, folder, "customer").selectExpr("c_custkey AS symbol", "c_nationkey")
    dates = _dates(spark, folder).join(customers, "symbol").selectExpr("c_nationkey AS symbol", "datetime")
    return Q.missing_days(dates)


@query(
    "missing_runs",
    """WITH dates AS (
    SELECT DISTINCT c_nationkey AS symbol, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN TIMESTAMP '2199-12-31' ELSE o_orderdate END AS datetime
    FROM orders JOIN customer ON o_custkey = c_custkey),
following AS (SELECT *, lead(datetime) OVER (PARTITION BY symbol ORDER BY datetime) AS later FROM dates)
SELECT symbol, datetime + INTERVAL 1 DAY AS first_missing, later - INTERVAL 1 DAY AS last_missing, date_diff('day', datetime, later) - 1 AS n_missing
FROM following WHERE date_diff('day', datetime, later) > 1""",
)
def missing_runs(spark, folder):
    """Runs of days without an order per nation; one order is dated long ahead."""
    customers = views.table(spark, folder, "customer").selectExpr("c_custkey AS symbol", "c_nationkey")
    orders = views.table(spark, folder, "orders")
    first = orders.agg(F.min("o_orderkey")).first()[0]
    far = F.when(F.col("o_orderkey") == first, F.lit("2199-12-31").cast("timestamp")).otherwise(F.col("datetime"))
    dates = _dates(spark, folder).withColumn("datetime", far)
    return Q.gap_intervals(dates.join(customers, "symbol").selectExpr("c_nationkey AS symbol", "datetime"), block=64)


@query(
    "close_range",
    f"""{_DIRTY} SELECT min("close") AS min_close, max("close") AS max_close,
       count(*) FILTER (WHERE "close" IS NULL) AS null_close FROM typed""",
)
def close_range(spark, folder):
    return Q.value_range(C.normalize_bars(_dirty(spark, folder)))


def _typed_layer(spark, folder):
    """The dirty ticks, typed, as a layer in folders; rows without a time share one."""
    path = work_folder(spark, "typed-layer")
    lake.write_layer(C.add_layer_columns(C.normalize_bars(_dirty(spark, folder)), "avalanche"), path)
    return path


@query(
    "null_profile_files",
    f"{_DIRTY}, counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) FILTER (WHERE {value} IS NULL) AS null_count, count(*) AS n, '{kind}' AS dtype FROM typed"
        for name, value, kind in [
            ("event_id", "event_id", "bigint"),
            *[(f.name, f'"{f.name}"', f.dataType.simpleString()) for f in BAR_SCHEMA.fields],
            *[("crypto", "'avalanche'", "string"), ("year", "datetime", "int"), ("month", "datetime", "int")],
        ]
    )
    + ') SELECT "column", null_count, round_even(100.0 * null_count / n, 3) AS null_pct, dtype FROM counts',
)
def null_profile_files(spark, folder):
    return footers.null_profile_files(spark, _typed_layer(spark, folder), LAYER_PARTITIONS)


@query(
    "close_range_files",
    f"""{_DIRTY} SELECT min("close") AS min_close, max("close") AS max_close,
       count(*) FILTER (WHERE "close" IS NULL) AS null_close FROM typed""",
)
def close_range_files(spark, folder):
    return footers.value_range_files(spark, _typed_layer(spark, folder), "close")


_LAYER = f"""WITH {TICKS_SQL}, {DAY_SQL}
SELECT datetime, symbol, open, high, low, "close", volume, 'avalanche' AS crypto,
       CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month FROM bars"""


def _bronze(spark, folder, name):
    path = work_folder(spark, name)
    lake.write_bronze(views.bars(spark, folder, "daily"), path, "avalanche")
    return path


@query("bronze_silver_roundtrip", _LAYER)
def bronze_silver_roundtrip(spark, folder):
    path = work_folder(spark, "silver")
    lake.write_layer(silver(lake.read_bronze(spark, _bronze(spark, folder, "bronze"))), path)
    return spark.read.parquet(path)


@query(
    "csv_to_parquet",
    f"""WITH {TICKS_SQL}, {DAY_SQL}
SELECT datetime, symbol, open, high, low, "close", volume,
       strftime(datetime, 'crypto=avalanche/year=%Y/month=%m') AS rel_dir,
       strftime(datetime, '/source/crypto=avalanche/year=%Y/month=%m/') AS folder FROM bars""",
)
def csv_to_parquet(spark, folder):
    path = work_folder(spark, "converted")
    lake.csv_to_parquet(spark, _bronze(spark, folder, "source"), path)
    # Work folders have names of their own, and so have files: compare what lies between.
    between = F.regexp_replace("source_file", "^.*/source-[^/]*(/.*/)[^/]*$", "/source$1")
    return spark.read.parquet(path).withColumn("folder", between).drop("source_file")


@query(
    "csv_mixed_headers",
    f"""WITH {TICKS_SQL}
SELECT event_id, symbol, datetime, "close", CASE WHEN event_id % 3 = 2 THEN volume END AS volume,
       CAST(NULL AS VARCHAR) AS note, 'part=' || event_id % 3 AS rel_dir, '/part=' || event_id % 3 || '/' AS folder
FROM ticks""",
)
def csv_mixed_headers(spark, folder):
    """Files with two orders of columns, one with a column more, and one with nothing but a header."""
    source, path = work_folder(spark, "mixed"), work_folder(spark, "mixed-converted")
    ticks = views.ticks(spark, folder)
    orders = [["event_id", "symbol", "datetime", "close"], ["close", "datetime", "event_id", "symbol"], ["symbol", "volume", "close", "event_id", "datetime"]]
    for number, columns in enumerate(orders):
        lake.export_csv(ticks.filter(F.col("event_id") % 3 == number).select(columns), f"{source}/part={number}")
    lake.export_csv(ticks.limit(0).select("symbol", "event_id", F.lit("").alias("note")).coalesce(1), f"{source}/part=3")
    lake.csv_to_parquet(spark, source, path)
    between = F.regexp_extract("source_file", "(/part=[0-9]/)[^/]*$", 1)
    return spark.read.parquet(path).withColumn("folder", between).drop("source_file")


@query("register_layer", _LAYER)
def register_layer(spark, folder):
    path = work_folder(spark, "layer")
    lake.write_layer(C.add_layer_columns(views.bars(spark, folder, "daily"), "avalanche"), path)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    return lake.register_layer(spark, "market", table, path, database_path=work_folder(spark, "database"))


@query(
    "export_csv",
    f'WITH {TICKS_SQL} SELECT event_id, symbol, datetime, "close", volume FROM ticks',
)
def export_csv(spark, folder):
    path = work_folder(spark, "export")
    ticks = views.ticks(spark, folder)
    lake.export_csv(ticks, path)
    return spark.read.schema(ticks.schema).option("header", True).csv(path)


def _found_type(column: str) -> str:
    """SQL for the type that a scan of a text column finds."""
    fits = lambda kind: f"count(*) FILTER (WHERE \"{column}\" IS NOT NULL AND TRY_CAST(\"{column}\" AS {kind}) IS NULL) = 0"
    whole = f"bool_and(regexp_full_match(\"{column}\", '[+-]?[0-9]+'))"
    return (
        f"CASE WHEN {whole} AND {fits('INTEGER')} THEN 'int' WHEN {whole} AND {fits('BIGINT')} THEN 'bigint' "
        f"WHEN {fits('DOUBLE')} THEN 'double' WHEN {fits('TIMESTAMP')} THEN 'timestamp' ELSE 'string' END"
    )


@query(
    "schema_drift",
    f"{_DIRTY}, found AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {kind} AS old_type, {_found_type(name)} AS new_type FROM dirty"
        for name, kind in [("event_id", "CAST(NULL AS VARCHAR)"), *[(f.name, f"'{f.dataType.simpleString()}'") for f in BAR_SCHEMA.fields]]
    ).replace('"event_id"', 'CAST(event_id AS VARCHAR)')
    + """)
SELECT "column", CASE WHEN old_type IS NULL THEN 'added' ELSE 'type' END AS change, old_type, new_type
FROM found WHERE old_type IS DISTINCT FROM new_type""",
)
def schema_drift(spark, folder):
    """What a scan of the dirty ticks' CSV files finds, against the bar table."""
    path = work_folder(spark, "drift")
    lake.export_csv(_dirty(spark, folder), path)
    return lake.schema_drift(spark, lake.read_bronze(spark, path, any_folders=True).schema, BAR_SCHEMA)
