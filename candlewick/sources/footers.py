"""Row counts, null counts and ranges of Parquet layers from file footers, without reading a value.

Spark's own reader of the second generation answers ``count``, ``min`` and ``max`` from Parquet statistics. It is chosen
by session settings, so these jobs run in a session of their own on the same cluster, and their few result rows are
written to the work folder for the caller's session.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.quality import null_table
from candlewick.session import configure, work_folder

log = logging.getLogger(__name__)

# Footers hold shortened texts, and Spark does not take times from them.
IN_FOOTERS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)
_LACKING = "spark.sql.parquet.aggregatePushdown"  # named in the reader's error where a file has no statistics


def _footer_session(spark: SparkSession) -> SparkSession:
    session = configure(spark.newSession())
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def reads_footers_only(df: DataFrame) -> bool:
    """Is the whole aggregation answered from footers?"""
    return "PushedAggregation: [" in (plan := df._jdf.queryExecution().executedPlan().toString()) and "PushedAggregation: []" not in plan


def from_footers(spark: SparkSession, path: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """What ``build`` aggregates from the table at ``path``, by footers alone.

    None where that is not possible: a type without usable statistics, or a file that lacks them (an all-null column
    has no range; doubles with a NaN have none in files of some writers). Nothing is read but footers in that case either.
    """
    rows = build(_footer_session(spark).read.parquet(path))
    if not reads_footers_only(rows):
        return None
    folder = work_folder(spark, "footers")
    try:
        rows.write.parquet(folder)
    except (Py4JJavaError, PySparkException) as error:
        if _LACKING not in str(error):
            raise
        log.info("no statistics in some footers below %s", path)
        return None
    return spark.read.schema(rows.schema).parquet(folder)


def folder_counts(spark: SparkSession, path: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Per partition folder: ``n_rows``, and for every other column ``c`` its values that are not null as ``n_c``.

    ``partitions`` must name all partition columns of the table; without any there is one row.
    """
    names = [name for name in spark.read.parquet(path).columns if name not in partitions]

    def build(df: DataFrame) -> DataFrame:
        counts = [F.count(F.col(f"`{name}`")).alias(f"n_{name}") for name in names]
        return df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n_rows"), *counts)

    found = from_footers(spark, path, build)
    # Files without rows have no statistics to add up: their counts come as null.
    return build(spark.read.parquet(path)) if found is None else found.fillna(0, [name for name in found.columns if name not in partitions])


def null_profile_files(spark: SparkSession, path: str, partitions: Sequence[str] = ()) -> DataFrame:
    """The null profile of a Parquet table from its footers, partition columns from the folders' row counts."""
    schema = spark.read.parquet(path).schema
    counts = folder_counts(spark, path, partitions)

    def nulls(name: str) -> Column:
        rows = F.when(F.col(f"`{name}`").isNull(), F.col("n_rows")) if name in partitions else F.col("n_rows") - F.col(f"`n_{name}`")
        return F.coalesce(F.sum(rows), F.lit(0).cast("long"))

    total = F.coalesce(F.sum("n_rows"), F.lit(0).cast("long")).alias("_rows")
    return null_table(counts.agg(total, *[nulls(name).alias(f"_null_{i}") for i, name in enumerate(schema.names)]), schema)


def value_range_files(spark: SparkSession, path: str, column: str = "close") -> DataFrame:
    """Smallest and largest value of a column and its nulls, from footers where they hold them, else by a scan of this column.

    NaN is no value here, since some writers leave it out of the statistics; it counts as no null either. Without any value
    both ends are null.
    """
    kind = spark.read.parquet(path).schema[column].dataType
    value = F.col(f"`{column}`")
    floating = isinstance(kind, (T.FloatType, T.DoubleType))

    def build(df: DataFrame, of: Column = value) -> DataFrame:
        return df.agg(F.min(of).alias("_min"), F.max(of).alias("_max"), F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_n"))

    found = from_footers(spark, path, build) if isinstance(kind, IN_FOOTERS) else None
    if found is None:
        clean = F.when(~F.isnan(value), value) if floating else value
        found = build(spark.read.parquet(path), clean)
    # Footers hold a least zero as -0.0.
    end = lambda name: (F.col(name) + F.lit(0).cast(kind)) if floating else F.col(name)
    return found.select(end("_min").alias(f"min_{column}"), end("_max").alias(f"max_{column}"), F.coalesce(F.col("_rows") - F.col("_n"), F.lit(0).cast("long")).alias(f"null_{column}"))
