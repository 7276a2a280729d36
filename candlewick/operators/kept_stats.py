"""Count, mean, deviation and exact quartiles kept up to date: a new folder costs a scan of that folder only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.operators.quality import QUARTILES
from candlewick.session import release, stored

_GROUP = ["key", "column"]
_VALUES = "key string, column string, value double, n long, chunk long, folder string"
_CHUNKS = "key string, column string, chunk long, low double, high double, n long, folder string"
_MOMENTS = "key string, column string, n long, mean double, m2 double, folder string"


class DescribeStore:
    """What :func:`candlewick.operators.quality.describe_by` tells of a table that grows by folders.

    Three tables below ``path``, each in ``folder=`` folders: the distinct values of every key and column with their
    counts, sorted and cut into chunks of ``chunk`` values; each chunk's least and greatest value and rows; count, mean and
    squared deviations. Chunks of all folders together bound the place of any rank, so :meth:`read` adds up a
    row per chunk and looks at values only in the few chunks that may hold a quartile. The result is exact.

    Nulls and NaN are no values; null keys are left out; a key with no value at all has a count of 0. Keys are
    kept as text. A folder added again replaces what was kept of it; moments are written last, and a folder without them does not count,
    so an ``add`` that broke off is simply done again; while a folder is replaced, reads of it are not defined. One writer at a time.

    Per key and column one window orders a row per chunk, and another the values between the bounds of a rank, about
    ``chunk`` for each folder; a folder should therefore be a day or more, not a micro-batch.
    """

    def __init__(self, spark: SparkSession, path: str, chunk: int = 4096, most_ranges: int = 512):
        self.spark, self.path, self.chunk, self.most_ranges = spark, path.rstrip("/"), chunk, most_ranges

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def folders(self) -> DataFrame:
        """The folders added so far."""
        return self._table("moments", _MOMENTS).select("folder").distinct()

    def _replace(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(f"{self.path}/{name}")

    def add(self, df: DataFrame, columns: Sequence[str], key: str = "symbol", folder: str = "folder") -> None:
        """Keep the rows of one or more folders; ``df`` holds whole folders only, named by the column ``folder``."""
        entries = F.array(*[F.struct(F.lit(name).alias("column"), F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double")).alias("value")) for name in columns])
        rows = df.filter(F.col(key).isNotNull()).select(F.col(folder).cast("string").alias("folder"), F.col(key).cast("string").alias("key"), F.explode(entries).alias("_e"))
        rows = rows.select("folder", "key", "_e.*")
        # Copies of a value merge before the shuffle; range partitions then split also the values of one hot key.
        counted = rows.groupBy("folder", *_GROUP, "value").agg(F.count(F.lit(1)).alias("n"))
        counted = stored(counted, "kept-counts")
        order = ["folder", *_GROUP, "value"]
        placed = counted.filter("value IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
        # The number is that of the task and the row's place in it, so a chunk is a run of neighbours of one task.
        placed = placed.withColumn("chunk", F.floor(F.monotonically_increasing_id() / F.lit(self.chunk)))
        placed = stored(placed, "kept-values")
        self._replace(placed, "values")
        self._replace(
            placed.groupBy("folder", *_GROUP, "chunk").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n")), "chunks"
        )
        groups = ["folder", *_GROUP]
        weight = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
        means = counted.groupBy(*groups).agg(F.sum(weight).alias("n"), F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(weight)).alias("mean"))
        means = stored(means, "kept-means")
        squares = counted.join(means.select(*groups, "mean"), groups).groupBy(*groups).agg(
            F.coalesce(F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2))), F.lit(0.0)).alias("m2")
        )
        self._replace(means.join(squares, groups), "moments")
        release(counted, placed, means)

    def read(self) -> DataFrame:
        """Per key and column: count, mean, std, min, quartiles, max over all folders, rounded to 6 places."""
        done = self.folders()
        moments = self._table("moments", _MOMENTS)
        chunks = self._table("chunks", _CHUNKS).join(done, "folder", "left_semi")
        totals = stored(
            moments.groupBy(*_GROUP).agg(F.sum("n").alias("count"), F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("mean")), "kept-totals"
        )
        far = F.col("n") * F.pow(F.col("part") - F.col("mean"), F.lit(2))
        spread = (
            moments.withColumnRenamed("mean", "part").join(totals.select(*_GROUP, "mean"), _GROUP)
            .groupBy(*_GROUP).agg((F.sum("m2") + F.coalesce(F.sum(far), F.lit(0.0))).alias("m2"))
        )
        ranges = stored(self._ranges(chunks, totals), "kept-ranges")
        quartiles = self._ranked(chunks, ranges, done)
        stats = totals.join(spread, _GROUP).join(quartiles, _GROUP, "left")
        deviation = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
        floats = ["mean", "std", "min", *QUARTILES, "max"]
        return stats.withColumn("std", deviation).select(*_GROUP, "count", *[F.bround(name, 6).alias(name) for name in floats])

    def _ranges(self, chunks: DataFrame, totals: DataFrame) -> DataFrame:
        """Per key, column and quartile: the values between which its two ranks lie for sure (``a`` to ``b``).

        Rows below a value are at most those of the chunks that begin below it, and rows up to a value at least those of the
        chunks that end there; both sums are exact.
        """
        running = lambda by: F.sum("n").over(Window.partitionBy(*_GROUP).orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
        lows = chunks.groupBy(*_GROUP, "low").agg(F.sum("n").alias("n")).withColumn("below", running("low") - F.col("n"))
        highs = chunks.groupBy(*_GROUP, "high").agg(F.sum("n").alias("n")).withColumn("upto", running("high"))
        size = totals.select(*_GROUP, "count")
        first = {name: F.floor((F.col("count") - 1) * F.lit(p)) for name, p in QUARTILES.items()}
        second = {name: F.least(rank + 1, F.col("count") - 1) for name, rank in first.items()}
        starts = lows.join(size, _GROUP).groupBy(*_GROUP, "count").agg(
            F.min("low").alias("min"), *[F.max(F.when(F.col("below") <= rank, F.col("low"))).alias(f"_a_{name}") for name, rank in first.items()]
        )
        ends = highs.join(size, _GROUP).groupBy(*_GROUP).agg(
            F.max("high").alias("max"), *[F.min(F.when(F.col("upto") > rank, F.col("high"))).alias(f"_b_{name}") for name, rank in second.items()]
        )
        each = [
            F.struct(F.lit(name).alias("quartile"), ((F.col("count") - 1) * F.lit(p)).alias("at"), F.col(f"_a_{name}").alias("a"), F.col(f"_b_{name}").alias("b"))
            for name, p in QUARTILES.items()
        ]
        return starts.join(ends, _GROUP).select(*_GROUP, "min", "max", F.explode(F.array(*each)).alias("_q")).select(*_GROUP, "min", "max", "_q.*")

    def _ranked(self, chunks: DataFrame, ranges: DataFrame, done: DataFrame) -> DataFrame:
        """The quartiles, from the values of the chunks that reach into their ranges."""
        reach = chunks.join(ranges.select(*_GROUP, "quartile", "a", "b"), _GROUP).filter("low <= b")
        before = reach.groupBy(*_GROUP, "quartile").agg(F.sum(F.when(F.col("high") < F.col("a"), F.col("n")).otherwise(0)).alias("before"))
        straddling = stored(reach.filter("high >= a").select("folder", *_GROUP, "chunk", "quartile", "a", "b", "low"), "kept-pointed")
        values = self._values(straddling, done)
        pointed = values.join(straddling.drop("low"), ["folder", *_GROUP, "chunk"]).filter("value <= b")
        # Values below the range are only counted, those inside merged over all folders and put in order.
        merged = pointed.groupBy(*_GROUP, "quartile", F.greatest(F.col("value"), F.col("a")).alias("_v"), (F.col("value") < F.col("a")).alias("_below")).agg(F.sum("n").alias("n"))
        base = merged.filter("_below").groupBy(*_GROUP, "quartile").agg(F.sum("n").alias("inside"))
        base = before.join(base, [*_GROUP, "quartile"], "left").select(*_GROUP, "quartile", (F.col("before") + F.coalesce("inside", F.lit(0))).alias("_base"))
        order = Window.partitionBy(*_GROUP, "quartile").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        ranked = merged.filter("NOT _below").withColumn("_upto", F.sum("n").over(order)).join(base, [*_GROUP, "quartile"])
        ranked = ranked.join(ranges, [*_GROUP, "quartile"]).withColumn("_upto", F.col("_upto") + F.col("_base")).withColumn("_from", F.col("_upto") - F.col("n"))
        rank = F.floor("at")
        holds = lambda r: (F.col("_from") <= r) & (F.col("_upto") > r)
        share = F.col("at") - rank
        part = F.when(holds(rank), F.col("_v") * (1 - share)).otherwise(0.0) + F.when(holds(rank + 1) & (share > 0), F.col("_v") * share).otherwise(0.0)
        return ranked.groupBy(*_GROUP, "min", "max").agg(*[F.sum(F.when(F.col("quartile") == name, part)).alias(name) for name in QUARTILES])

    def _values(self, straddling: DataFrame, done: DataFrame) -> DataFrame:
        """The kept values. Up to ``most_ranges`` ranges go to the scan as filters, which skip row groups of the sorted files; beyond, the join alone picks them."""
        values = self._table("values", _VALUES).join(done, "folder", "left_semi")
        spans = straddling.groupBy(*_GROUP, "quartile").agg(F.min("low").alias("low"), F.max("b").alias("b")).limit(self.most_ranges + 1).collect()
        if not spans or len(spans) > self.most_ranges:
            return values
        wanted = F.lit(False)
        for span in spans:
            wanted = wanted | ((F.col("key") == span["key"]) & (F.col("column") == span["column"]) & F.col("value").between(span["low"], span["b"]))
        return values.filter(wanted)


def year_folder(time: str | Column = "datetime") -> Column:
    """A folder name per year of a time; rows without a time share one."""
    return F.coalesce(F.year(time).cast("string"), F.lit("none"))
