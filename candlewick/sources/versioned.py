"""A keyed table kept up to date: the last version of every key, in buckets of which a merge rewrites only those it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.operators.measures import latest_version

_MANIFEST = "generation long, bucket int, file_generation long, n_rows long"


class VersionedTable:
    """A folder with ``data/generation=g/bucket=b`` and one manifest folder per generation.

    A manifest lists for every bucket the generation that holds it, and is written last: readers see the state before
    or after a merge, never between, and a merge that broke off is done again over its own leftovers. One
    writer at a time. ``buckets`` is fixed when the table is first written; choose it so that a bucket is a good
    size for a few tasks. ``compact`` puts all buckets into one generation, so older data folders can go.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, key: Sequence[str], version: str = "Version", buckets: int = 64):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.version, self.buckets = list(key), version, buckets

    def bucket(self) -> Column:
        """Which bucket a row's key belongs to."""
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def manifest(self) -> DataFrame:
        """The newest manifest; empty before the first merge."""
        try:
            all_of = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _MANIFEST)
        newest = all_of.agg(F.max("generation")).first()[0]
        return all_of.filter(F.col("generation") == newest)

    def _state(self) -> dict[int, tuple[int, int]]:
        """Bucket to (generation that holds it, its rows); as many entries as buckets."""
        return {row["bucket"]: (row["file_generation"], row["n_rows"]) for row in self.manifest().collect()}

    def generation(self) -> int:
        return self.manifest().agg(F.max("generation")).first()[0] or 0

    def _read(self, state: dict[int, tuple[int, int]]) -> DataFrame:
        folders = [f"{self.path}/data/generation={generation}/bucket={bucket}" for bucket, (generation, rows) in state.items() if rows]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        """The table as it is: one row per key."""
        return self._read(self._state())

    def merge(self, delta: DataFrame) -> list[int]:
        """Put the rows of ``delta`` in: per key the highest version stays, of equal versions the greatest row. Returns the rewritten buckets.

        Versions of one key are merged before the shuffle, so a hot key costs one row per task. Merging the same rows again
        changes nothing.
        """
        rows = delta.select(self.spark.createDataFrame([], self.schema).columns)
        touched = sorted(row["b"] for row in rows.select(self.bucket().alias("b")).distinct().collect())  # at most ``buckets``
        if not touched:
            return []
        state = self._state()
        old = self._read({b: state[b] for b in touched if b in state})
        self._write(latest_version(old.unionByName(rows), self.key, self.version), state, touched)
        return touched

    def compact(self) -> None:
        """Write every bucket anew into one generation."""
        state = self._state()
        if state:
            self._write(self._read(state), state, sorted(state))

    def _write(self, rows: DataFrame, state: dict[int, tuple[int, int]], touched: list[int]) -> None:
        generation = self.generation() + 1
        folder = f"{self.path}/data/generation={generation}"
        dealt = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        counts = {row["bucket"]: row["n"] for row in self.spark.read.parquet(folder).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        new = state | {b: (generation, counts.get(b, 0)) for b in touched}
        listed = self.spark.createDataFrame([(generation, b, g, n) for b, (g, n) in new.items()], _MANIFEST)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/part-of={generation}")
