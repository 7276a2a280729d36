"""Delivery of a stream's rows to several tables, each with its own errors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Writes the rows of a batch for one table; called again with the same rows after a failure, so it must replace what it wrote before.
TableWriter = Callable[[DataFrame, str, int], None]

_LEDGER = "batch long, table string, event string, n_rows long, error string"


def folder_writer(path: str) -> TableWriter:
    """A folder per table and batch; a batch that is written again replaces its own."""

    def write(rows: DataFrame, table: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{table}/batch={batch}")

    return write


class Delivery:
    """Rows with a column ``table`` go from a stream to that table, through ``folder``.

    A batch is staged once, by table. Then each table is written by itself, and a ledger has a row for
    every staged, written and failed (batch, table). A table that fails is logged and tried again with the next batch or by
    ``deliver``; the other tables go on. What the ledger calls written is never written again; a write
    that ended without its row is done again over itself.
    """

    def __init__(self, spark: SparkSession, folder: str, write: TableWriter):
        self.spark, self.folder, self.write = spark, folder.rstrip("/"), write

    def ledger(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LEDGER).parquet(f"{self.folder}/ledger")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LEDGER)

    def _log(self, events: list[tuple]) -> None:
        if events:
            self.spark.createDataFrame(events, _LEDGER).coalesce(1).write.mode("append").parquet(f"{self.folder}/ledger")

    def pending(self) -> list[tuple[int, str, int]]:
        """What is staged and not written, oldest first: as many entries as tables, and more only while one fails."""
        events = self.ledger().groupBy("batch", "table").agg(
            F.bool_or(F.col("event") == "written").alias("done"), F.max(F.when(F.col("event") == "staged", F.col("n_rows"))).alias("n_rows")
        )
        rows = events.filter("NOT done AND n_rows IS NOT NULL").orderBy("batch", "table").collect()
        return [(row["batch"], row["table"], row["n_rows"]) for row in rows]

    def stage(self, rows: DataFrame, batch: int) -> None:
        path = f"{self.folder}/staged/batch={batch}"
        rows.write.mode("overwrite").partitionBy("table").parquet(path)
        staged = rows.sparkSession.read.schema(rows.schema).parquet(path)
        counts = staged.groupBy("table").agg(F.count(F.lit(1)).alias("n")).collect()
        self._log([(batch, row["table"], "staged", row["n"], None) for row in counts])

    def deliver(self) -> int:
        """Try everything that is pending; returns how many writes failed."""
        events, failed = [], 0
        for batch, table, n_rows in self.pending():
            try:
                self.write(self.spark.read.parquet(f"{self.folder}/staged/batch={batch}/table={table}"), table, batch)
                events.append((batch, table, "written", n_rows, None))
            except Exception as error:  # any error of one table's writer is that table's own
                events.append((batch, table, "failed", n_rows, f"{type(error).__name__}: {error}"[:2000]))
                failed += 1
        self._log(events)
        return failed

    def run(self, stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Deliver a stream; without ``every`` it takes all input there is and stops."""

        def batch_of(rows: DataFrame, batch: int) -> None:
            self.stage(rows, batch)
            self.deliver()

        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch_of)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
