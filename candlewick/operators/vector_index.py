"""An approximate vector index: vectors stored by their nearest centroids, searched by probing the best few lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows the centroids are fitted on at most, and rounds of fitting.
SAMPLE_ROWS, ROUNDS = 20_000, 12
#: Queries, and vectors, that meet in one task, and scores held at a time.
BLOCK, SCORES = 16_384, 1 << 22


def _matrix(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the rows that have ``length`` finite entries, and their row numbers."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    at = np.flatnonzero(sizes == length)
    rows = np.asarray(column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(at), length)
    good = np.isfinite(rows).all(axis=1)
    rows, at = rows[good], at[good]
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1.0, norms), at


def fit_centroids(vectors: DataFrame, lists: int, embedding: str = "embedding", sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids by spherical k-means on at most ``sample_rows`` distinct vectors, chosen by hash over all rows.

    The most frequent length sets the length. The sample is bounded by the parameter; everything else covers every row.
    """
    known = vectors.filter(F.col(embedding).isNotNull() & (F.size(embedding) > 0)).select(embedding)
    common = known.groupBy(F.size(embedding).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return np.zeros((0, 0))
    own = known.filter(F.size(embedding) == common["n"]).distinct()
    share = min(1.0, 1.5 * sample_rows / max(own.count(), 1))
    chance = F.pmod(F.xxhash64(embedding), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    picked = own.filter(chance).orderBy(F.xxhash64(embedding, F.lit(1))).limit(sample_rows).toArrow()
    rows, _ = _matrix(picked.column(0).combine_chunks(), common["n"])
    if not len(rows):
        return np.zeros((0, common["n"]))
    rng = np.random.default_rng(5)
    centroids = rows[rng.choice(len(rows), min(lists, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(rows @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1.0), centroids)
    return centroids


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of the ``k`` highest scores of every row; of equal scores the first places."""
    edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k] if scores.shape[1] > k else scores.min(axis=1)
    row, place = np.nonzero(scores >= edge[:, None])
    order = np.lexsort((place, -scores[row, place], row))
    row, place = row[order], place[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], place[keep]


class VectorIndex:
    """A folder with the centroids and every usable vector in the list of its nearest centroid (``list=<n>``).

    Every row is in the index: rows of another length, and those with null, NaN or infinite entries, are not searchable
    by cosine and lie in no list. ``search`` looks into the ``probes`` best lists of each query and ranks what is there
    by the exact cosine; with ``probes`` as large as the number of lists it is the exact search.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, vectors: DataFrame, lists: int, vector_id: str = "chunk_id", embedding: str = "embedding", sample_rows: int = SAMPLE_ROWS) -> None:
        """Fit the centroids and write every vector by its list; large lists become several files, small ones share a task."""
        centroids = fit_centroids(vectors, lists, embedding, sample_rows)
        rows = [(n, c.tolist()) for n, c in enumerate(centroids)]
        self.spark.createDataFrame(rows, "list int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/centroids")
        chosen = self._nearest(vectors.select(F.col(vector_id).alias("id"), F.col(embedding).alias("embedding")), centroids, 1)
        chosen.hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(f"{self.path}/lists")

    def add(self, vectors: DataFrame, vector_id: str = "chunk_id", embedding: str = "embedding") -> None:
        """Append vectors to their lists; the centroids stay."""
        chosen = self._nearest(vectors.select(F.col(vector_id).alias("id"), F.col(embedding).alias("embedding")), self.centroids(), 1)
        chosen.hint("rebalance", "list").write.mode("append").partitionBy("list").parquet(f"{self.path}/lists")

    def centroids(self) -> np.ndarray:
        rows = self.spark.read.parquet(f"{self.path}/centroids").orderBy("list").collect()  # as many as lists
        return np.array([row["centroid"] for row in rows], np.float64) if rows else np.zeros((0, 0))

    def _nearest(self, rows: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
        """The rows with a usable vector, once for each of their ``probes`` nearest lists."""
        sent = self.spark.sparkContext.broadcast(centroids)  # lists times length numbers

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids = sent.value
            for batch in batches:
                vectors, at = _matrix(batch.column(1), centroids.shape[1])
                if not len(at) or not len(centroids):
                    continue
                many = min(probes, len(centroids))
                best = np.argsort(-(vectors @ centroids.T), axis=1, kind="stable")[:, :many]
                again = pa.array(np.repeat(at, many))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(again), batch.column(1).take(again), pa.array(best.ravel().astype(np.int32))], names=["id", "embedding", "list"]
                )

        schema = T.StructType([rows.schema["id"], rows.schema["embedding"], T.StructField("list", T.IntegerType())])
        return rows.mapInArrow(run, schema)

    def search(self, queries: DataFrame, k: int = 5, probes: int = 8, query_id: str = "query_id", embedding: str = "embedding", block: int = BLOCK) -> DataFrame:
        """``query_id``, ``id``, ``score`` (cosine) and ``rank`` of the ``k`` best vectors found in each query's lists.

        Queries and vectors of a list meet in blocks of about ``block`` queries and as many vectors, so a list with a third of
        all vectors spreads over many tasks, and what a task holds does not grow with the number of either; of a block only ``k``
        candidates a query leave it. Ids are of a plain type; of equal scores the least ids come first.
        """
        asked = self._nearest(queries.select(F.col(query_id).alias("id"), F.col(embedding).alias("embedding")), self.centroids(), probes)
        try:
            stored = self.spark.read.parquet(f"{self.path}/lists")
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            kinds = [T.StructField(query_id, queries.schema[query_id].dataType), T.StructField("id", T.LongType())]
            return self.spark.createDataFrame([], T.StructType([*kinds, T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]))

        def numbers(rows: DataFrame) -> Column:
            """How many blocks the rows of a list are dealt to; 0 for a list without rows."""
            sizes = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")).collect()  # one number a list
            known = F.create_map(*[F.lit(x) for row in sizes for x in (row["list"], row["blocks"])]) if sizes else F.lit(None).cast("map<int,int>")
            return F.coalesce(F.try_element_at(known, F.col("list")), F.lit(0))

        def dealt(rows: DataFrame, own: str, mine: Column, other: str, theirs: Column) -> DataFrame:
            """Every row in its block of its own side, once for each block of the other side."""
            placed = rows.filter((mine > 0) & (theirs > 0)).withColumn(own, F.pmod(F.xxhash64("id", "embedding"), mine).cast("int"))
            return placed.withColumn(other, F.explode(F.sequence(F.lit(0), theirs - 1)))

        queries_of, vectors_of = numbers(asked), numbers(stored)
        mine = dealt(asked, "_query", queries_of, "_vector", vectors_of)
        theirs = dealt(stored, "_vector", vectors_of, "_query", queries_of)
        id_kind = stored.schema["id"].dataType

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            kinds = {"query": left.schema.field("id").type, "id": right.schema.field("id").type, "score": pa.float64()}
            found = [pa.table({name: pa.array([], kind) for name, kind in kinds.items()})]
            if left.num_rows and right.num_rows:
                length = len(left.column("embedding")[0])
                asked, a = _matrix(left.column("embedding").combine_chunks(), length)
                known, b = _matrix(right.column("embedding").combine_chunks(), length)
                names, ids = left.column("id").combine_chunks().take(pa.array(a)), right.column("id").combine_chunks().take(pa.array(b))
                order = pc.array_sort_indices(ids, null_placement="at_start")
                known, ids = known[np.asarray(order)], ids.take(order)
                step = max(1, SCORES // max(len(known), 1))
                for low in range(0, len(asked) if len(known) else 0, step):
                    scores = asked[low : low + step] @ known.T
                    row, place = _best(scores, k)
                    found.append(pa.table({"query": names.take(pa.array(low + row)), "id": ids.take(pa.array(place)), "score": pa.array(scores[row, place])}))
            return pa.concat_tables(found)

        schema = T.StructType([T.StructField("query", asked.schema["id"].dataType), T.StructField("id", id_kind), T.StructField("score", T.DoubleType())])
        keys = ["list", "_query", "_vector"]
        found = mine.groupBy(keys).cogroup(theirs.groupBy(keys)).applyInArrow(meet, schema)
        ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        return best.select(F.col("query").alias(query_id), "id", "score", "rank")
