"""Chunks, vector search, prompts and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from candlewick.session import stored

CHUNK_CHARS = 1000
CHUNK_OVERLAP = 200

# Queries up to this number go to every task; more are matched block by block.
BROADCAST_QUERIES = 2048
VECTORS_PER_BLOCK = 20_000
SLICE_ROWS = 2048  # vectors scored at a time, which keeps the score matrix small

# Texts of the assistant and the separator between chunks.
BASE_INSTRUCTION = "Eres un asistente útil que responde preguntas de forma clara y concisa en español."
CONTEXT_INSTRUCTION = (
    "\n\nUsa el siguiente contexto para responder. Si no es relevante, usa tu conocimiento general.\n\nCONTEXTO:\n"
)
CHUNK_SEPARATOR = "\n\n---\n\n"
# The characters that count as white space in Unicode.
BLANKS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NO_ACCESS = "No tienes acceso a la Knowledge Base."
NOT_CONFIGURED = "Knowledge Base no configurada."
DEFAULT_QUESTION = "Hola"


def chunk_documents(
    df: DataFrame, text: str = "text", size: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Overlapping pieces of each text, numbered from 0, as columns ``chunk_no`` and ``chunk``.

    The last piece reaches the end of the text; texts without characters give none.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    # One walk over the text: each match moves on by a step and looks ahead a whole chunk.
    pattern = f"(?s)(?=(.{{1,{size}}})).{{1,{step}}}"
    others = [name for name in df.columns if name != text]
    pieces = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    numbered = df.select(*others, F.length(text).alias("_length"), F.posexplode(pieces).alias("chunk_no", "chunk"))
    adds_text = (F.col("chunk_no") == 0) | (F.col("chunk_no") * step + overlap < F.col("_length"))
    return numbered.filter(adds_text).drop("_length")


def embedding_of(text: Column | str, embed: Callable[[list[str]], np.ndarray]) -> Column:
    """Embedding column from a function that maps a list of texts to one vector each."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(embed(texts.tolist()), dtype=np.float32)))

    return run(text)


def ingest_documents(
    df: DataFrame,
    embed: Callable[[list[str]], np.ndarray],
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    data_source: str = "documents",
    size: int = CHUNK_CHARS,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Documents as rows of a vector table: one per chunk, with embedding and origin."""
    chunks = chunk_documents(df.select(doc_id, source, text), text, size, overlap)
    return chunks.select(
        F.concat_ws("-", doc_id, "chunk_no").alias("chunk_id"),
        embedding_of("chunk", embed).alias("embedding"),
        F.col("chunk").alias("text"),
        F.lit(None).cast("string").alias("context"),
        F.to_json(F.struct(doc_id, "chunk_no")).alias("metadata"),
        F.col(source).cast("string").alias("source_uri"),
        F.lit(data_source).alias("data_source_id"),
    )


def checked_vectors(df: DataFrame, dim: int) -> DataFrame:
    """The same rows; a vector of another length raises an error."""
    message = F.concat(F.lit(f"embedding must have {dim} values, found "), F.size("embedding").cast("string"))
    wrong = F.raise_error(message).cast(T.ArrayType(T.FloatType()))
    return df.withColumn(
        "embedding", F.when(F.size("embedding") == dim, F.col("embedding").cast("array<float>")).otherwise(wrong)
    )


def write_vectors(df: DataFrame, path: str, dim: int, mode: str = "overwrite") -> None:
    checked_vectors(df, dim).write.mode(mode).parquet(path)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one; a row of zeros stays as it is and so scores 0."""
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths == 0, 1.0, lengths)


def _by_length(ids: pa.Array, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the finite vectors of each length; a vector with a null or NaN is in none."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[~np.isnan(lengths)] if lengths.dtype.kind == "f" else lengths):
        rows = pa.array(np.flatnonzero(lengths == length))
        flat = column.take(rows).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        matrix = flat.reshape(len(rows), int(length))
        good = np.isfinite(matrix).all(axis=1)
        if length and good.any():
            yield ids.take(rows).to_numpy(zero_copy_only=False)[good], matrix[good]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; of equal scores the lower id comes first."""
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


class _Candidates:
    """The k best vectors per query among those seen so far."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, _unit(queries), k
        self.scores = [np.empty(0)] * len(query_ids)
        self.ids: list[np.ndarray | None] = [None] * len(query_ids)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for start in range(0, len(ids), SLICE_ROWS):
            self._add_slice(ids[start : start + SLICE_ROWS], vectors[start : start + SLICE_ROWS])

    def _add_slice(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        similarity = self.queries @ _unit(vectors).T
        for row, fresh in enumerate(similarity):
            scores = np.concatenate([self.scores[row], fresh])
            known = self.ids[row]
            together = ids if known is None else np.concatenate([known, ids])
            best = _best(scores, together, self.k)
            self.scores[row], self.ids[row] = scores[best], together[best]

    def frame(self, names: Sequence[str]) -> pd.DataFrame:
        filled = [row for row, ids in enumerate(self.ids) if ids is not None]
        if not filled:
            return pd.DataFrame({name: [] for name in names})
        lengths = [len(self.ids[row]) for row in filled]
        return pd.DataFrame(
            {
                names[0]: np.repeat(self.query_ids[filled], lengths),
                names[1]: np.concatenate([self.ids[row] for row in filled]),
                names[2]: np.concatenate([self.scores[row] for row in filled]),
            }
        )


def vector_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    vector_id: str = "chunk_id",
    embedding: str = "embedding",
    broadcast_queries: int = BROADCAST_QUERIES,
) -> DataFrame:
    """The ``k`` most similar vectors per query by cosine: id, score and rank. Exact.

    Each task multiplies its vectors with the query matrix and keeps ``k``
    candidates per query, so scores of single pairs never leave a task. Up to
    ``broadcast_queries`` queries are sent to the tasks and the vectors stay
    where they are; more queries are cut into blocks that meet blocks of vectors.
    Only vectors of a query's own length are compared with it, and vectors or queries with a null, NaN or
    infinite value are left out, so ``k`` hits come back whenever ``k`` good vectors exist.
    """
    asked = queries.select(query_id, embedding).filter(F.col(embedding).isNotNull())
    known = vectors.select(vector_id, embedding).filter(F.col(embedding).isNotNull())
    schema = T.StructType([asked.schema[query_id], known.schema[vector_id], T.StructField("score", T.DoubleType())])
    few = asked.limit(broadcast_queries + 1).toArrow().combine_chunks()
    if few.num_rows <= broadcast_queries:
        partial = _against_broadcast(few, known, k, schema)
    else:
        partial = _against_blocks(asked, known, k, schema, broadcast_queries)
    ranked = Window.partitionBy(query_id).orderBy(F.desc("score"), vector_id)
    return partial.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def _searches(ids: pa.Array, embeddings: pa.Array, k: int) -> dict[int, _Candidates]:
    """One search per vector length."""
    return {matrix.shape[1]: _Candidates(own, matrix, k) for own, matrix in _by_length(ids, embeddings)}


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _against_broadcast(queries: pa.Table, vectors: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    names = schema.names
    spark = vectors.sparkSession
    if queries.num_rows == 0:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast((_whole(queries.column(0)), _whole(queries.column(1))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _searches(*shared.value, k)
        for batch in batches:
            for ids, matrix in _by_length(batch.column(0), batch.column(1)):
                if matrix.shape[1] in best:
                    best[matrix.shape[1]].add(ids, matrix)
        for found in best.values():
            frame = found.frame(names)
            if len(frame):
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return vectors.mapInArrow(search, schema)


def _against_blocks(
    queries: DataFrame, vectors: DataFrame, k: int, schema: T.StructType, queries_per_block: int
) -> DataFrame:
    names = schema.names
    query_id, vector_id = names[0], names[1]
    query_blocks = max(1, -(-queries.count() // queries_per_block))
    vector_blocks = max(1, -(-vectors.count() // VECTORS_PER_BLOCK))

    def block_of(column: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(blocks))

    def each(blocks: int) -> Column:
        return F.explode(F.expr(f"sequence(0L, {blocks - 1}L)"))

    left = queries.withColumn("_q", block_of(query_id, query_blocks)).withColumn("_v", each(vector_blocks))
    right = vectors.withColumn("_v", block_of(vector_id, vector_blocks)).withColumn("_q", each(query_blocks))

    def search(asked: pa.Table, known: pa.Table) -> pa.Table:
        best = _searches(_whole(asked.column(0)), _whole(asked.column(1)), k) if asked.num_rows else {}
        if best and known.num_rows:
            for ids, matrix in _by_length(_whole(known.column(0)), _whole(known.column(1))):
                if matrix.shape[1] in best:
                    best[matrix.shape[1]].add(ids, matrix)
        frames = [found.frame(names) for found in best.values()]
        frames = [frame for frame in frames if len(frame)]
        kinds = [to_arrow_type(field.dataType) for field in schema.fields]
        if not frames:
            return pa.table({name: pa.array([], kind) for name, kind in zip(names, kinds, strict=True)})
        return pa.Table.from_pandas(pd.concat(frames), preserve_index=False).cast(pa.schema(list(zip(names, kinds, strict=True))))

    columns = [query_id, queries.columns[1], "_q", "_v"], [vector_id, vectors.columns[1], "_q", "_v"]
    left, right = left.select(columns[0]), right.select(columns[1])
    return left.groupBy("_q", "_v").cogroup(right.groupBy("_q", "_v")).applyInArrow(search, schema)


def retrieve(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    vector_id: str = "chunk_id",
    text: str = "text",
    source: str = "source_uri",
) -> DataFrame:
    """Top chunks per query: rank, score, text (empty when missing) and location.

    The hits are stored before their texts are fetched: a short list is then
    broadcast, and the texts are scanned without a shuffle.
    """
    top = stored(vector_topk(queries, vectors, k, query_id, vector_id), "hits")
    return top.join(vectors.select(vector_id, text, source), vector_id, "left").select(
        query_id,
        "rank",
        vector_id,
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.struct(F.col(source).alias("uri")).alias("location"),
    )


def assemble_context(results: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Per query the non-empty chunk texts in rank order, joined, and how many there are."""
    in_order = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return (
        results.filter(F.length("text") > 0)
        .groupBy(query_id)
        .agg(in_order.alias("_chunks"))
        .select(
            query_id,
            F.array_join(F.transform("_chunks", lambda chunk: chunk["text"]), CHUNK_SEPARATOR).alias("context"),
            F.size("_chunks").alias("n_chunks"),
        )
    )


def trimmed(text: Column | str) -> Column:
    return F.trim(F.col(text) if isinstance(text, str) else text, F.lit(BLANKS))


def check_messages(df: DataFrame, text: str = "message") -> DataFrame:
    """Trimmed messages with a ``reason`` for those that are empty."""
    clean = df.withColumn(text, F.coalesce(trimmed(text), F.lit("")))
    return clean.withColumn("reason", F.when(F.col(text) == "", "empty message"))


def allowed(queries: DataFrame, access: DataFrame, user: str = "user_id") -> DataFrame:
    """Queries of users that may use the knowledge base."""
    return queries.join(access.select(user), user, "left_semi")


def access_check(queries: DataFrame, access: DataFrame, configured: bool = True, user: str = "user_id") -> DataFrame:
    """All queries with ``success`` and, for those that may not use the knowledge base, the ``error`` they are told.

    Without access comes before a base that is not configured; a null user has no access.
    """
    users = access.select(F.col(user).alias("_user"), F.lit(True).alias("_allowed")).distinct()
    joined = queries.join(users, F.col(user) == F.col("_user"), "left")
    error = F.when(F.col("_allowed").isNull(), NO_ACCESS)
    if not configured:
        error = error.otherwise(NOT_CONFIGURED)
    return joined.withColumn("error", error).withColumn("success", F.col("error").isNull()).drop("_user", "_allowed")


def question_of(payload: Column | str) -> Column:
    """The question of a JSON payload: its ``prompt`` if it has one, else its ``message``, else a greeting.

    As in the payload's own dictionary a field that is there with null or empty text counts as there.
    """
    fields = F.from_json(payload, "map<string,string>")
    has = [F.coalesce(F.map_contains_key(fields, name), F.lit(False)) for name in ("prompt", "message")]
    text = [F.try_element_at(fields, F.lit(name)) for name in ("prompt", "message")]
    return F.when(has[0], text[0]).when(has[1], text[1]).otherwise(DEFAULT_QUESTION)


def build_prompts(
    queries: DataFrame, contexts: DataFrame, query_id: str = "query_id", message: str = "message"
) -> DataFrame:
    """System text, user message and ``has_context`` per query; the context block only where there is context."""
    joined = queries.select(query_id, message).join(contexts.select(query_id, "context"), query_id, "left")
    context = F.coalesce("context", F.lit(""))
    return joined.select(
        query_id,
        F.when(context != "", F.concat(F.lit(BASE_INSTRUCTION + CONTEXT_INSTRUCTION), context))
        .otherwise(F.lit(BASE_INSTRUCTION))
        .alias("system_text"),
        F.col(message).alias("message"),
        (context != "").alias("has_context"),
    )


def answers_with_fallback(
    queries: DataFrame, primary: DataFrame, fallback: DataFrame, query_id: str = "query_id", configured: bool = True
) -> DataFrame:
    """The primary answer of each query, else the fallback's, which one it was, and ``has_context``: was there a knowledge base.

    Only the primary path can use the base; a query without any answer has no context either.
    """
    first = primary.select(query_id, F.col("response").alias("_first"))
    second = fallback.select(query_id, F.col("response").alias("_second"))
    return (
        queries.select(query_id)
        .join(first, query_id, "left")
        .join(second, query_id, "left")
        .select(
            query_id,
            F.coalesce("_first", "_second").alias("response"),
            F.when(F.col("_first").isNotNull(), "primary")
            .when(F.col("_second").isNotNull(), "fallback")
            .alias("source"),
            (F.col("_first").isNotNull() & F.lit(configured)).alias("has_context"),
        )
    )
