"""Chunks, vector search, prompts and answers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from candlewick import views
from candlewick.operators import retrieval as R
from candlewick.operators.vector_index import VectorIndex
from candlewick.session import stored, work_folder
from registry import near, near_sql, query, rounded

_STEP = R.CHUNK_CHARS - R.CHUNK_OVERLAP

_CHUNKS = f"""chunks AS (
    SELECT doc_id, source, CAST(k AS INTEGER) AS chunk_no, substr(text, k * {_STEP} + 1, {R.CHUNK_CHARS}) AS chunk
    FROM (SELECT doc_id, source, text, unnest(range(greatest(1, CAST(ceil((length(text) - {R.CHUNK_OVERLAP}) / {_STEP}.0) AS BIGINT)))) AS k
          FROM documents WHERE length(text) > 0))"""


@query("chunk_documents", f"WITH {_CHUNKS} SELECT doc_id, chunk_no, chunk FROM chunks")
def chunk_documents(spark, folder):
    return R.chunk_documents(views.table(spark, folder, "documents").select("doc_id", "text"))


def text_shape(texts):
    """A small stand-in for an embedding model: characters, blanks and line breaks of a text."""
    return np.array([[len(t), t.count(" "), t.count("\n")] for t in texts], dtype=np.float32)


@query(
    "ingest_documents",
    f"""WITH {_CHUNKS}
SELECT doc_id || '-' || chunk_no AS chunk_id, CAST(length(chunk) AS BIGINT) AS characters,
       CAST(length(chunk) - length(replace(chunk, ' ', '')) AS BIGINT) AS blanks,
       CAST(length(chunk) - length(replace(chunk, chr(10), '')) AS BIGINT) AS breaks,
       chunk AS text, source AS source_uri, 'documents' AS data_source_id
FROM chunks""",
)
def ingest_documents(spark, folder):
    path = work_folder(spark, "knowledge")
    R.write_vectors(R.ingest_documents(views.table(spark, folder, "documents"), text_shape), path, 3)
    parts = {name: F.col("embedding")[i].cast("long") for i, name in enumerate(("characters", "blanks", "breaks"))}
    return (
        spark.read.parquet(path)
        .withColumns(parts)
        .select("chunk_id", *parts, "text", "source_uri", "data_source_id")
    )


def knowledge(spark, folder):
    """Stored vectors with the document of the same number as their text."""
    vectors = views.table(spark, folder, "embeddings").selectExpr("vec_id AS chunk_id", "embedding")
    texts = views.table(spark, folder, "documents").selectExpr("doc_id AS chunk_id", "text", "source AS source_uri")
    return vectors.join(texts, "chunk_id", "left")


def centres(spark, folder):
    """One query per label: the mean of all its vectors."""
    places = views.table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("place", "value"))
    means = places.groupBy("label", "place").agg(F.avg(F.col("value").cast("double")).alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    return means.groupBy("label").agg(ordered.alias("places")).select(
        F.col("label").alias("query_id"),
        F.concat(F.lit("  Pregunta sobre el grupo "), F.col("label"), F.lit("\n")).alias("message"),
        F.transform("places", lambda p: p["value"]).alias("embedding"),
    )


_TOP = """parts AS (SELECT label, unnest(embedding) AS value, generate_subscripts(embedding, 1) AS place FROM embeddings),
means AS (SELECT label, place, avg(CAST(value AS DOUBLE)) AS value FROM parts GROUP BY 1, 2),
centres AS (SELECT label AS query_id, list(value ORDER BY place) AS centre FROM means GROUP BY 1),
scored AS (
    SELECT query_id, vec_id AS chunk_id, list_cosine_similarity(centre, CAST(embedding AS DOUBLE[])) AS score
    FROM centres, embeddings),
top AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank
    FROM scored QUALIFY rank <= 5),
found AS (
    SELECT top.*, coalesce(d.text, '') AS text, d.source FROM top LEFT JOIN documents d ON d.doc_id = top.chunk_id),
contexts AS (
    SELECT query_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context,
           CAST(count(*) AS INTEGER) AS n_chunks
    FROM found WHERE length(text) > 0 GROUP BY 1)"""


@query("vector_topk", f"WITH {_TOP} SELECT query_id, rank, chunk_id, {near_sql('score')} AS score FROM top")
def vector_topk(spark, folder):
    vectors = views.table(spark, folder, "embeddings").selectExpr("vec_id AS chunk_id", "embedding")
    top = R.vector_topk(centres(spark, folder), vectors)
    return rounded(top, "score").select("query_id", "rank", "chunk_id", "score")


_NEAREST = """asked AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings WHERE vec_id % 100 = 0),
scored AS (SELECT query_id, vec_id AS id, list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])) AS score FROM asked, embeddings),
top AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM scored QUALIFY rank <= 5)"""


def indexed(spark, folder, name, lists):
    vectors = views.table(spark, folder, "embeddings").select("vec_id", "embedding")
    index = VectorIndex(spark, work_folder(spark, name))
    index.build(vectors.filter("vec_id % 2 = 0"), lists, "vec_id")
    index.add(vectors.filter("vec_id % 2 <> 0"), "vec_id")
    return index, vectors.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")


@query("vector_index_whole", f"WITH {_NEAREST} SELECT query_id, rank, id, {near_sql('score')} AS score FROM top")
def vector_index_whole(spark, folder):
    """Every 100th vector against an index of all, half of it added later; all lists are probed, so the search is exact."""
    index, asked = indexed(spark, folder, "index-whole", 8)
    return rounded(index.search(asked, 5, probes=8), "score").select("query_id", "rank", "id", "score")


@query("vector_index_recall", "SELECT CAST(count(*) AS BIGINT) AS n_queries, TRUE AS enough FROM embeddings WHERE vec_id % 100 = 0")
def vector_index_recall(spark, folder):
    """Whether three quarters of the lists hold nine tenths of the five nearest vectors of every 100th one."""
    index, asked = indexed(spark, folder, "index-recall", 16)
    near = stored(index.search(asked, 5, probes=12).select("query_id", "id"), "index-found")
    exact = R.vector_topk(asked, views.table(spark, folder, "embeddings").selectExpr("vec_id AS id", "embedding"), 5, vector_id="id")
    hit = near.withColumn("hit", F.lit(True))
    both = exact.select("query_id", "id").join(hit, ["query_id", "id"], "left")
    return both.agg(F.count_distinct("query_id").alias("n_queries"), (F.avg(F.coalesce("hit", F.lit(False)).cast("int")) >= 0.9).alias("enough"))


_DIRTY_TOP = """parts AS (SELECT label, unnest(embedding) AS value, generate_subscripts(embedding, 1) AS place FROM embeddings),
means AS (SELECT label, place, avg(CAST(value AS DOUBLE)) AS value FROM parts GROUP BY 1, 2),
centres AS (SELECT label, list(value ORDER BY place) AS centre FROM means GROUP BY 1),
asked AS (
    SELECT CAST(label AS VARCHAR) AS query_id, centre FROM centres
    UNION ALL SELECT 'short ' || label, centre[1:8] FROM centres),
good AS (
    SELECT vec_id AS chunk_id, CAST(CASE WHEN vec_id % 11 = 0 THEN embedding[1:8] ELSE embedding END AS DOUBLE[]) AS vector
    FROM embeddings WHERE vec_id % 7 <> 0),
pairs AS (SELECT * FROM asked JOIN good ON len(centre) = len(vector)),
scored AS (SELECT query_id, chunk_id, list_cosine_similarity(centre, vector) AS score FROM pairs),
top AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank
    FROM scored QUALIFY rank <= 5)"""


def dirty_search(spark, folder, **options):
    """Two lengths of queries against vectors, of which a seventh holds a NaN and an eleventh is short."""
    nan = "CAST('NaN' AS FLOAT)"
    spoilt = f"CASE WHEN vec_id % 7 = 0 THEN transform(embedding, (x, i) -> if(i = 3, {nan}, x)) WHEN vec_id % 11 = 0 THEN slice(embedding, 1, 8) ELSE embedding END"
    vectors = views.table(spark, folder, "embeddings").selectExpr("vec_id AS chunk_id", f"{spoilt} AS embedding")
    whole = centres(spark, folder).selectExpr("CAST(query_id AS string) AS query_id", "embedding")
    short = whole.selectExpr("concat('short ', query_id) AS query_id", "slice(embedding, 1, 8) AS embedding")
    top = R.vector_topk(whole.unionByName(short), vectors, **options)
    return rounded(top, "score").select("query_id", "rank", "chunk_id", "score")


_DIRTY_SQL = f"WITH {_DIRTY_TOP} SELECT query_id, rank, chunk_id, {near_sql('score')} AS score FROM top"


@query("vector_topk_dirty", _DIRTY_SQL)
def vector_topk_dirty(spark, folder):
    return dirty_search(spark, folder)


@query("vector_topk_dirty_blocks", _DIRTY_SQL)
def vector_topk_dirty_blocks(spark, folder):
    """The same with more queries than are sent to every task."""
    return dirty_search(spark, folder, broadcast_queries=3)


@query("retrieve", f"WITH {_TOP} SELECT query_id, rank, chunk_id, {near_sql('score')} AS score, text, source AS uri FROM found")
def retrieve(spark, folder):
    results = R.retrieve(centres(spark, folder), knowledge(spark, folder))
    return results.select("query_id", "rank", "chunk_id", near("score").alias("score"), "text", "location.uri")


@query("rag_context", f"WITH {_TOP} SELECT query_id, context, n_chunks FROM contexts")
def rag_context(spark, folder):
    return R.assemble_context(R.retrieve(centres(spark, folder), knowledge(spark, folder)))


def _sql_text(text: str) -> str:
    return " || chr(10) || ".join(f"'{part}'" for part in text.split("\n"))


@query(
    "rag_prompts",
    f"""WITH {_TOP}
SELECT centres.query_id, {_sql_text(R.BASE_INSTRUCTION)} || CASE WHEN context IS NULL THEN '' ELSE {_sql_text(R.CONTEXT_INSTRUCTION)} || context END AS system_text,
       'Pregunta sobre el grupo ' || centres.query_id AS message, context IS NOT NULL AS has_context
FROM centres LEFT JOIN contexts USING (query_id)""",
)
def rag_prompts(spark, folder):
    queries = centres(spark, folder)
    contexts = R.assemble_context(R.retrieve(queries, knowledge(spark, folder)))
    accepted = R.check_messages(queries).filter("reason IS NULL")
    return R.build_prompts(accepted, contexts)


@query(
    "answer_fallback",
    """WITH answers AS (
    SELECT conv_id AS query_id, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS first,
           arg_max(text, turn) FILTER (WHERE role = 'user') AS second
    FROM conversations GROUP BY 1)
SELECT query_id, coalesce(first, second) AS response,
       CASE WHEN first IS NOT NULL THEN 'primary' WHEN second IS NOT NULL THEN 'fallback' END AS source,
       first IS NOT NULL AS has_context FROM answers""",
)
def answer_fallback(spark, folder):
    """Last assistant turn of each conversation, else the last user turn."""
    turns = views.table(spark, folder, "conversations").withColumnRenamed("conv_id", "query_id")

    def last(role):
        said = turns.filter(F.col("role") == role)
        return said.groupBy("query_id").agg(F.max(F.struct("turn", "text")).getField("text").alias("response"))

    return R.answers_with_fallback(turns.select("query_id").distinct(), last("assistant"), last("user"))


@query(
    "question_choice",
    """SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 4 < 2 THEN text WHEN (conv_id + turn) % 4 = 2 THEN role ELSE 'Hola' END AS question
FROM conversations""",
)
def question_choice(spark, folder):
    """The question of payloads with a prompt, a prompt and a message, a message only, or neither."""
    kind = (F.col("conv_id") + F.col("turn")) % 4
    payload = F.struct(
        F.when(kind < 2, F.col("text")).alias("prompt"),
        F.when((kind == 1) | (kind == 2), F.col("role")).alias("message"),
        F.lit("s").alias("session"),
    )
    turns = views.table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", R.question_of(F.to_json(payload)).alias("question"))


_BLANK_CHARS = " || ".join(f"chr({ord(c)})" for c in R.BLANKS)


@query(
    "check_messages",
    f"""WITH turns AS (
    SELECT conv_id, turn, CASE WHEN turn % 5 = 3 THEN '' ELSE trim(text, {_BLANK_CHARS}) END AS message
    FROM conversations)
SELECT *, CASE WHEN message = '' THEN 'empty message' END AS reason FROM turns""",
)
def check_messages(spark, folder):
    """Messages between blanks of all kinds, every fifth of nothing else."""
    blanks = " \n\u00a0\t\u3000\u2003\x1c"
    text = F.when(F.col("turn") % 5 == 3, blanks).otherwise(F.concat(F.lit(blanks), "text", F.lit("\u2009\u00a0 ")))
    turns = views.table(spark, folder, "conversations").select("conv_id", "turn", text.alias("message"))
    return R.check_messages(turns)


@query(
    "allowed_queries",
    f"""SELECT event_id, user_id, event_type, b.user_id IS NOT NULL AS success,
       CASE WHEN b.user_id IS NULL THEN '{R.NO_ACCESS}' END AS error
FROM events LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase') b USING (user_id)""".replace("SELECT event_id, user_id,", "SELECT event_id, events.user_id AS user_id,"),
)
def allowed_queries(spark, folder):
    """Events of all users; only those that have bought something may ask, the others are told why not."""
    events = views.table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return R.access_check(events, events.filter(F.col("event_type") == "purchase").select("user_id"))


@query(
    "denied_queries",
    f"""SELECT event_id, CASE WHEN user_id % 2 = 0 THEN '{R.NO_ACCESS}' ELSE '{R.NOT_CONFIGURED}' END AS error FROM events""",
)
def denied_queries(spark, folder):
    """Without a knowledge base everybody is denied, for one reason or the other."""
    events = views.table(spark, folder, "events").select("event_id", "user_id")
    access = events.select("user_id").filter(F.col("user_id") % 2 != 0)
    return R.access_check(events, access, configured=False).select("event_id", "error")


@query(
    "vector_table",
    f"""SELECT vec_id AS chunk_id, CAST(len(embedding) AS INTEGER) AS dim,
       {near_sql('list_sum(CAST(embedding AS DOUBLE[]))')} AS total FROM embeddings""",
)
def vector_table(spark, folder):
    path = work_folder(spark, "vectors")
    vectors = views.table(spark, folder, "embeddings").selectExpr("vec_id AS chunk_id", "embedding")
    R.write_vectors(vectors, path, 64)
    total = F.expr("aggregate(embedding, 0D, (sum, v) -> sum + v)")
    return spark.read.parquet(path).select("chunk_id", F.size("embedding").alias("dim"), near(total).alias("total"))
