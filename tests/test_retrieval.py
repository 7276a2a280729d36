import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.operators import retrieval as R


def texts_of(spark, text, size, overlap):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    return [row["chunk"] for row in R.chunk_documents(df, size=size, overlap=overlap).orderBy("chunk_no").collect()]


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 3), (7, 6), (1, 0)])
@pytest.mark.parametrize("length", [1, 6, 7, 10, 11, 17, 18, 100])
def test_chunks_cover_the_text(spark, size, overlap, length):
    text = ("aé\n😀 z" * 40)[:length]
    chunks = texts_of(spark, text, size, overlap)
    step = size - overlap
    count = max(1, -(-(len(text) - overlap) // step))
    assert chunks == [text[i * step : i * step + size] for i in range(count)]
    assert chunks[-1] == text[(count - 1) * step :]


def test_no_text_no_chunk(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "doc_id int, text string")
    assert R.chunk_documents(df).count() == 0
    with pytest.raises(ValueError):
        R.chunk_documents(df, size=5, overlap=5)


def vectors(spark, matrix, name):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


def brute_force(queries, stored, k):
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    scores = unit(queries) @ unit(stored).T
    return {(q, v, r + 1) for q in range(len(queries)) for r, v in enumerate(np.lexsort((np.arange(len(stored)), -scores[q]))[:k])}


@pytest.mark.parametrize("limit", [100, 3])
def test_topk_is_exact_with_few_and_many_queries(spark, limit):
    rng = np.random.default_rng(5)
    stored = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    stored[100:200] = stored[100]  # a third of the vectors are copies
    stored[7] = 0
    queries = rng.normal(size=(10, 8)).astype(np.float32).astype(float)
    queries[0] = stored[100]
    top = R.vector_topk(vectors(spark, queries, "query_id"), vectors(spark, stored, "chunk_id").repartition(7), 5, broadcast_queries=limit)
    rows = top.collect()
    # Copies differ by rounding at most, so compare scores, and ids where they are clear.
    assert len(rows) == 50
    best = {(r["query_id"], r["rank"]): r["score"] for r in rows}
    unit = lambda m: m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1, n)
    scores = np.sort(unit(queries) @ unit(stored).T, axis=1)[:, ::-1]
    for (query, rank), score in best.items():
        assert abs(score - scores[query, rank - 1]) < 1e-12
    others = {(r["query_id"], r["chunk_id"], r["rank"]) for r in rows if r["query_id"] != 0 and not 100 <= r["chunk_id"] < 200}
    assert others <= brute_force(queries, stored, 5)


def test_topk_skips_vectors_of_other_length_and_missing_ones(spark):
    stored = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, None)], "chunk_id long, embedding array<float>")
    top = R.vector_topk(vectors(spark, np.array([[1.0, 0.0]]), "query_id"), stored)
    assert [(r["chunk_id"], r["score"]) for r in top.collect()] == [(1, 1.0)]
    none = R.vector_topk(vectors(spark, np.array([[1.0, 0.0]]), "query_id").limit(0), stored)
    assert none.count() == 0


def test_topk_plan_has_no_cross_join(spark):
    one = vectors(spark, np.eye(3), "chunk_id")
    plan = R.vector_topk(one.withColumnRenamed("chunk_id", "query_id"), one)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_wrong_dimension_is_refused(spark, tmp_path):
    df = vectors(spark, np.eye(3), "chunk_id")
    R.write_vectors(df, str(tmp_path / "ok"), 3)
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 3
    with pytest.raises(Exception, match="embedding must have 4 values, found 3"):
        R.write_vectors(df, str(tmp_path / "bad"), 4)


def test_from_question_to_prompt(spark):
    docs = spark.createDataFrame([(1, "uno", "s1"), (2, "dos", "s2"), (3, "", "s3")], "doc_id int, text string, source string")
    embed = lambda texts: np.array([[1.0, len(t)] for t in texts])
    table = R.ingest_documents(docs, embed)
    assert {(r["chunk_id"], r["source_uri"], r["metadata"]) for r in table.collect()} == {
        ("1-0", "s1", '{"doc_id":1,"chunk_no":0}'), ("2-0", "s2", '{"doc_id":2,"chunk_no":0}'),
    }
    asked = spark.createDataFrame([(1, " ¿uno? \n"), (2, "\t"), (3, "sin contexto")], "query_id int, message string")
    checked = R.check_messages(asked)
    assert {r["query_id"]: r["reason"] for r in checked.collect()} == {1: None, 2: "empty message", 3: None}
    queries = checked.filter("reason IS NULL").withColumn("embedding", R.embedding_of("message", embed))
    results = R.retrieve(queries.filter("query_id = 1"), table)
    prompts = {r["query_id"]: r for r in R.build_prompts(queries, R.assemble_context(results)).collect()}
    assert prompts[1]["has_context"] and prompts[1]["system_text"].endswith("CONTEXTO:\nuno\n\n---\n\ndos")
    assert prompts[1]["message"] == "¿uno?"
    assert not prompts[3]["has_context"] and prompts[3]["system_text"] == R.BASE_INSTRUCTION


def test_access_and_fallback(spark):
    queries = spark.createDataFrame([(1, "u"), (2, "v"), (3, "u")], "query_id int, user_id string")
    access = spark.createDataFrame([("u",), ("u",)], "user_id string")
    assert sorted(r["query_id"] for r in R.allowed(queries, access).collect()) == [1, 3]
    first = spark.createDataFrame([(1, "x"), (2, None)], "query_id int, response string")
    second = spark.createDataFrame([(1, "y"), (2, "z")], "query_id int, response string")
    rows = R.answers_with_fallback(queries, first, second).orderBy("query_id").collect()
    assert [tuple(r) for r in rows] == [(1, "x", "primary", True), (2, "z", "fallback", False), (3, None, None, False)]


def test_short_hit_lists_are_broadcast(spark, tmp_path):
    table = vectors(spark, np.eye(4), "chunk_id").withColumns({"text": F.lit("t"), "source_uri": F.lit("s")})
    table.write.parquet(str(tmp_path / "kb"))
    kb = spark.read.parquet(str(tmp_path / "kb"))
    plan = R.retrieve(vectors(spark, np.eye(4), "query_id"), kb)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_vector_index(spark, tmp_path):
    """Unusable vectors lie in no list, copies and ties in theirs; probing all lists is exact, few lists find most."""
    from candlewick.operators.vector_index import VectorIndex

    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 16))
    rows = [(i, (centres[i % 6] + 0.1 * rng.standard_normal(16)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)] + [(2000, None), (2001, [1.0]), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [])]
    vectors = spark.createDataFrame(rows, "id long, embedding array<double>")
    index = VectorIndex(spark, str(tmp_path / "index"))
    index.build(vectors, 6, "id")
    asked = vectors.filter("id < 30 OR id >= 2000").withColumnRenamed("id", "query_id")
    exact = {(r["query_id"], r["id"], r["rank"]) for r in retrieval_topk(asked, vectors).select("query_id", "id", "rank").collect()}
    assert {(r["query_id"], r["id"], r["rank"]) for r in index.search(asked.filter("query_id < 30"), 5, 6, block=7).collect()} == exact
    some = {(r["query_id"], r["id"]) for r in index.search(asked, 5, 2).collect()}
    assert len(some & {x[:2] for x in exact}) >= 0.9 * len(exact)


def test_vector_index_meets_blocks_of_queries_and_vectors(spark, tmp_path, monkeypatch):
    """No task meets all queries of a list, few scores are held at a time, and of many copies only k a query are passed on."""
    from candlewick.operators import vector_index as V

    matrix = V._matrix

    def small(column, length):
        assert len(column) <= 60, f"{len(column)} vectors at once"
        return matrix(column, length)

    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)] + [(500 + i, [1.0] + [0.0] * 7) for i in range(200)]
    vectors = spark.createDataFrame(rows, "id long, embedding array<double>")
    index = V.VectorIndex(spark, str(tmp_path / "index"))
    index.build(vectors, 2, "id")
    asked = vectors.filter("id < 150 OR id = 500").withColumnRenamed("id", "query_id")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        monkeypatch.setattr(V, "_matrix", small)
        monkeypatch.setattr(V, "SCORES", 100, raising=False)
        found = index.search(asked, 3, 2, block=20).orderBy("query_id", "rank").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    exact = {}
    values = np.array([r[1] for r in rows])
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    for place in [*range(150), 200]:
        scores = values @ values[place]
        order = np.lexsort(([r[0] for r in rows], -np.round(scores, 12)))[:3]
        exact[rows[place][0]] = [rows[x][0] for x in order]
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == exact and got[500] == [500, 501, 502]


def retrieval_topk(asked, vectors):
    from candlewick.operators.retrieval import vector_topk

    return vector_topk(asked.filter("query_id < 30"), vectors, 5, vector_id="id")
