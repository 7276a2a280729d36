"""The registered queries against SQL, and the pipeline against brute force on a small fixture."""

import random
import re
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from candlewick.llm import queries  # noqa: E402
from scripts.compare import TABLES, difference  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, db, name):
    ours = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert len(ours)
    if name in queries.SQL:
        assert difference(ours, db.execute(queries.SQL[name]).df()) is None


def fixture_rows():
    rng = random.Random(12)
    sentence = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.randrange(3000)}" for _ in range(n)) + "."
    item = sentence(20)
    passage = sentence(70)
    rows = [[i, " ".join(sentence(12) for _ in range(8)), "en", f"s{i % 3}"] for i in range(60)]
    rows[5][1] = rows[3][1]  # an exact copy
    rows[7][1] = rows[2][1] + " more"  # a near copy
    for i in (10, 20, 30):
        rows[i][1] = rows[i][1] + " " + passage + " " + sentence(9)
    rows[12][1] = rows[12][1] + " " + item
    rows[40][1] = passage  # nothing else
    for i in range(50, 60):
        rows[i][1] = " ".join(w + rng.choice(["###", "%%%", "&&&", "***"]) for w in rows[i][1].split())
    return [(i, t, lang, source, len(t)) for i, t, lang, source in rows], item, passage


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows, item, passage = fixture_rows()
    folder = str(tmp_path_factory.mktemp("corpus"))
    extra = [(None, "no id but some words in it, quite a few of them for one sentence.", "en", "s1", 70), (61, None, "en", None, None), (62, "", "de", "s2", 0)]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows + extra], "doc_id long, text string, lang string, source string, n_chars long, copy string, row int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 0 if i >= 50 else 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, item, passage


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_do_their_work(spark, corpus):
    folder, rows, item, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, folder)
        path = f"{folder}/stage-{number}"
        after.write.parquet(path)
        after = spark.read.parquet(path)
        gone = ids(docs) - ids(after)
        if number == 0:
            assert gone >= set(range(50, 60)) and gone <= {*range(50, 60), 61, 62}
        elif number == 1:
            assert gone == {5, 7}
        elif number == 2:
            assert gone == {40}
            texts = {r["doc_id"]: r for r in after.collect()}
            assert passage in texts[10]["text"] and passage not in texts[20]["text"] and passage not in texts[30]["text"]
            for i in (20, 30):
                assert texts[i]["text"] == rows[i][1].replace(passage + " ", "") and texts[i]["n_chars"] == len(texts[i]["text"])
            assert all(texts[i]["text"] == rows[i][1] for i in range(50) if i in texts and i not in (20, 30))
        elif number == 3:
            assert gone == {12}
        else:
            assert after.columns == [*columns, "rate", "copy_"]
            break
        assert after.columns == columns and None in ids(after)
        docs = after


def test_run_gives_the_mix_of_the_last_stage(spark, corpus):
    folder, *_ = corpus
    mixed = corpus_pipeline.run(spark, folder).collect()
    times = Counter(r["doc_id"] for r in mixed)
    assert set(times) & {5, 7, 12, 40, *range(50, 60)} == set() and max(times.values()) <= 2
    words = sum(len(re.findall(r"\S+", r["text"])) for r in mixed)
    once = {r["doc_id"]: r["text"] for r in mixed}
    assert words > sum(len(t.split()) for t in once.values())


def test_cutting_words():
    text = "  a bb\tccc\n\ndd e  "
    assert corpus_pipeline.without_words(text, [(1, 3)]) == "  a dd e  "
    assert corpus_pipeline.without_words(text, [(0, 2), (1, 3)]) == "  dd e  "
    assert corpus_pipeline.without_words(text, [(3, 9)]) == "  a bb\tccc\n\n"
    assert corpus_pipeline.without_words(text, []) == text


def test_pipeline_of_an_empty_table(spark, corpus, tmp_path):
    folder, *_ = corpus
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_judge_rows_not_ids(spark, tmp_path):
    rng = random.Random(8)
    sentence = lambda n: " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(4000)}" for _ in range(n))
    item, copied = sentence(20), sentence(60)
    rows = [(None, sentence(50)) for _ in range(30)] + [(4, sentence(50)) for _ in range(30)]
    rows += [(9, copied), (None, copied), (4, copied + " more"), (None, sentence(30) + " " + item), (4, item + " " + sentence(30))]
    docs = spark.createDataFrame([(i, t, "en", f"s{n % 2}", len(t), n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, row_name int")
    folder = str(tmp_path)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    read = spark.read.parquet(f"{folder}/documents.parquet")
    places = lambda df: sorted(r["row_name"] for r in df.select("row_name").collect())
    # Of the three copies that with the least id stays.
    assert places(corpus_pipeline.one_of_each(spark, read, folder)) == [n for n in range(65) if n not in (60, 61)]
    # Rows that do not come straight from files too.
    clean = corpus_pipeline.without_benchmark(spark, read.union(read.limit(0)), folder)
    assert places(clean) == list(range(63)) and clean.columns == read.columns
    drawn = Counter(places(corpus_pipeline.mixed(spark, read, folder)))
    assert max(drawn.values()) <= 2 and 0 < sum(drawn[n] == 2 for n in range(30)) < 30
