"""Quality and toxicity: held-out accuracy and odd input."""

import random

import numpy as np
from pyspark.sql import functions as F

from candlewick.llm import quality, toxicity

SMALL = "/root/testdata/sf0.1"


def rank_accuracy(scores, labels):
    """Share of pairs of a 1 and a 0 that the scores put in order."""
    scores, labels = np.array(scores), np.array(labels)
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    n = labels.sum()
    return (ranks[labels == 1].sum() - n * (n - 1) / 2) / (n * (len(labels) - n))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = toxicity.score_toxicity(docs, labels)
    rows = scored.join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    assert rank_accuracy([r["score"] for r in rows], [r["toxic"] for r in rows]) > 0.93
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_unseen_misspellings_score_like_their_words():
    rng = random.Random(0)
    plain = ["river", "stone", "garden", "window", "paper", "summer", "letter", "bridge"]
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 2:
            words[rng.randrange(30)] = rng.choice(["horrible", "horribly", "disgusting", "disgust"])
        texts.append(" ".join(words))
        labels.append(i % 2)
    model = toxicity.train(texts, labels, toxicity.Settings(epochs=40))
    clean, odd, other = model.scores(["river stone garden window " * 7 + w for w in ("paper", "horrrible disgustin", "zzyzx")], {})
    assert odd > 0.5 > clean and odd > other


def test_rare_toxic_rows_are_all_learnt_from(spark):
    rng = random.Random(1)
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = [(i, " ".join(rng.choices(plain, k=30)), 0) for i in range(3000)]
    rows = [(i, text + " disgusting" if i % 100 == 0 else text, int(i % 100 == 0)) for i, text, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    pairs, share = toxicity.training_rows(docs, docs, "toxic", "doc_id", "text", 200, 10_000)
    toxic = docs.filter(~toxicity.held_out(F.col("doc_id")) & (F.col("toxic") == 1)).count()
    assert len(pairs) == 200 and sum(label for _, label in pairs) == toxic and 0.005 < share < 0.015
    # Eight texts of one class are evidence, one of eight is not.
    spread, ones = np.array([8, 12, 2, 8]), np.array([8, 6, 1, 1])
    assert toxicity.telling(spread, ones, 0.02, toxicity.Settings()).tolist() == [True, True, False, False]


def test_toxicity_of_odd_input(spark):
    rows = [(1, None), (2, ""), (3, "123 !!"), (None, "some words"), (5, "some words"), (5, "some words"), (6, "long " * 100_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1), (5, None), (None, 0), (5, 0), (5, 1), (99, 1)], "doc_id long, toxic int")):
        found = toxicity.score_toxicity(docs, labels).collect()
        assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
        assert len({r["score"] for r in found if r["doc_id"] == 5}) == 1
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0
    folds = toxicity.score_toxicity(docs, none).select("doc_id", "held_out", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("want")).collect()
    assert all(r["held_out"] == bool(r["want"]) for r in folds)


def test_quality_on_rows_not_learnt_from(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    known = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    rows = quality.classify(docs, known).join(labels.select("doc_id", F.col("quality").alias("truth")), "doc_id")
    rows = rows.join(known.select("doc_id"), "doc_id", "left_anti").collect()
    assert np.mean([r["kept"] == (r["truth"] == 1) for r in rows]) > 0.98
    assert np.mean([r["kept"] for r in rows if r["truth"] == 1]) > 0.995


def test_sparse_sites_shrink_to_the_whole(spark):
    good, bad = "A plain sentence of some words, then more of them. " * 4, "###|||%%% ***&&& $$$|| ###%%% " * 9
    rows, marks = [], []
    for i in range(600):
        source = "small" if i < 2 else "bad" if i % 3 == 0 else "fine"
        is_bad = source == "bad" and i % 2 == 0 or source == "fine" and i % 50 == 1
        rows.append((i, f"{i} " + (bad if is_bad else good), source, "en", "x"))
        marks.append((i, 0 if is_bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, kept string")
    found = {r["doc_id"]: r for r in quality.classify(docs, spark.createDataFrame(marks, "doc_id long, quality int")).collect()}
    rate = {s: np.mean([found[i]["host_rate"] for i, _, source, *_ in rows if source == s]) for s in ("small", "bad", "fine")}
    assert rate["bad"] < rate["small"] < rate["fine"]
    assert all(found[i]["kept"] == bool(mark) for i, mark in marks)


def test_quality_of_odd_input(spark):
    rows = [(1, None, None, None), (2, "", "a", "en"), (None, "some words", "a", None), (4, "x " * 50_000, "a", "en"), (4, "x", "a", "en"), (4, "x", "a", "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, lang string, evidence int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(2, 1), (4, None), (None, 0), (4, 1), (4, 0)], "doc_id long, quality int")):
        found = quality.classify(docs, labels, keep=tuple(docs.columns)).collect()
        assert len(found) == len(rows) and all(0 <= r["quality"] <= 1 for r in found)
        assert sorted(str(r["row"]) for r in found) == sorted(str(r) for r in docs.collect())
    assert quality.classify(docs.limit(0), none).count() == 0
