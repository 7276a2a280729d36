"""Language-model scores against exact counts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from candlewick.llm import lm

SCHEMA = "doc_id long, text string, score string, id int, held_out int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def trained(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 10 != 0


def plain(rows, prior=lm.PRIOR):
    """Exact counts in place of the filter: what every score is at least."""
    learnt = [tokens(r[1]) for r in rows if trained(r)]
    words = Counter(t for text in learnt for t in text)
    pairs = Counter(p for text in learnt for p in zip([None, *text], text))  # noqa: B905
    total, steps = sum(words.values()), lm.scale(max(words.values(), default=1))
    base = lambda w: (words[w] + 0.1) / (total + 0.1 * (len(words) + 1))
    value = lambda n: int(steps[np.searchsorted(steps, n, side="right") - 1]) if n else 0
    out = []
    for row in rows:
        text = tokens(row[1])
        score = sum(math.log10((value(pairs[v, w]) + prior * base(w)) / (words[v] + prior)) for v, w in zip([None, *text], text))  # noqa: B905
        out.append((str(row[0]), not trained(row), len(text), sum(words[w] > 0 for w in text), total, sum(math.log10(base(w)) for w in text), score))
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "The", "of", "é", f"w{min(int(rng.paretovariate(0.7)), 400)}"])
    rows = [(i, rng.choice([" ", "\n ", "\t"]).join(word() for _ in range(rng.randrange(0, 60))), "s", 1, 2) for i in range(n)]
    rows += [(None, "of the of", "", 0, 0)] * 3 + [(7, rows[3][1], "", 0, 0)] * 2 + [(7, rows[5][1], "", 0, 0)]
    rows += [(n + i, "the same words " * 9, "", 0, 0) for i in range(n // 2)]
    return rows + [(2 * n, None, "", 0, 0), (2 * n + 1, "", "", 0, 0), (2 * n + 2, " \n", "", 0, 0), (2 * n + 3, "x" * 30 + " long text of" * 40_000, "", 0, 0)]


def scored(spark, rows, parts=5, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    training = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    return [tuple(r) for r in lm.score_texts(docs, training, **options).collect()]


def agree(found, expected):
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6), round(r[6], 1))
    found, expected = sorted(found, key=lambda r: key(r)[:4]), sorted(expected, key=lambda r: key(r)[:4])
    assert [(str(r[0]), *r[1:5]) for r in found] == [r[:5] for r in expected]
    higher = 0
    for a, b in zip(found, expected, strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] >= b[6] - 1e-6 * abs(b[6])
        higher += a[6] > b[6] + 1e-6 * abs(b[6])
    return higher


@pytest.mark.parametrize("options", [{}, {"segment_words": 700, "broadcast_bytes": 9000, "frequent": 3}, {"segment_words": 5000, "broadcast_bytes": 1, "frequent": 0}])
def test_scores_equal_exact_counts(spark, monkeypatch, options):
    """One round and many, words that are frequent and none, long texts in parts; only a few false hits of the filter."""
    monkeypatch.setattr(lm, "PART_BYTES", 1000)
    rows = corpus(200, 4)
    assert agree(scored(spark, rows, **options), plain(rows)) <= 0.2 * len(rows)


def test_rounds_do_not_change_scores(spark):
    rows = corpus(60, 5)
    keyed = lambda found: sorted((str(r[0]), r[2], round(r[6], 6)) for r in found)
    options = {"segment_words": 5000, "frequent": 5}
    assert keyed(scored(spark, rows, **options)) == keyed(scored(spark, rows, 2, broadcast_bytes=1, **options))


def test_texts_are_not_read_more_often_for_more_segments(spark, monkeypatch):
    """As many intermediate results for many segments as for few, equal scores, and none of the filters at the driver."""
    rows, stored, made = corpus(60, 6), lm.stored, []
    monkeypatch.setattr(lm, "stored", lambda df, name: made.append(name) or stored(df, name))
    keyed = lambda found: sorted((str(r[0]), r[1], r[2], r[3], round(r[5], 6), round(r[6], 6)) for r in found)
    whole = keyed(scored(spark, rows, segment_words=2000, frequent=5))
    made.clear()
    assert keyed(scored(spark, rows, segment_words=2000, frequent=5, broadcast_bytes=1)) == whole
    few = list(made)
    made.clear()
    scored(spark, rows, segment_words=200, frequent=5, broadcast_bytes=1)
    assert made == few and "lm-filters" not in few


def test_chunks_of_texts(spark, monkeypatch):
    """Chunks smaller and larger than a text, with rows that repeat, give the scores of one broadcast."""
    rows = corpus(80, 8)
    keyed = lambda found: sorted((str(r[0]), r[1], r[2], r[3], round(r[5], 6), round(r[6], 6)) for r in found)
    whole = keyed(scored(spark, rows, segment_words=3000, frequent=5))
    for size in (1, 2000):
        monkeypatch.setattr(lm, "CHUNK_BYTES", size)
        assert keyed(scored(spark, rows, 3, segment_words=3000, frequent=5, broadcast_bytes=1)) == whole


def test_bigrams_after_frequent_words_are_sent_by_number(spark):
    """What is dealt to the segments takes well under a hash a bigram, and gives back every key in the order of the answers."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(500)) for _ in range(60)]
    rows = spark.createDataFrame([(x, i % 10 == 0) for i, x in enumerate(texts)], "text string, held_out boolean").coalesce(1)
    hasher = lm.Hasher(lm.SPACED)
    hashed = np.unique(np.append(hasher.words(np.frombuffer(" ".join(vocabulary[:2700]).encode(), np.uint8), np.zeros(1, np.int64))[0], lm.END))
    layout = lm.Layout(7, hashed, np.full(len(hashed), 100))
    sent = spark.sparkContext.broadcast((layout.segments, layout.frequent, layout.counts))
    dealt = lm.deal_chunks(lm.pack_texts(rows), sent).collect()
    words = np.concatenate([np.append(hasher.words(np.frombuffer(x.encode(), np.uint8), np.zeros(1, np.int64))[0], lm.END) for x in texts])
    keys, at = np.unique(lm._bigrams(lm._before(words), words), return_index=True)
    segment = layout.of_bigrams(keys, words[at])
    size = 0
    for row in dealt:
        pairs, others, own = (lm._from_planes(pa.py_buffer(row[x])) for x in ("pairs", "keys", "words"))
        found = np.sort(np.concatenate([lm._keys_of_pairs(pairs, layout.frequent, own), others]))
        assert (found == keys[segment == row["segment"]]).all()
        size += sum(len(pa.compress(row[x], "lz4_raw", asbytes=True)) for x in ("pairs", "keys"))
    assert sum(len(row["counts"]) for row in dealt) >= len(keys) > 0.9 * len(words)
    assert size <= 5 * len(keys)


class Frame:
    """Gives the function that a frame would run."""

    def mapInArrow(self, run, schema):
        return run

    def groupBy(self, column):
        return self

    def cogroup(self, other):
        return self

    def applyInArrow(self, run, schema):
        return run


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("many", [1, 40])
def test_bigrams_are_probed_once_for_all_chunks(monkeypatch, many):
    """However many chunks ask a segment, its filter is probed as often as for one, and every chunk has the answers that it has alone."""
    rng = random.Random(12)
    bodies = [" ".join(f"w{min(int(rng.paretovariate(0.6)), 5000)}" for _ in range(3000 // many)) for _ in range(many)]
    hasher = lm.Hasher(lm.SPACED)
    rows = []
    for i, body in enumerate(bodies):
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_pydict({"text": [body], "held_out": [i % 10 == 9]})
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        rows.append((i, sink.getvalue().to_pybytes()))
    words, counts = np.unique(np.concatenate([lm._chunk_words(pa.py_buffer(x), hasher)[1] for _, x in rows]), return_counts=True)
    layout = lm.Layout(3, words[counts >= 20], counts[counts >= 20])
    sent, steps = Sent((layout.segments, layout.frequent, layout.counts)), lm.scale(10_000)
    chunks = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["chunk", "body"])
    dealt = pa.Table.from_batches(list(lm.deal_chunks(Frame(), sent)(iter([chunks]))))
    calls, probe = [], lm._probe
    monkeypatch.setattr(lm, "_probe", lambda *x: calls.append(1) or probe(*x))
    answer = lm.answer_chunks(Frame(), Frame(), steps, sent)
    rare, rare_counts = words[counts < 20], counts[counts < 20]
    for segment in range(3):
        asked = dealt.filter(pa.compute.equal(dealt.column("segment"), segment))
        mine = layout.of(rare) == segment
        known = pa.table({"segment": pa.array([segment] * int(mine.sum()), pa.int64()), "word": pa.array(rare[mine].view(np.int64)), "count": pa.array(rare_counts[mine])})
        calls.clear()
        found = answer(asked, known)
        assert asked.num_rows == many == found.num_rows and found.column("chunk").to_pylist() == asked.column("chunk").to_pylist()
        # Both making and asking the filter take PROBES for a step of the most frequent bigram, and one more step that fails.
        assert len(calls) <= 2 * lm.PROBES * (len(lm.scale(3000)) + 1)
        tally = {}
        own = []
        for row in asked.to_pylist():
            rare_words, pairs, others = (lm._from_planes(pa.py_buffer(row[x])) for x in ("words", "pairs", "keys"))
            keys = np.sort(np.concatenate([lm._keys_of_pairs(pairs, layout.frequent, rare_words), others]))
            own.append((keys, rare_words))
            for key, n in zip(keys.tolist(), lm._unpacked(row["counts"], len(keys)).tolist(), strict=True):
                tally[key] = tally.get(key, 0) + n
        learnt = {key: n for key, n in tally.items() if n}
        bits = lm.make_filter(np.array(list(learnt), np.uint64), np.array(list(learnt.values())), steps).tobytes()
        held = lm.Segments({0: bits}, rare[mine], rare_counts[mine], 0, 1)
        for (keys, rare_words), row in zip(own, found.to_pylist(), strict=True):
            assert (np.frombuffer(row["steps"], np.uint8) == held.steps(keys, np.zeros(len(keys), np.int64))).all()
            assert (lm._unpacked(row["counts"], len(rare_words)) == held.count(rare_words)).all()


def test_broadcasts_follow_the_setting_of_spark(spark, monkeypatch):
    rows, stored, made = corpus(40, 3), lm.stored, []
    monkeypatch.setattr(lm, "stored", lambda df, name: made.append(name) or stored(df, name))
    keyed = lambda found: sorted((str(r[0]), r[1], r[2], r[3], round(r[5], 6), round(r[6], 6)) for r in found)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    whole = keyed(scored(spark, rows))
    assert "lm-answers" not in made
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
        assert keyed(scored(spark, rows)) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "lm-answers" in made


def test_no_rows_and_no_training(spark):
    assert scored(spark, []) == []
    rows = [(None, "a b", "", 0, 0), (None, None, "", 0, 0)]
    assert agree(scored(spark, rows), plain(rows)) == 0


def test_filter_holds_every_count():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, 5000, dtype=np.uint64))
    counts = rng.integers(1, 3000, len(keys))
    steps = lm.scale(3000)
    bits = lm.make_filter(keys, counts, steps).tobytes()
    held = lm.Segments({0: bits}, np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 1)
    own = lm.step_of(counts, steps)
    found = held.steps(keys, np.zeros(len(keys), np.int64))
    assert (found >= own).all() and (found > own).mean() < 0.02
    others = keys + np.uint64(1)
    assert (held.steps(others, np.zeros(len(keys), np.int64)) > 0).mean() < 0.02
    assert (np.diff(steps) >= 1).all() and steps[-1] >= 3000
