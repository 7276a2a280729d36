"""Toxicity by bags of subword embeddings.

A word is the mean of the embeddings of its character n-grams and of itself, all hashed into a table
of fixed size; a text is the mean of its words; a linear softmax turns that into two classes.
Embeddings and softmax are trained together. An unseen misspelling shares most n-grams, and so most
of its vector, with the word it was made from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.words import mix, shingles
from candlewick.session import stored

_WORD = re.compile(r"[^\W\d_]+")
#: Words a task remembers; then it starts anew, so memory does not grow with the number of different words.
REMEMBERED = 400_000


@dataclass
class Settings:
    buckets: int = 1 << 20
    dim: int = 8
    shortest: int = 3
    longest: int = 5
    epochs: int = 8
    rate: float = 0.6
    batch: int = 32
    #: Labelled rows to learn from at most, and characters of one of them at most; longer texts are not learnt from.
    sample_rows: int = 8_000
    sample_chars: int = 20_000
    #: A bucket in this many texts of the sample is learnt in any case, a rarer one only if the chance that so many
    #: of its texts are of one class by accident is below ``accident``.
    least_texts: int = 12
    accident: float = 1e-3
    #: How far the classes are made equal in weight: 0 not at all, 1 wholly.
    balance: float = 0.4
    #: Empty words averaged into every text, so that one word of a short text does not decide alone.
    padding: int = 30
    seed: int = 7


def subwords(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams (ends marked) and of the word itself, word after word, and how many each has."""
    text = "".join(f"<{word}>" for word in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(word) + 2 for word in words], dtype=np.int64)
    starts = np.r_[0, np.cumsum(lengths)][:-1]
    owner = np.repeat(np.arange(len(words)), lengths)
    within = np.arange(len(codes)) - starts[owner]
    values = mix(codes + np.uint64(1))
    whole = np.add.reduceat(mix(values + within.astype(np.uint64)), starts)
    hashes, owners = [mix(whole)], [np.arange(len(words))]
    for n in range(settings.shortest, settings.longest + 1):
        grams = shingles(values, n)
        fits = within[: len(grams)] + n <= lengths[owner[: len(grams)]]
        hashes.append(grams[fits])
        owners.append(owner[: len(grams)][fits])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate(hashes)[order] % np.uint64(settings.buckets)).astype(np.int64)
    return buckets, np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    """What scoring needs of the trained model: each bucket's share of the logit, and the bias."""

    settings: Settings
    weights: np.ndarray
    bias: float

    def word_values(self, words: list[str]) -> list[float]:
        if not words:
            return []
        buckets, counts = subwords(words, self.settings)
        sums = np.add.reduceat(self.weights[buckets].astype(np.float64), np.r_[0, np.cumsum(counts)][:-1])
        return (sums / counts).tolist()

    def scores(self, texts: list[str], known: dict[str, float]) -> list[float]:
        """Probabilities of class 1; a text without words has that of the bias alone."""
        out = []
        for text in texts:
            words = Counter(_WORD.findall(text.lower()))
            new = [word for word in words if word not in known]
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(words)
            known.update(zip(new, self.word_values(new), strict=True))
            total = sum(known[word] * n for word, n in words.items()) / (words.total() + self.settings.padding)
            out.append(float(1.0 / (1.0 + np.exp(-np.clip(total + self.bias, -60, 60)))))
        return out


def _bag(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights."""
    words = Counter(_WORD.findall(text.lower()))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    buckets, counts = subwords(list(words), settings)
    each = np.fromiter(words.values(), dtype=np.float64, count=len(words)) / counts
    at, where = np.unique(buckets, return_inverse=True)
    return at, (np.bincount(where, np.repeat(each, counts)) / (words.total() + settings.padding)).astype(np.float32)


def telling(spread: np.ndarray, ones: np.ndarray, share: float, settings: Settings) -> np.ndarray:
    """Buckets to learn, by the number of texts that have them and how many of those are of class 1 (of all texts: ``share``)."""
    few = np.arange(settings.least_texts)
    logs = np.r_[0.0, np.cumsum(np.log(np.maximum(few, 1)))]
    ways = lambda n, t: logs[n + 1] - logs[t + 1] - logs[n - t + 1]
    learnt = spread >= settings.least_texts
    rare = np.flatnonzero((spread > 1) & ~learnt)
    n, t = spread[rare], ones[rare]
    for of_class, rate in ((t, share), (n - t, 1 - share)):
        # The chance of so many or more is at most that of some choice of so many texts all being of the class.
        learnt[rare[(of_class > 1) & (ways(n, of_class) + of_class * np.log(rate) < np.log(settings.accident))]] = True
    return learnt


def train(texts: list[str], labels: list[int], settings: Settings | None = None, ones_share: float | None = None) -> Model:
    """Train embeddings and softmax together by Adagrad on the cross entropy, both classes weighted alike in sum (to a root).

    ``ones_share``: share of class 1 among all labelled rows, if the sample's is another one.
    """
    settings = settings or Settings()
    rng = np.random.default_rng(settings.seed)
    table = rng.uniform(-1, 1, (settings.buckets, settings.dim)).astype(np.float32) / settings.dim
    table_sum = np.full(settings.buckets, 1e-6, dtype=np.float32)
    soft = rng.normal(0, 0.5, (settings.dim, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    soft_sum, bias_sum = np.full_like(soft, 1e-6), np.full_like(bias, 1e-6)
    y = np.asarray(labels, dtype=np.int64)
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        return Model(settings, np.zeros(settings.buckets, np.float32), float(np.log(rate / (1 - rate))))
    share = np.bincount(y, minlength=2) / len(y)
    whole = share if ones_share is None else np.array([1 - ones_share, ones_share])
    importance = (0.5 / whole) ** settings.balance * whole / share
    # A bucket that only a few texts of either class have says nothing of others; without it the table learns what texts share.
    # Bags are made twice, so that those rare buckets are never all held at once.
    spread, ones = np.zeros(settings.buckets, dtype=np.int32), np.zeros(settings.buckets, dtype=np.int32)
    for text, one in zip(texts, y, strict=True):
        at = _bag(text, settings)[0]
        spread[at] += 1
        ones[at] += one
    common = telling(spread, ones, share[1], settings)
    bags = []
    for text in texts:
        at, weight = _bag(text, settings)
        bags.append((at[common[at]].astype(np.int32), weight[common[at]]))
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs) + 0.02
        order = rng.permutation(len(y))
        for low in range(0, len(order), settings.batch):
            rows = order[low : low + settings.batch]
            at = np.concatenate([bags[i][0] for i in rows])
            weight = np.concatenate([bags[i][1] for i in rows])
            owner = np.repeat(np.arange(len(rows)), [len(bags[i][0]) for i in rows])
            starts = np.searchsorted(owner, np.arange(len(rows)))
            filled = np.array([len(bags[i][0]) > 0 for i in rows])
            mean = np.zeros((len(rows), settings.dim), dtype=np.float32)
            if len(at):
                mean[filled] = np.add.reduceat(table[at] * weight[:, None], starts[filled], axis=0)
            logits = mean @ soft + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= importance[y[rows]][:, None] / len(rows)
            back = p @ soft.T
            grad = mean.T @ p
            soft_sum += grad**2
            soft -= rate * grad / np.sqrt(soft_sum)
            step = p.sum(axis=0)
            bias_sum += step**2
            bias -= rate * step / np.sqrt(bias_sum)
            if len(at):
                each = back[owner] * weight[:, None]
                some, where = np.unique(at, return_inverse=True)
                total = np.zeros((len(some), settings.dim), dtype=np.float32)
                sort = np.argsort(where, kind="stable")
                firsts = np.searchsorted(where[sort], np.arange(len(some)))
                total = np.add.reduceat(each[sort], firsts, axis=0)
                table_sum[some] += (total**2).mean(axis=1)
                table[some] -= rate * total / np.sqrt(table_sum[some])[:, None]
    direction = soft[:, 1] - soft[:, 0]
    weights = np.where(common, table @ direction, 0.0)
    return Model(settings, weights.astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Fold 0 of the ids by crc32 of their text; a null id is in no fold."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label_column: str, id_column: str, text_column: str, rows: int, chars: int
) -> tuple[list[tuple[str, int]], float | None]:
    """A bounded sample of labelled texts outside the held-out fold, the same on every run; a rare class is in it up to half the rows.

    With it comes the share of class 1 among all of them.

    Rows without id, label or text are not used; of repeated labels the highest counts, of repeated documents the least text.
    """
    marked = labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & ~held_out(F.col(id_column)))
    marked = marked.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    # Half the sample for either class; what one does not fill is the other's.
    marked = stored(marked, "toxicity-labels")
    n_ones, n_zeros = (marked.filter(F.col("label") == x).count() for x in (1, 0))
    one, zero = (marked.filter(F.col("label") == x).orderBy(F.xxhash64("id"), "id") for x in (1, 0))
    ones = min(n_ones, max(rows // 2, rows - n_zeros))
    picked = one.limit(ones).union(zero.limit(rows - ones))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    texts = texts.filter(F.length("text") <= chars).join(F.broadcast(picked), "id")
    found = texts.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label")).orderBy("id").collect()
    return [(row["text"], row["label"]) for row in found], n_ones / (n_ones + n_zeros) if n_ones and n_zeros else None


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    settings: Settings | None = None,
) -> DataFrame:
    """Score every whole text: the id, ``held_out``, ``score`` (0 to 1), ``predicted`` (score >= 0.5).

    The model is trained on the driver from at most ``sample_rows`` labelled rows outside the held-out fold
    and sent to the tasks; its size is fixed by the settings. Null and empty texts score by the bias; without any labels,
    or with one class only, every text scores that class's rate. Every row gives one row; only the id and text
    columns are read, and a score depends on the text alone.
    """
    settings = settings or Settings()
    pairs, ones_share = training_rows(docs, labels, label_column, id_column, text_column, settings.sample_rows, settings.sample_chars)
    model = train([text for text, _ in pairs], [label for _, label in pairs], settings, ones_share)
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(settings, shared.value, bias)
        known: dict[str, float] = {}
        for batch in batches:
            scores = own.scores([text.as_py() or "" for text in batch.column(1)], known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_column),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
