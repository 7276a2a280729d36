"""Quality by hierarchical empirical Bayes: a text's own evidence against the record of its site and path.

A logistic model of simple counts gives each text's evidence, as the logarithm of a likelihood ratio.
Grouped sums of the texts' probabilities give every host and every path below it a rate of good
texts; sparse paths are drawn towards their host and sparse hosts towards the whole, as much as the
spread between groups warrants. Evidence and rate add up to the posterior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.words import SPACED, Hasher, text_chunks
from candlewick.session import stored

#: Labelled rows to learn from at most; a documented bound of the training sample only.
SAMPLE_ROWS = 8_000
#: Most and least weight of a prior, in texts.
STRONGEST, WEAKEST = 10_000.0, 1.0
#: Limit of evidence and prior log odds, so that neither is ever certain.
CERTAIN = 12.0

_CLASSES = {
    "upper": [(65, 90)],
    "digit": [(48, 57)],
    "mark": [(33, 47), (58, 64), (91, 96), (123, 126)],
    "rare_mark": [(35, 38), (42, 43), (60, 62), (91, 96), (123, 126)],  # all but sentence marks, quotes and brackets
    "loud": [(33, 33), (63, 63)],
    "control": [(0, 8), (14, 31), (127, 127)],
}
NAMES = [*_CLASSES, "distinct", "repeated", "word_length", "words"]
_CUTS = np.array([0.0005, 0.002, 0.005, 0.01, 0.02, 0.03, 0.045, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])


def text_counts(column: pa.Array, hasher: Hasher) -> np.ndarray:
    """One row of numbers from 0 to 1 per text: shares of character classes, distinct and repeated words, lengths."""
    out = np.zeros((len(column), len(NAMES)))
    tables = []
    for ranges in _CLASSES.values():
        flags = np.zeros(256, dtype=np.int64)
        for low, high in ranges:
            flags[low : high + 1] = 1
        tables.append(flags)
    for low, high, data, starts in text_chunks(column):
        sizes = np.diff(starts)
        full = np.flatnonzero(sizes > 0)
        if len(full):
            for i, flags in enumerate(tables):
                out[low + full, i] = np.add.reduceat(flags[data], starts[full]) / sizes[full]
        words, bounds = hasher.words(data, starts)
        for row in range(high - low):
            own = words[bounds[row] : bounds[row + 1]]
            if len(own):
                _, counts = np.unique(own, return_counts=True)
                out[low + row, -4] = len(counts) / len(own)
                out[low + row, -3] = counts.max() / len(own)
                out[low + row, -2] = min(sizes[row] / len(own) / 40.0, 1.0)
                out[low + row, -1] = min(np.log1p(len(own)) / 12.0, 1.0)
    return out


def features(counts: np.ndarray) -> np.ndarray:
    """Counts as steps over fixed cuts, so that the model can bend, and short texts apart from long ones."""
    steps = (counts[:, :, None] > _CUTS).reshape(len(counts), len(NAMES) * len(_CUTS))
    short = counts[:, -1:] < np.log1p(12) / 12.0
    return np.hstack([np.ones((len(counts), 1), dtype=bool), steps, steps & short]).astype(np.float32)


@dataclass
class Logistic:
    """Weights of the features, and the share of class 1 in the training rows."""

    weights: np.ndarray
    share: float

    def evidence(self, counts: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of class 1: log odds less those of the training rows."""
        prior = np.log(self.share / (1 - self.share))
        return np.clip(features(counts) @ self.weights - prior, -CERTAIN, CERTAIN)


def train(counts: np.ndarray, labels: np.ndarray, ridge: float = 2.0, steps: int = 25) -> Logistic:
    """Ridge logistic regression by Newton steps; without both classes the evidence is 0."""
    n = len(labels)
    share = (labels.sum() + 0.5) / (n + 1.0)
    x = features(counts)
    w = np.zeros(x.shape[1])
    w[0] = np.log(share / (1 - share))
    if n == 0 or labels.min() == labels.max():
        return Logistic(w, share)
    weight = np.full(x.shape[1], ridge)
    weight[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + weight * np.r_[0.0, w[1:]]
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(weight)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(w, share)


def _strength(groups: DataFrame, rate: float) -> float:
    """Weight of the prior in texts, by moments: how far group rates spread beyond what their sizes explain.

    ``groups``: ``n`` texts and ``s`` expected good ones of each.
    """
    inside = rate * (1 - rate)
    n, s = F.col("n"), F.col("s")
    row = groups.filter("n > 0").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(n * n).alias("nn"), F.sum(n * (s / n - rate) ** 2).alias("q")
    ).first()
    if not row["k"] or row["k"] < 2 or inside <= 0:
        return STRONGEST
    spread = (row["q"] - (row["k"] - 1) * inside) / (row["n"] - row["nn"] / row["n"]) if row["n"] > row["nn"] / row["n"] else 0.0
    return float(min(max(inside / spread - 1, WEAKEST), STRONGEST)) if spread > 0 else STRONGEST


def _log_odds(p: Column) -> Column:
    return F.greatest(F.lit(-CERTAIN), F.least(F.lit(CERTAIN), F.log(p / (1 - p))))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    path_columns: tuple[str, ...] = ("lang",),
    label_column: str = "quality",
    threshold: float = 0.5,
    sample_rows: int = SAMPLE_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Posterior quality of every row: the id, ``evidence``, ``host_rate``, ``path_rate``, ``quality``, ``kept``, and ``row`` with the columns ``keep``.

    ``quality`` is the posterior probability of a good text and ``kept`` whether it reaches ``threshold``. Counts and
    rates cover all rows; only the logistic model is fitted on at most ``sample_rows`` labelled rows, the same on
    every run. A row's own probability is left out of the rates it is judged by. Null and empty texts are judged by the
    counts of an empty text; a null host or path is a group of its own; repeated rows are rows of their own; labels
    without a document or value count for nothing, and of repeated labels the highest counts; without labels of both classes the evidence is 0.
    An empty table gives no rows.
    """
    marked = labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    marked = marked.groupBy(F.col(id_column).alias("_id")).agg(F.max(label_column).cast("int").alias("_label"))
    picked = marked.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACED)
        for batch in batches:
            found = text_counts(batch.column("text"), hasher)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), listed], names=["label", "counts"])

    samples = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("text")).join(F.broadcast(picked), "_id")
    samples = samples.groupBy("_id").agg(F.min("text").alias("text"), F.max("_label").alias("_label"))
    rows = samples.select(F.col("_label").alias("label"), "text").mapInArrow(count, "label int, counts array<double>").toArrow()
    rows = rows.combine_chunks()
    found, marks = rows["counts"].combine_chunks(), rows["label"].to_numpy().astype(np.float64)
    table = np.asarray(found.flatten(), dtype=np.float64).reshape(len(marks), len(NAMES))
    order = np.lexsort((marks, *table.T))  # the sums of training come out alike however rows arrive
    model = train(table[order], marks[order])

    plain = docs.select(
        F.col(text_column).cast("string").alias("text"), F.col(id_column).alias("id"), F.col(host_column).cast("string").alias("host"),
        F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in path_columns]).alias("path"), *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    schema = T.StructType([*plain.schema.fields[1:], T.StructField("evidence", T.DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACED)
        for batch in batches:
            evidence = model.evidence(text_counts(batch.column(0), hasher))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(evidence)], names=schema.names)

    # Two passes over the texts instead of keeping them: one for the groups' sums, one for the rows.
    odds = F.col("evidence") + float(np.log(model.share / (1 - model.share)))
    seen = plain.mapInArrow(judge, schema).withColumn("own", 1 / (1 + F.exp(-odds)))
    paths = stored(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("s")), "quality-paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "quality-hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = (total["s"] + model.share) / (total["n"] + 1.0) if total["n"] else model.share
    of_hosts, of_paths = _strength(hosts, rate), _strength(paths, rate)

    known = paths.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("n").alias("path_n"), F.col("s").alias("path_s"))
    above = hosts.select(F.col("host").alias("_above"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    known = stored(known.join(above, known["_host"].eqNullSafe(above["_above"])).drop("_above"), "quality-groups")
    full = seen.join(known, seen["host"].eqNullSafe(known["_host"]) & (seen["path"] == known["_path"]), "left")
    host_rate = (F.col("host_s") - F.col("own") + of_hosts * rate) / (F.col("host_n") - 1 + of_hosts)
    full = full.withColumn("host_rate", host_rate)
    path_rate = (F.col("path_s") - F.col("own") + of_paths * F.col("host_rate")) / (F.col("path_n") - 1 + of_paths)
    full = full.withColumn("path_rate", path_rate)
    full = full.withColumn("quality", 1 / (1 + F.exp(-(F.col("evidence") + _log_odds(F.col("path_rate"))))))
    row = [F.struct(*[F.col(f"_keep_{c}").alias(c) for c in keep]).alias("row")] if keep else []
    return full.select(
        F.col("id").alias(id_column), "evidence", "host_rate", "path_rate", "quality", (F.col("quality") >= threshold).alias("kept"), *row
    )
