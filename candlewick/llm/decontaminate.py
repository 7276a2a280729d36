"""Benchmark decontamination by winnowed fingerprints.

Of every ``window - gram + 1`` neighbouring k-grams the one with the least hash is a fingerprint, so
any shared run of ``window`` words holds a fingerprint that both sides chose. Fingerprints of texts
meet those of the items, and each hit is extended to all windows around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.words import ALPHANUMERIC, Hasher, mix, shingles, text_chunks
from candlewick.session import stored

WINDOW, GRAM = 10, 5
#: Bits of the filter that the tasks hold; its size does not depend on the benchmark.
FILTER_BITS = 1 << 24


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """For every run of ``span`` neighbouring grams, the position of its least; of equal ones the last.

    The choice depends on the run's own grams only, so equal runs of two texts choose alike.
    """
    n = max(len(grams) - span + 1, 0)
    best = np.arange(n, dtype=np.int64)
    for j in range(1, span):
        better = np.flatnonzero(grams[j : j + n] <= grams[best])
        best[better] = better + j
    return best


class Filter:
    """Bloom filter of fixed size over 64-bit hashes; three bits a value."""

    @staticmethod
    def places(values: np.ndarray) -> list[np.ndarray]:
        bits = np.uint64(FILTER_BITS - 1)
        return [(values >> np.uint64(shift)) & bits for shift in (0, 20, 40)]

    @staticmethod
    def hits(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
        found = np.ones(len(values), dtype=bool)
        for place in Filter.places(values):
            found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _texts_of(bounds: np.ndarray, n_words: int) -> np.ndarray:
    """Text number of every word."""
    return np.searchsorted(bounds, np.arange(n_words), side="right") - 1


def item_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int, gram: int) -> DataFrame:
    """Windows of the items: ``item_id``, ``size``, ``hash``, ``mark`` (the window's fingerprint).

    An item of fewer words than a window, but not none, is one window, marked by its own hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ALPHANUMERIC)
        for batch in batches:
            items, sizes, hashes, marks = [], [], [], []
            for low, high, data, starts in text_chunks(batch.column(1)):
                words, bounds = hasher.words(data, starts)
                for row in range(high - low):
                    own = words[bounds[row] : bounds[row + 1]]
                    if len(own) == 0:
                        continue
                    size = min(window, len(own))
                    whole = shingles(own, size)
                    if len(own) < window:
                        chosen = whole
                    else:
                        grams = shingles(own, gram)
                        chosen = grams[winnow(grams, window - gram + 1)]
                    items += [low + row] * len(whole)
                    sizes += [size] * len(whole)
                    hashes.append(whole)
                    marks.append(chosen)
            taken = batch.column(0).take(pa.array(items, pa.int64()))
            none = [np.zeros(0, np.uint64)]
            columns = [_as_long(np.concatenate(part or none)) for part in (hashes, marks)]
            yield pa.RecordBatch.from_arrays(
                [taken, pa.array(sizes, pa.int32()), *columns], names=["item_id", "size", "hash", "mark"]
            )

    rows = benchmark.select(F.col(id_column).alias("item_id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item_id {kind}, size int, hash long, mark long")


def _filter_bits(marks: DataFrame) -> bytes:
    """The filter over a column of hashes: parts are set in the tasks, merged by byte, and only set bytes come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        for batch in batches:
            values = np.asarray(batch.column(0)).view(np.uint64)
            for place in Filter.places(values):
                np.bitwise_or.at(bits, place >> np.uint64(3), np.left_shift(1, place & np.uint64(7)).astype(np.uint8))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(bits[at], pa.int32())], names=["at", "value"])

    parts = marks.mapInArrow(run, "at int, value int")
    merged = parts.groupBy("at").agg(F.bit_or("value").alias("value")).toPandas()
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    bits[merged["at"].to_numpy()] = merged["value"].to_numpy().astype(np.uint8)
    return bits.tobytes()


def find_hits(
    docs: DataFrame,
    windows: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row for every text: ``id``, ``row`` (a number of its own), ``n_words``, ``spans``.

    ``spans``: arrays of (start word, size, hash, mark) of the text's windows that may be an item's window;
    the filter may let a few others through, which the join on the hash removes.
    """
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in windows.select("size").distinct().collect() if r[0] < window)
    shared = spark.sparkContext.broadcast(_filter_bits(windows.select("mark").distinct()))
    whole = spark.sparkContext.broadcast(_filter_bits(windows.select("hash").distinct()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ALPHANUMERIC)
        marks_bits = np.frombuffer(shared.value, dtype=np.uint8)
        whole_bits = np.frombuffer(whole.value, dtype=np.uint8)
        span_type = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("hash", pa.int64()), ("mark", pa.int64())]))
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            found: list[tuple[np.ndarray, ...]] = []  # row, start, size, hash, mark
            for low, high, data, starts in text_chunks(batch.column(1)):
                words, bounds = hasher.words(data, starts)
                counts[low:high] = np.diff(bounds)
                texts = _texts_of(bounds, len(words))
                grams, runs = shingles(words, gram), shingles(words, window)
                best = winnow(grams, window - gram + 1)
                whole_runs = texts[: len(runs)] == texts[window - 1 : window - 1 + len(runs)]
                at = np.unique(best[whole_runs])
                hit = np.zeros(len(grams), dtype=bool)
                hit[at[Filter.hits(marks_bits, grams[at])]] = True
                # Extend each hit to the windows that chose this fingerprint.
                start = np.flatnonzero(whole_runs & hit[best])
                start = start[Filter.hits(whole_bits, runs[start])]
                found.append((low + texts[start], start - bounds[texts[start]], np.full(len(start), window), runs[start], grams[best[start]]))
                for size in lengths:
                    short = shingles(words, size)
                    start = np.flatnonzero(Filter.hits(whole_bits, short))
                    start = start[texts[start] == texts[start + size - 1]] if len(start) else start
                    found.append((low + texts[start], start - bounds[texts[start]], np.full(len(start), size), short[start], short[start]))
            row, start, size, hashes, mark = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 5
            order = np.lexsort((size, start, row))
            row, start, size, hashes, mark = row[order], start[order], size[order], hashes[order], mark[order]
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            spans = pa.StructArray.from_arrays(
                [pa.array(start, pa.int32()), pa.array(size, pa.int32()), _as_long(hashes.astype(np.uint64, copy=False)), _as_long(mark.astype(np.uint64, copy=False))],
                names=["start", "size", "hash", "mark"],
            )
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans).cast(span_type)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), listed], names=["id", "n_words", "spans"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, spans array<struct<start:int,size:int,hash:long,mark:long>>"
    return rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Which words of each text lie inside a window of ``window`` words that also occurs in a benchmark item.

    One row per row of ``docs``: the id, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted strings),
    ``spans`` (start word, end word; joined where they overlap or touch), ``contaminated``. Null and
    empty texts have no words and no hits; items without words are never found; repeated items count
    once by their id, an item without an id covers words but is not listed; an empty benchmark hits
    nothing; repeated rows of ``docs`` each give a row; other columns are not read.
    """
    windows = stored(item_windows(benchmark, item_column, item_text_column, window, gram), "item-windows")
    texts = stored(find_hits(docs, windows, id_column, text_column, window, gram), "benchmark-hits")
    hit = texts.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("span")).select("row", "span.*")
    known = windows.select("size", "hash", "mark").distinct()
    hit = stored(hit.join(known, ["mark", "hash", "size"]).select("row", "start", "size", "hash"), "benchmark-windows")

    by_row = Window.partitionBy("row").orderBy("start", "size")
    reached = F.max(F.col("start") + F.col("size")).over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    runs = hit.select("row", "start", "size", F.coalesce(reached, F.lit(-1)).alias("reached"))
    new = (F.col("start") > F.col("reached")).cast("int")
    runs = runs.withColumn("run", F.sum(new).over(by_row.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"))
    cover = runs.groupBy("row").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    owners = windows.select("size", "hash", F.col("item_id").cast("string").alias("item")).filter("item IS NOT NULL").distinct()
    items = hit.select("row", "size", "hash").distinct().join(owners, ["size", "hash"]).select("row", "item").distinct()
    items = items.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = cover.join(items, "row", "left")
    return (
        texts.select("row", F.col("id").alias(id_column), "n_words")
        .join(found, "row", "left")
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .select(
            id_column,
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            "items",
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
