"""Language-model scores of texts from a log-frequency Bloom filter of bigram counts.

Words are counted exactly; bigram counts are quantised by a geometric scale and kept in a Bloom filter that holds a
bigram once for every step up to its own. A count is read by probing step after step until one is missing. The filter
comes in segments, made where their bigrams meet in the shuffle. Filters and counts that fit ``broadcast_bytes`` together
(as a rule what Spark's own joins may broadcast) are broadcast and the texts scored in one pass. Larger ones stay where they were made: texts are stored in chunks, every chunk's distinct
words and bigrams go to their segments, which make their filters and answer each chunk, and each chunk is scored from
its answers. So no text is read more often, and nothing larger is sent to the driver, as the corpus grows.

A bigram lies in the segment of its second word, unless
that is a frequent word; then its own hash decides, so no word fills a segment. The counts of the frequent words, a bounded
table, go to every task, those of other words lie with their segment.

With the word's base probability p(w) and the counts c, the bigram ``v w`` has the probability
``(q(v w) + prior * p(w)) / (c(v) + prior)``, where q is the quantised count, at most c(w). Quantised counts are rounded
down, so the probabilities after v sum to at most 1, but for false hits of the filter. The end of
a text is a word, and also what comes before its first one.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.words import SPACED, Hasher, mix, text_chunks
from candlewick.session import release, stored

#: Added to every word's count in the base model.
ADDED = 0.1
#: Weight of the base model, in words, and the factor from one step of the count scale to the next.
PRIOR, RATIO = 1000.0, 1.25
#: Bits of the filter for each entry, and probes for one.
BITS, PROBES = 10, 6
#: Training words for one segment, words whose counts go to every task.
SEGMENT_WORDS, FREQUENT = 1 << 21, 1 << 16
#: Distinct words or bigrams that a task holds before it passes them on.
HELD = 1 << 20
#: A text of more bytes is hashed in parts that end at a separator.
PART_BYTES = 4 << 20
#: Bytes of text in a chunk that is dealt to the segments and scored from their answers; a longer text is a chunk alone.
CHUNK_BYTES = 4 << 20

#: The hash of the end of a text, which no word has to equal: words are hashed from their bytes.
END = np.uint64(0x5851F42D4C957F2D)
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- counts on a geometric scale, and the filter ----------------------------------------------------------------


def scale(most: int, ratio: float = RATIO) -> np.ndarray:
    """1 and on, each at least one and at least ``ratio`` times the one before: the counts that are told apart, up to ``most``."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return np.array(out, np.int64)


def step_of(counts: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Number of scale values at or below each count."""
    return np.searchsorted(steps, counts, side="right")


def _spread(keys: np.ndarray, step: int) -> np.ndarray:
    """One hash for a key at a step, from which its probes follow."""
    return mix(keys + np.asarray(step, np.uint64) * _ODD)


def _probe(spread: np.ndarray, probe: int, bits: np.ndarray | int) -> np.ndarray:
    """The bit of a probe in a filter of ``bits``."""
    second = (spread >> np.uint64(32)) | np.uint64(1)
    return ((spread + np.uint64(probe) * second + np.uint64(probe * probe)) % np.asarray(bits, np.uint64)).astype(np.int64)


def make_filter(keys: np.ndarray, counts: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The bits, as bytes, that hold every key at each step up to its count's."""
    own = step_of(counts, steps)
    entries = int(own.sum())
    n_bits = max(64, -(-entries * BITS // 64) * 64)
    held = np.zeros(n_bits, bool)
    step = 1
    while len(keys):
        spread = _spread(keys, step)
        for probe in range(PROBES):
            held[_probe(spread, probe, n_bits)] = True
        step += 1
        keys, own = keys[own >= step], own[own >= step]
    return np.packbits(held, bitorder="little")


def _width(most: int) -> np.dtype:
    """The smallest whole-number type for counts up to ``most``."""
    return np.min_scalar_type(most)


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each that hold all of them."""
    return counts.astype(_width(int(counts.max(initial=0))).newbyteorder("<")).tobytes()


def _unpacked(counts: bytes, many: int) -> np.ndarray:
    return np.frombuffer(counts, f"<u{len(counts) // many}").astype(np.int64) if many else np.zeros(0, np.int64)


class Segments:
    """Filters of several segments, one after another, and exact word counts."""

    def __init__(self, bits: dict[int, bytes], words: np.ndarray, counts: np.ndarray, low: int, high: int):
        self.low, self.high = low, high
        sizes = [len(bits.get(s, b"")) for s in range(low, high)]
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * 8
        self.data = np.frombuffer(b"".join(bits.get(s, b"") for s in range(low, high)), np.uint8)
        order = np.argsort(words, kind="stable")
        self.words, self.counts = words[order], counts[order].astype(_width(int(counts.max(initial=0))))

    def count(self, words: np.ndarray) -> np.ndarray:
        """Exact counts of words; 0 for those not held. Fast for sorted words."""
        if len(self.words) == 0:
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at].astype(np.int64), 0)

    def steps(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The step of every key's quantised count: probes step after step until one is missing."""
        out = np.zeros(len(keys), np.int64)
        start = self.start[segment - self.low]
        bits = self.start[segment - self.low + 1] - start
        alive = np.flatnonzero(bits > 0)
        step = 1
        while len(alive):
            spread = _spread(keys[alive], step)
            for probe in range(PROBES):
                at = start[alive] + _probe(spread, probe, bits[alive])
                hit = (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                alive, spread = alive[hit], spread[hit]
            out[alive] = step
            step += 1
        return out


# --- words of texts ---------------------------------------------------------------------------------------------


def _word_runs(column: pa.Array, hasher: Hasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first row, end row, hashes of their words, and for each row the number of its first word (one more ends)."""
    for low, high, data, starts in text_chunks(column):
        if high - low > 1 or len(data) <= PART_BYTES:
            hashes, first = hasher.words(data, starts)
            yield low, high, hashes, first
            continue
        parts, at = [], 0
        while at < len(data):
            to = min(at + PART_BYTES, len(data))
            while to < len(data):  # on to the next separator; a longer word stays whole
                stops = np.flatnonzero(~hasher.inside[data[to : to + PART_BYTES]])
                to = to + int(stops[0]) if len(stops) else min(to + PART_BYTES, len(data))
                if len(stops):
                    break
            parts.append(hasher.words(data[at:to], np.array([0, to - at]))[0])
            at = to
        hashes = np.concatenate(parts)
        yield low, high, hashes, np.array([0, len(hashes)])


def _with_ends(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text's words and then the end, and the number of each text's first word (one more ends)."""
    return np.insert(hashes, first[1:], END), first + np.arange(len(first))


def _before(words: np.ndarray) -> np.ndarray:
    """The word before each; the end of the text before for a first word, and the end before the first of all."""
    return np.concatenate([[END], words[:-1]]) if len(words) else words


def _bigrams(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(mix(before) * _ODD + words)


@dataclass
class Layout:
    """How words and bigrams are dealt to ``segments``; ``frequent`` words are sorted, with their ``counts``."""

    segments: int
    frequent: np.ndarray
    counts: np.ndarray

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word among the frequent ones, and which words are there at all."""
        if len(self.frequent) == 0:
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return at, self.frequent[at] == words

    def is_frequent(self, words: np.ndarray) -> np.ndarray:
        return self.places(words)[1]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(20)) % np.uint64(self.segments)).astype(np.int64)

    def of_bigrams(self, keys: np.ndarray, words: np.ndarray) -> np.ndarray:
        return self.of(np.where(self.is_frequent(words), keys, words))


class _Tally:
    """Counts of 64-bit keys, merged now and then; passed on when there are too many."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.size, self.merged = 0, 0

    def add(self, keys: np.ndarray, *more: np.ndarray) -> None:
        at = np.argsort(keys) if more else None
        keys = keys[at] if more else np.sort(keys)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, len(keys)))
        self.parts.append((keys[new], counts, *[m[at][new] for m in more]))
        self.size += len(new)

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, counts, *more = (np.concatenate(c) for c in zip(*self.parts, strict=True))
            at = np.argsort(keys)
            keys = keys[at]
            new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            sums = np.add.reduceat(counts[at], new) if len(new) else counts
            self.parts = [(keys[new], sums, *[m[at][new] for m in more])]
        self.size = self.merged = len(self.parts[0][0]) if self.parts else 0

    def full(self) -> bool:
        """Merge once the unmerged part has outgrown the rest; say whether there is still too much."""
        if self.size >= max(HELD // 4, 2 * self.merged):
            self.merge()
        return self.size >= HELD

    def take(self) -> tuple:
        self.merge()
        out = self.parts[0] if self.parts else None
        self.parts, self.size, self.merged = [], 0, 0
        return out


# --- training ---------------------------------------------------------------------------------------------------


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (its hash as long) and ``count`` over the string column ``text``, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, tally = Hasher(SPACED), _Tally()

        def rows() -> Iterator[pa.RecordBatch]:
            found = tally.take()
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(found[1], pa.int64())], names=["word", "part"])

        for batch in batches:
            for _, _, hashes, first in _word_runs(batch.column(0), hasher):
                tally.add(_with_ends(hashes, first)[0])
                if tally.full():
                    yield from rows()
        yield from rows()

    return texts.select("text").mapInArrow(run, "word long, part long").groupBy("word").agg(F.sum("part").alias("count"))


def deal_bigrams(texts: DataFrame, layout: Layout) -> DataFrame:
    """``segment``, ``keys`` and ``counts``: a task's distinct bigrams of each segment, packed (8 bytes, and a number of 1 to 8)."""
    # Plain values, as workers need not have this package on their path. FREQUENT words at most.
    sent = texts.sparkSession.sparkContext.broadcast((layout.segments, layout.frequent, layout.counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hasher, tally = Layout(*sent.value), Hasher(SPACED), _Tally()

        def rows() -> Iterator[pa.RecordBatch]:
            found = tally.take()
            if found is None:
                return
            keys, counts, segment = found
            at = np.argsort(segment, kind="stable")
            keys, counts, segment = keys[at], counts[at], segment[at]
            begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            for low, high in zip(begin, [*begin[1:], len(keys)], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(segment[low])], pa.int64()), pa.array([keys[low:high].astype("<u8").tobytes()], pa.binary()), pa.array([_packed(counts[low:high])], pa.binary())],
                    names=["segment", "keys", "counts"],
                )

        for batch in batches:
            for _, _, hashes, first in _word_runs(batch.column(0), hasher):
                words, _ = _with_ends(hashes, first)
                keys = _bigrams(_before(words), words)
                tally.add(keys, own.of_bigrams(keys, words).astype(np.int32))
                if tally.full():
                    yield from rows()
        yield from rows()

    return texts.select("text").mapInArrow(run, "segment long, keys binary, counts binary")


def build_filters(dealt: DataFrame, steps: np.ndarray) -> DataFrame:
    """``segment``, ``bits`` of its filter and their number of bytes ``size``. A segment's bigrams meet in one task; their number is bounded by ``SEGMENT_WORDS``."""

    def run(table: pa.Table) -> pa.Table:
        tally = _Tally()
        for keys, counts in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True):
            keys = np.frombuffer(keys, "<u8")
            tally.parts.append((keys, _unpacked(counts, len(keys))))
        keys, counts = tally.take()
        bits = make_filter(keys, counts, steps).tobytes()
        return pa.table({"segment": pa.array([table.column("segment")[0].as_py()], pa.int64()), "bits": pa.array([bits], pa.binary()), "size": pa.array([len(bits)], pa.int64())})

    return dealt.groupBy("segment").applyInArrow(run, "segment long, bits binary, size long")


# --- scoring ----------------------------------------------------------------------------------------------------


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each row; every row has at least one value, its end."""
    return np.add.reduceat(values, first[:-1]) if len(first) > 1 else np.zeros(0)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, sorted, where one of each is, and for every value its place among them."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(values) else np.zeros(0, bool)
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], order[new], place


@dataclass
class Model:
    """The numbers that every score needs: training words in all and distinct, the scale's values from 0 on, the weight of the base model."""

    total: int
    distinct: int
    values: np.ndarray
    prior: float

    def scores(
        self, words: np.ndarray, first: np.ndarray, counts_of: Callable[[np.ndarray], np.ndarray], steps_of: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    ) -> np.ndarray:
        """``n_tokens``, ``n_known``, base and score of texts (words with ends, number of each text's first one).

        ``counts_of`` gives the counts of distinct words, ``steps_of`` the filter's steps of distinct bigrams, from their keys, the places of their second words
        among the distinct ones and the counts of these.
        """
        unique, _, place = _distinct(words)
        count = counts_of(unique)
        base = np.log10((count + ADDED) / (self.total + ADDED * (self.distinct + 1)))
        below = np.log10(count + self.prior)
        before = np.concatenate([[np.searchsorted(unique, END)], place[:-1]])
        keys, at, back = _distinct(_bigrams(unique[before], words))
        second = place[at]
        step = steps_of(keys, second, count[second])
        quantised = np.minimum(self.values[np.minimum(step, len(self.values) - 1)], count[second])
        score = np.log10(quantised + self.prior * 10.0 ** base[second])[back] - below[before]
        return np.stack([np.diff(first).astype(float), _row_sums((count > 0)[place].astype(float), first), _row_sums(base[place], first), _row_sums(score, first)])


def _scored(columns: list[pa.Array], names: list[str], out: np.ndarray) -> pa.RecordBatch:
    found = [pa.array(out[0].astype(np.int64)), pa.array(out[1].astype(np.int64)), pa.array(out[2]), pa.array(out[3])]
    return pa.RecordBatch.from_arrays([*columns, *found], names=[*names, "n_tokens", "n_known", "base", "score"])


def _kinds(texts: DataFrame) -> tuple[list[str], str]:
    """The columns that go with a text, and the schema of its scores."""
    names = [c for c in texts.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in names)
    return names, f"{kinds}, n_tokens long, n_known long, base double, score double"


def score_broadcast(texts: DataFrame, sent: Broadcast) -> DataFrame:
    """Every text's other columns, ``n_tokens``, ``n_known``, ``base`` and ``score``.

    ``sent``: the fields of the layout, of the ``Segments`` with all filters and counts, and of the model.
    """
    names, schema = _kinds(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, held, model = Layout(*sent.value[0]), Segments.__new__(Segments), Model(*sent.value[2])
        held.__dict__.update(sent.value[1])
        hasher = Hasher(SPACED)
        common = Segments({}, layout.frequent, layout.counts, 0, 0)

        words = np.zeros(0, np.uint64)

        def counts_of(unique: np.ndarray) -> np.ndarray:
            nonlocal words
            words = unique
            return np.where(layout.is_frequent(unique), common.count(unique), held.count(unique))

        def steps_of(keys: np.ndarray, second: np.ndarray, count: np.ndarray) -> np.ndarray:
            out, seen = np.zeros(len(keys), np.int64), np.flatnonzero(count > 0)
            out[seen] = held.steps(keys[seen], layout.of_bigrams(keys[seen], words[second[seen]]))
            return out

        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            out = np.zeros((4, len(column)))
            for low, high, hashes, first in _word_runs(column, hasher):
                out[:, low:high] = model.scores(*_with_ends(hashes, first), counts_of, steps_of)
            yield _scored([batch.column(c) for c in names], names, out)

    return texts.mapInArrow(run, schema)


# --- scoring where the segments are -----------------------------------------------------------------------------


def pack_texts(texts: DataFrame) -> DataFrame:
    """``chunk`` (its number) and ``body``: the rows of about ``CHUNK_BYTES`` of text, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, number = [], 0, TaskContext.get().partitionId() << 32

        def chunk() -> pa.RecordBatch:
            nonlocal held, number
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, waiting[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as writer:
                for part in waiting:
                    writer.write_batch(part)
            waiting.clear()
            held, number = 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([number - 1], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "body"])

        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            for low, high, data, _ in text_chunks(column):
                if waiting and held + len(data) > CHUNK_BYTES:
                    yield chunk()
                waiting.append(batch.slice(low, high - low))
                held += len(data)
        if waiting:
            yield chunk()

    return texts.mapInArrow(run, "chunk long, body binary")


def _planes(ascending: np.ndarray) -> bytes:
    """Ascending 64-bit values by their differences, highest bytes first: those are mostly 0, which the shuffle's codec takes out."""
    steps = np.diff(ascending, prepend=np.uint64(0)).astype(">u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(body: pa.Buffer) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(8, -1).T).view(">u8").ravel()
    return np.cumsum(steps.astype(np.uint64), dtype=np.uint64)


def _chunk_words(body: bytes, hasher: Hasher) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A chunk's rows, their words with ends, and the number of each row's first word (one more ends)."""
    table = pa.ipc.open_stream(body).read_all()
    words, firsts, at = [], [np.zeros(1, np.int64)], 0
    for _, _, hashes, first in _word_runs(table.column("text"), hasher):
        own, first = _with_ends(hashes, first)
        words.append(own)
        firsts.append(first[1:] + at)
        at += len(own)
    return table, np.concatenate(words), np.concatenate(firsts)


def _by_segment(values: np.ndarray, segment: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of values by segment, and where each segment begins in it (one more ends)."""
    order = np.argsort(segment.astype(np.min_scalar_type(segments)), kind="stable")  # small numbers are sorted by their digits
    return order, np.searchsorted(segment[order], np.arange(segments + 1))


def _keys_of_pairs(pairs: np.ndarray, frequent: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """The keys of bigrams given by numbers: the second word's (the frequent words, then the rare ones sent along), then the frequent word's before it."""
    second, before = np.divmod(pairs, np.uint64(max(len(frequent), 1)))
    return _bigrams(frequent[before.astype(np.int64)], np.concatenate([frequent, rare])[second.astype(np.int64)])


def deal_chunks(chunks: DataFrame, sent: Broadcast) -> DataFrame:
    """A chunk's distinct bigrams and rare words (``words``) of each segment, packed.

    ``sent``: the fields of the layout. A bigram after a frequent word is sent as the numbers of its two words (``pairs``), which take less than half
    of a hash, any other one by its hash (``keys``). ``counts`` in training, words and answers are in the order of the hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, hasher = Layout(*sent.value), Hasher(SPACED)
        for batch in batches:
            for number, body in zip(batch.column(0), batch.column(1), strict=True):
                table, words, first = _chunk_words(body.as_buffer(), hasher)
                train = np.repeat(~np.asarray(table.column("held_out")).astype(bool), np.diff(first))
                del table
                keys, at, back = _distinct(_bigrams(_before(words), words))
                counts = np.bincount(back[train], minlength=len(keys))
                del back, train
                # Words are looked up once each; a bigram has their places.
                unique, _, place = _distinct(words)
                second, before = place[at], np.concatenate([[np.searchsorted(unique, END)], place[:-1]])[at] if len(place) else place
                del words, at, place
                number_of, common = layout.places(unique)
                first_number, paired = number_of.astype(np.uint64)[before], common[before]
                rare, many = unique[~common], np.uint64(len(layout.frequent))
                by_word, word_cuts = _by_segment(rare, layout.of(rare), layout.segments)
                own = np.empty(len(rare), np.int64)  # a rare word's place in its segment's list
                own[by_word] = np.arange(len(rare)) - np.repeat(word_cuts[:-1], np.diff(word_cuts))
                number_of[~common] = own + len(layout.frequent)
                by_key, key_cuts = _by_segment(keys, layout.of(np.where(common[second], keys, unique[second])), layout.segments)
                pairs = number_of[second].astype(np.uint64) * many + first_number
                del unique, second, before, own, number_of, common, first_number
                rare, keys, counts, pairs, paired = rare[by_word], keys[by_key], counts[by_key], pairs[by_key], paired[by_key]
                full = np.flatnonzero(np.diff(key_cuts))  # a word's segment has a bigram that ends with it
                spans = [(slice(*word_cuts[s : s + 2]), slice(*key_cuts[s : s + 2])) for s in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.int64()),
                        pa.array([number.as_py()] * len(full), pa.int64()),
                        pa.array([_planes(rare[w]) for w, _ in spans], pa.binary()),
                        pa.array([_planes(np.sort(pairs[k][paired[k]])) for _, k in spans], pa.binary()),
                        pa.array([_planes(keys[k][~paired[k]]) for _, k in spans], pa.binary()),
                        pa.array([_packed(counts[k]) for _, k in spans], pa.binary()),
                    ],
                    names=["segment", "chunk", "words", "pairs", "keys", "counts"],
                )

    return chunks.mapInArrow(run, "segment long, chunk long, words binary, pairs binary, keys binary, counts binary")


def answer_chunks(dealt: DataFrame, rare: DataFrame, steps: np.ndarray, sent: Broadcast) -> DataFrame:
    """For every chunk and segment the ``steps`` of its bigrams in the segment's filter and the ``counts`` of its rare words.

    ``rare``: ``segment``, ``word`` and ``count``; ``sent``: the fields of the layout. What meets in one task is bounded by ``SEGMENT_WORDS``.
    """

    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        kinds = {"chunk": pa.int64(), "segment": pa.int64(), "steps": pa.binary(), "counts": pa.binary()}
        out: dict[str, list] = {name: [] for name in kinds}
        if asked.num_rows:
            frequent = Layout(*sent.value).frequent
            keys, words = [], [_from_planes(x.as_buffer()) for x in asked.column("words")]
            for own, pairs, others in zip(words, asked.column("pairs"), asked.column("keys"), strict=True):
                known_by_number = _keys_of_pairs(_from_planes(pairs.as_buffer()), frequent, own)
                keys.append(np.sort(np.concatenate([known_by_number, _from_planes(others.as_buffer())])))
            counts = np.concatenate([_unpacked(packed, len(own)) for own, packed in zip(keys, asked.column("counts").to_pylist(), strict=True)])
            cuts, word_cuts = (np.cumsum([0, *map(len, x)]) for x in (keys, words))
            # A bigram is probed once, however many chunks ask for it.
            unique, _, place = _distinct(np.concatenate(keys))
            del keys
            sums = np.zeros(len(unique), np.int64)
            np.add.at(sums, place, counts)
            found = np.flatnonzero(sums)
            bits = make_filter(unique[found], sums[found], steps).tobytes() if len(found) else b""
            del counts, sums, found
            held = Segments({0: bits}, np.asarray(known.column("word").combine_chunks()).view(np.uint64), np.asarray(known.column("count").combine_chunks()), 0, 1)
            probed = np.minimum(held.steps(unique, np.zeros(len(unique), np.int64)), 255).astype(np.uint8)[place]
            counts = held.count(np.concatenate(words))
            out["chunk"], out["segment"] = asked.column("chunk").to_pylist(), asked.column("segment").to_pylist()
            out["steps"] = [probed[low:high].tobytes() for low, high in itertools.pairwise(cuts.tolist())]
            out["counts"] = [_packed(counts[low:high]) for low, high in itertools.pairwise(word_cuts.tolist())]
        return pa.table({name: pa.array(out[name], kind) for name, kind in kinds.items()})

    schema = "chunk long, segment long, steps binary, counts binary"
    return dealt.groupBy("segment").cogroup(rare.groupBy("segment")).applyInArrow(run, schema)


def score_chunks(chunks: DataFrame, answers: DataFrame, texts: DataFrame, sent: Broadcast) -> DataFrame:
    """Every text's other columns, ``n_tokens``, ``n_known``, ``base`` and ``score``, from its chunk's answers.

    ``sent``: the fields of the layout and of the model.
    """
    names, schema = _kinds(texts)

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        layout, model = Layout(*sent.value[0]), Model(*sent.value[1])
        table, words, first = _chunk_words(chunk.column("body")[0].as_buffer(), Hasher(SPACED))
        answers = answers.sort_by("segment")
        common, dealt_by = Segments({}, layout.frequent, layout.counts, 0, 0), ()

        def counts_of(unique: np.ndarray) -> np.ndarray:
            nonlocal dealt_by
            out, frequent = common.count(unique), layout.is_frequent(unique)
            dealt_by = unique, frequent
            rare = np.flatnonzero(~frequent)
            order, cuts = _by_segment(unique[rare], layout.of(unique[rare]), layout.segments)
            many = np.diff(cuts)[answers.column("segment").to_numpy()]
            out[rare[order]] = np.concatenate([_unpacked(x, n) for x, n in zip(answers.column("counts").to_pylist(), many, strict=True)])
            return out

        def steps_of(keys: np.ndarray, second: np.ndarray, count: np.ndarray) -> np.ndarray:
            out, (unique, frequent) = np.zeros(len(keys), np.int64), dealt_by
            order, _ = _by_segment(keys, layout.of(np.where(frequent[second], keys, unique[second])), layout.segments)
            out[order] = np.concatenate([np.frombuffer(x, np.uint8) for x in answers.column("steps").to_pylist()])
            return out

        out = model.scores(words, first, counts_of, steps_of)
        return pa.Table.from_batches([_scored([table.column(c).combine_chunks() for c in names], names, out)])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def frequent_words(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The words with the highest counts, ``most`` at most, sorted by hash: all words down to a count, so ties stay together."""
    by = words.groupBy(F.floor(F.log(1.05, "count")).alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least"))
    room, least = most, None
    for row in by.orderBy(F.desc("level")).collect():  # a few hundred levels
        room -= row["n"]
        if room < 0:
            break
        least = row["least"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = words.filter(F.col("count") >= least).toArrow()
    hashes = np.asarray(found.column("word").combine_chunks()).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.asarray(found.column("count").combine_chunks())[order]


def score_texts(
    docs: DataFrame,
    training: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    prior: float = PRIOR,
    segment_words: int = SEGMENT_WORDS,
    broadcast_bytes: int | None = None,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Every text's base-10 log probability, from the rows where ``training`` is true.

    One row per row of ``docs``: the id, ``held_out`` (not in training), ``n_tokens`` (words and the end), ``n_known`` (found in training),
    ``train_tokens``, ``base_score`` (single words), ``score`` (after the word before). Null and empty texts are the end alone. Texts are scored
    whole, long ones hashed in parts. Repeated rows and ids, and null ids, keep a row each, equal rows with equal scores. Without
    training rows every probability is the base model's for unknown words. An empty table gives no rows. Other columns are not read.

    ``broadcast_bytes``: filters and counts that surely fit it are broadcast; ``spark.sql.autoBroadcastJoinThreshold`` if not given.
    """
    if broadcast_bytes is None:
        broadcast_bytes = docs.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    train = F.coalesce(training, F.lit(False))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), (~train).alias("held_out"))
    learnt = docs.filter(train).select(text.alias("text"))
    words = stored(count_words(learnt), "lm-words")
    total, distinct, most = (int(x or 0) for x in words.agg(F.sum("count"), F.count(F.lit(1)), F.max("count")).first())
    steps = scale(max(most, 1))
    layout = Layout(max(1, -(-total // segment_words)), *frequent_words(words, frequent))
    model = (total, distinct, np.concatenate([[0], steps]), prior)
    fields = (layout.segments, layout.frequent, layout.counts)
    place = F.pmod(F.shiftrightunsigned("word", 20), F.lit(layout.segments).cast("long"))
    rare = words if len(layout.counts) == 0 else words.filter(F.col("count") < int(layout.counts.min()))
    width = 8 + _width(int(layout.counts.min()) if len(layout.counts) else most).itemsize
    context = docs.sparkSession.sparkContext
    # A bigram has at most as many entries in its filter as it has occurrences.
    if total * BITS // 8 + distinct * width <= broadcast_bytes:
        filters = stored(build_filters(deal_bigrams(learnt, layout), steps), "lm-filters")
        own, near = filters.select("segment", "bits").toArrow(), rare.select("word", "count").toArrow()
        bits = dict(zip(own.column("segment").to_pylist(), own.column("bits").to_pylist(), strict=True))
        hashes = np.asarray(near.column("word").combine_chunks()).view(np.uint64) if near.num_rows else np.zeros(0, np.uint64)
        counts = np.asarray(near.column("count").combine_chunks()) if near.num_rows else np.zeros(0, np.int64)
        parts = score_broadcast(rows, context.broadcast((fields, vars(Segments(bits, hashes, counts, 0, layout.segments)), model)))
    else:
        chunks = stored(pack_texts(rows), "lm-texts")
        sent = context.broadcast(fields)
        dealt = deal_chunks(chunks, sent)
        answers = stored(answer_chunks(dealt, rare.select(place.alias("segment"), "word", "count"), steps, sent), "lm-answers")
        release(words)
        parts = score_chunks(chunks, answers, rows, context.broadcast((fields, model)))
    return parts.select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
