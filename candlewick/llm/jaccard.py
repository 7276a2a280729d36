"""Exact similarity join of documents on word shingles, as a T-occurrence search.

Two sets of sizes x and y with Jaccard similarity s or more share at least s / (1 + s) * (x + y)
shingles, so a partner must occur on that many of a document's inverted lists. The work is cut down
in three exact steps before any lists are merged:

1. Equal sets become one class. Shingles of one class only are dropped at once: they are on nobody
   else's list. A class that keeps fewer shingles than any partner would have to share has no link.
2. Of what is left each class takes its rarest shingles, just as many that a partner must share one
   of them. Classes that share such a shingle and have fitting sizes are put into one block; a star
   to the least class replaces all pairs, so the rows stay linear however many share a shingle.
3. Inside a block the lists are in one task. Short lists are merged and occurrences counted; the
   longest lists are left out of the merge and probed by binary search for the few candidates that
   remain (DivideSkip). Blocks of many classes are cut into pairs of parts, one task each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import components
from candlewick.llm.words import SPACED, Hasher, fold, shingles, text_chunks
from candlewick.session import stored

#: Shingles a task gathers before it hands them to the shuffle.
FLUSH = 1 << 20
#: Classes of a part of a block; two parts meet in one task.
PART = 512
#: Weight of a list's length when the number of lists to leave out of the merge is chosen.
SKIP_WEIGHT = 0.0085

_HEAD = np.dtype([("key", "<u8"), ("size", "<u4"), ("n", "<u4")])


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles; with fewer than ``k`` words the whole sequence as one."""
    if len(words) == 0:
        return words
    return np.unique(shingles(words, min(k, len(words))) + np.uint64(len(words) < k))


def _part_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    """Part of every shingle by its upper bits, so that sorted shingles have ascending parts."""
    return ((tokens >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def shingle_parts(docs: DataFrame, id_column: str, text_column: str, k: int, parts: int) -> DataFrame:
    """Packed sets. ``heads``/``body`` hold the shingles of part ``part`` of many sets, set after set.

    Rows with ``ids`` hold (id, class, size) of documents instead. A set is sent once per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACED)
        names = ["part", "heads", "body", "ids", "keys", "sizes"]
        seen: set[int] = set()
        waiting: list[tuple[int, np.ndarray]] = []
        held, turn = 0, 0
        id_kind = None

        def flush():
            tokens = np.concatenate([s for _, s in waiting])
            lengths = np.array([len(s) for _, s in waiting])
            keys = np.array([key for key, _ in waiting], dtype=np.uint64)
            owner = np.repeat(np.arange(len(waiting)), lengths)
            place = _part_of(tokens, parts)
            order = np.argsort(place, kind="stable")
            tokens, owner, place = tokens[order], owner[order], place[order]
            cuts = np.searchsorted(place, np.arange(parts + 1))
            rows = np.flatnonzero(np.diff(cuts))
            heads, bodies = [], []
            for p in rows:
                own = owner[cuts[p] : cuts[p + 1]]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                head = np.empty(len(first), dtype=_HEAD)
                head["key"], head["size"] = keys[own[first]], lengths[own[first]]
                head["n"] = np.diff(np.r_[first, len(own)])
                heads.append(head.tobytes())
                bodies.append(tokens[cuts[p] : cuts[p + 1]].tobytes())
            none = pa.nulls(len(rows))
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int32()), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary()),
                    none.cast(pa.list_(id_kind)), none.cast(pa.list_(pa.int64())), none.cast(pa.list_(pa.int32())),
                ],
                names=names,
            )

        for batch in batches:
            id_kind = batch.column(0).type
            keys = np.zeros(batch.num_rows, dtype=np.uint64)
            sizes = np.zeros(batch.num_rows, dtype=np.int32)
            for low, high, data, starts in text_chunks(batch.column(1)):
                words, bounds = hasher.words(data, starts)
                for row in range(high - low):
                    own = shingle_set(words[bounds[row] : bounds[row + 1]], k)
                    if len(own) == 0:
                        continue
                    key = fold(own)
                    keys[low + row], sizes[low + row] = key, len(own)
                    if key not in seen:
                        seen.add(key)
                        waiting.append((key, own))
                        held += len(own)
                if held >= FLUSH:
                    held = 0
                    yield flush()
            # Documents go to any part in turn.
            turn = (turn + (int(keys[0]) if len(keys) else 0)) % parts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([turn], pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                    pa.array([batch.column(0).to_pylist()], pa.list_(id_kind)),
                    pa.array([keys.view(np.int64)], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                ],
                names=names,
            )
        if waiting:
            yield flush()

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"part int, heads binary, body binary, ids array<{kind}>, keys array<bigint>, sizes array<int>")


def shared_shingles(packed: DataFrame, parts: int) -> DataFrame:
    """Of every part, the shingles that two or more classes have, with their number of classes, sent on by class."""
    kind = packed.schema["ids"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "heads", "body", "counts", "ids", "keys", "sizes"]
        heads, bodies = [], []
        for batch in batches:
            documents = batch.filter(batch.column(3).is_valid())
            if documents.num_rows:
                none = pa.nulls(documents.num_rows, pa.binary())
                arrays = [documents.column(0), none, none, none, *(documents.column(i) for i in (3, 4, 5))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                kinds = [documents.column(i).type for i in (3, 4, 5)]
            for head, body in zip(batch.column(1), batch.column(2), strict=True):
                if head.is_valid:
                    heads.append(np.frombuffer(head.as_buffer(), dtype=_HEAD))
                    bodies.append(np.frombuffer(body.as_buffer(), dtype=np.uint64))
        if not heads:
            return
        head, tokens = np.concatenate(heads), np.concatenate(bodies)
        heads.clear()
        bodies.clear()
        # The same class may come from several tasks.
        _, first = np.unique(head["key"], return_index=True)
        once = np.zeros(len(head), dtype=bool)
        once[first] = True
        tokens = tokens[np.repeat(once, head["n"])]
        head = head[once]
        owner = np.repeat(np.arange(len(head), dtype=np.int32), head["n"])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        edges = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1], True])
        count = np.diff(edges)
        count = np.repeat(count, count)
        tokens, owner, count = tokens[count > 1], owner[count > 1], count[count > 1]
        # By class: deal the classes by their key.
        place = (head["key"] % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((owner, place[owner]))
        tokens, owner, count = tokens[order], owner[order], count[order].astype(np.uint32)
        cuts = np.searchsorted(place[owner], np.arange(parts + 1))
        rows = np.flatnonzero(np.diff(cuts))
        out: list[list[bytes]] = [[], [], []]
        for p in rows:
            own = owner[cuts[p] : cuts[p + 1]]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            sent = head[own[first]].copy()
            sent["n"] = np.diff(np.r_[first, len(own)])
            out[0].append(sent.tobytes())
            out[1].append(tokens[cuts[p] : cuts[p + 1]].tobytes())
            out[2].append(count[cuts[p] : cuts[p + 1]].tobytes())
        arrays = [pa.array(rows, pa.int32()), *(pa.array(x, pa.binary()) for x in out)]
        none = [pa.nulls(len(rows), field) for field in list_kinds]
        yield pa.RecordBatch.from_arrays([*arrays, *none], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    list_kinds = [to_arrow_type(packed.schema[name].dataType) for name in ("ids", "keys", "sizes")]
    schema = f"part int, heads binary, body binary, counts binary, ids {kind}, keys array<bigint>, sizes array<int>"
    return packed.repartitionById(parts, "part").mapInArrow(run, schema)


def candidates(shared: DataFrame, parts: int, num: int, den: int) -> DataFrame:
    """Classes that may have a partner: ``key``, ``size``, ``tokens`` (rarest first, only shared ones), ``prefix``.

    A partner holds one of the first ``prefix`` tokens, whatever it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, bodies, counts = [], [], []
        for batch in batches:
            for head, body, count in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                heads.append(np.frombuffer(head.as_buffer(), dtype=_HEAD))
                bodies.append(np.frombuffer(body.as_buffer(), dtype=np.uint64))
                counts.append(np.frombuffer(count.as_buffer(), dtype=np.uint32))
        if not heads:
            return
        head, tokens, count = np.concatenate(heads), np.concatenate(bodies), np.concatenate(counts)
        keys, owner = np.unique(head["key"], return_inverse=True)
        size = np.zeros(len(keys), dtype=np.int64)
        size[owner] = head["size"]
        total = np.bincount(owner, weights=head["n"], minlength=len(keys)).astype(np.int64)
        need = -(-num * size // den)
        alive = total >= need
        of_token = np.repeat(owner, head["n"])
        keep = alive[of_token]
        tokens, count, of_token = tokens[keep], count[keep], of_token[keep]
        order = np.lexsort((tokens, count, of_token))
        tokens, of_token = tokens[order], of_token[order]
        which = np.flatnonzero(alive)
        offsets = np.r_[np.searchsorted(of_token, which), len(tokens)]
        prefix = total[which] - need[which] + 1
        for low in range(0, len(which), 1000):
            high = min(low + 1000, len(which))
            part = tokens[offsets[low] : offsets[high]].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets[low : high + 1] - offsets[low], pa.int32()), pa.array(part))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[which[low:high]].view(np.int64)), pa.array(size[which[low:high]], pa.int32()), lists,
                    pa.array(prefix[low:high], pa.int32()),
                ],
                names=["key", "size", "tokens", "prefix"],
            )

    sets = shared.filter("ids IS NULL").select("part", "heads", "body", "counts")
    return sets.repartitionById(parts, "part").mapInArrow(run, "key long, size int, tokens array<bigint>, prefix int")


def blocks(sets: DataFrame, num: int, den: int) -> DataFrame:
    """``key`` and ``block`` of the classes that share a prefix token with a class of fitting size."""
    width = math.log(den / num) * 1.0001 if num < den else 1.0
    bucket = F.floor(F.log("size") / width).cast("int")
    listed = sets.select("key", bucket.alias("bucket"), F.explode(F.slice("tokens", 1, F.col("prefix"))).alias("token"))
    least = listed.groupBy("token", "bucket").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    least = stored(least, "block-heads")
    here = least.filter("least <> most").select("token", "bucket", "least")
    stars = listed.join(here, ["token", "bucket"]).select(F.col("key").alias("a"), F.col("least").alias("b"))
    above = least.select("token", (F.col("bucket") - 1).alias("bucket"), F.col("least").alias("b"))
    steps = least.join(above, ["token", "bucket"]).select(F.col("least").alias("a"), "b")
    links = stars.unionByName(steps).filter("a <> b").distinct()
    return components(links).select(F.col("node").alias("key"), F.col("component").alias("block"))


def divide_skip(tokens: list[np.ndarray], sizes: np.ndarray, sides: np.ndarray | None, num: int, den: int) -> list[tuple[int, int]]:
    """All linked pairs (i, j) of sets, by T-occurrence search over the sets' inverted lists.

    ``tokens``: each set's tokens that others may have; ``sizes``: the whole sets' sizes. With
    ``sides`` only pairs of different sides count.
    """
    order = np.argsort(sizes, kind="stable")
    lengths = np.array([len(tokens[i]) for i in order])
    _, token = np.unique(np.concatenate([tokens[i] for i in order]), return_inverse=True)
    place = np.repeat(np.arange(len(order)), lengths)
    starts = np.r_[0, np.cumsum(lengths)]
    by_token = np.argsort(token, kind="stable")
    lists = place[by_token]  # ascending positions in every list
    ends = np.r_[0, np.cumsum(np.bincount(token))]
    size, side = sizes[order].astype(np.int64), None if sides is None else sides[order]
    pairs = []
    for x in range(len(order) - 1):
        mine = token[starts[x] : starts[x + 1]]
        largest = np.searchsorted(size, den * size[x] // num, side="right")  # no larger set can be a partner
        if largest <= x + 1:
            continue
        need = -(-2 * num * size[x] // (num + den))  # with the smallest partner, which is as large
        low = ends[mine]
        # Lists hold sets in order of size; only those after x count.
        after = [lists[a:b] for a, b in zip(low, ends[mine + 1], strict=True)]
        after = [part[np.searchsorted(part, x, side="right") :] for part in after]
        after = sorted((part for part in after if len(part)), key=len)
        if len(after) < need:
            continue
        skip = min(int(need / (SKIP_WEIGHT * math.log2(max(len(after[-1]), 2)) + 1)), int(need) - 1)
        short, long = after[: len(after) - skip], after[len(after) - skip :]
        merged = np.concatenate(short)
        merged = merged[merged < largest]
        merged.sort(kind="stable")  # merges the sorted lists
        first = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]]) if len(merged) else np.zeros(0, np.int64)
        occurs = np.diff(np.r_[first, len(merged)])
        found = occurs >= max(need - skip, 1)
        other, occurs = merged[first[found]], occurs[found]
        if side is not None:
            fits = side[other] != side[x]
            other, occurs = other[fits], occurs[fits]
        for part in long:
            if not len(other):
                break
            at = np.searchsorted(part, other)
            occurs = occurs + (part[np.minimum(at, len(part) - 1)] == other)
        linked = den * occurs >= num * (size[x] + size[other] - occurs)
        pairs += [(int(order[x]), int(order[y])) for y in other[linked]]
    return pairs


def _roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def block_links(sets: DataFrame, num: int, den: int, part: int = PART) -> DataFrame:
    """Search every block: ``key``, ``root`` (a class it is connected with there), ``links`` found there."""
    of_block = blocks(sets, num, den)
    counts = of_block.groupBy("block").agg(F.ceil(F.count("*") / part).cast("int").alias("cuts"))
    counts = stored(counts, "block-sizes")  # a plain table, so that a large block's rows can be split in the join
    placed = of_block.join(counts, "block").join(sets, "key")
    own = F.pmod(F.xxhash64("key"), F.col("cuts")).cast("int")
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    placed = placed.select(
        "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "key", "size", "tokens"
    )

    def search(group: pa.Table) -> pa.Table:
        keys, sides = group["key"].to_numpy(), group["own"].to_numpy()
        cross = group["low"][0].as_py() != group["high"][0].as_py()
        tokens = [np.asarray(row.values) for row in group["tokens"]]
        pairs = divide_skip(tokens, group["size"].to_numpy(), sides if cross else None, num, den)
        links = np.bincount(np.array(pairs, dtype=np.int64).ravel(), minlength=len(keys))
        roots = keys[_roots(len(keys), pairs)]
        linked = links > 0
        return pa.table({"key": keys[linked], "root": roots[linked], "links": links[linked].astype(np.int64)})

    return placed.groupBy("block", "low", "high").applyInArrow(search, "key long, root long, links long")


def jaccard_join(
    docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, id_column: str = "doc_id", text_column: str = "text", part: int = PART
) -> DataFrame:
    """Groups of documents linked by a shingle-set similarity of ``num / den`` or more.

    Words are runs of non-blank characters, A-Z lower-cased; a set is the distinct ``k``-word shingles,
    or the whole sequence of a text with fewer words. One row per row of ``docs``: the id,
    ``n_shingles``, ``component_id`` (least id reachable by links), ``n_links`` (other, different sets
    that it links with). Null, empty and blank texts have no shingles, no links and their own id.
    Repeated rows are rows of one class and link with each other; a null id never becomes a component's
    id unless all its ids are null. Other columns are not read; an empty table gives no rows.

    Memory of a task is set by ``spark.sql.shuffle.partitions``, which cuts shingles and classes into parts.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = stored(shared_shingles(shingle_parts(docs, id_column, text_column, k, parts), parts), "shared-shingles")
    sets = stored(candidates(shared, parts, num, den), "join-candidates")
    found = stored(block_links(sets, num, den, part), "join-links")
    joined = components(found, "key", "root").withColumnsRenamed({"node": "key"})
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"))

    documents = shared.filter("ids IS NOT NULL").select(F.explode(F.arrays_zip("ids", "keys", "sizes")).alias("d"))
    documents = documents.select(F.col("d.ids").alias("id"), F.col("d.keys").alias("key"), F.col("d.sizes").alias("size"))
    classes = documents.filter("size > 0").groupBy("key").agg(F.min("id").alias("least"))
    classes = stored(classes.join(joined, "key", "left").join(links, "key", "left"), "join-classes")
    # Stored, so that this join too has plain tables on both sides and a large component can be split.
    least = stored(classes.filter("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id")), "join-least")
    named = classes.join(least, "component", "left")
    named = stored(named.select("key", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "join-classes")
    full = documents.withColumn("key", F.when(F.col("size") > 0, F.col("key"))).join(named, "key", "left")
    return full.select(
        F.col("id").alias(id_column),
        F.col("size").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
