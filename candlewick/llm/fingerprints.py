"""Merkle fingerprints of texts: pieces, paragraphs, sections, root.

A text is cut into sections (at blank lines), sections into paragraphs (lines), paragraphs into pieces
of a few words. A piece's hash covers its characters, every other node's hash its children's hashes.
Equal roots mean equal texts; below two roots, only branches that differ need a look.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

#: Words of a piece, the leaf of the tree.
PIECE_WORDS = 6
ROOT_HEX, NODE_HEX, LEAF_HEX = 32, 8, 8

#: A piece with the white space after it; a piece also ends with its line.
_PIECE = re.compile(r"[^\S\n]*(?:\S+[^\S\n]*){1,%d}\n?|[^\S\n]*\n|[^\S\n]+" % PIECE_WORDS)
_LINE = re.compile(r"[^\n]*\n|[^\n]+")
_SECTION = re.compile(r"(?<=\n)(?=[^\S\n]*\n)")


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str | None) -> str:
    """Tree of a text as a string: root ``;`` sections, each ``hash:paragraphs``, each ``hash=leaves``.

    A leaf is 8 hex digits of the piece's hash. Null counts as empty; the empty text has a root only.
    """
    sections = []
    for section in _SECTION.split(text or ""):
        paragraphs = []
        for line in section.splitlines(keepends=True) if "\r" not in section else re.findall(r"[^\n]*\n|[^\n]+", section):
            leaves = [xxh3_128_digest(piece.encode("utf-8", "surrogatepass")) for piece in _PIECE.findall(line)]
            paragraphs.append((_hash(b"p" + b"".join(leaves)), leaves))
        if paragraphs:
            sections.append((_hash(b"s" + b"".join(node for node, _ in paragraphs)), paragraphs))
    root = _hash(b"r" + b"".join(node for node, _ in sections)).hex()[:ROOT_HEX]
    parts = [
        node.hex()[:NODE_HEX] + ":" + ",".join(
            own.hex()[:NODE_HEX] + "=" + "".join(leaf.hex()[:LEAF_HEX] for leaf in leaves) for own, leaves in paragraphs
        )
        for node, paragraphs in sections
    ]
    return ";".join([root, *parts])


def _leaves(branch: str) -> Counter:
    found: Counter = Counter()
    for paragraph in branch.partition(":")[2].split(","):
        digits = paragraph.partition("=")[2]
        found.update(digits[i : i + LEAF_HEX] for i in range(0, len(digits), LEAF_HEX))
    return found


def likeness(a: str, b: str) -> float:
    """Shared pieces of two fingerprints, 2 * common / all, from 0 to 1; 1 exactly if the roots are equal.

    Sections with equal hashes are taken off whole; only those that differ are opened.
    """
    left, right = a.split(";"), b.split(";")
    if left[0] == right[0]:
        return 1.0
    ours, theirs = Counter(left[1:]), Counter(right[1:])
    same = 0
    for branch in list(ours.keys() & theirs.keys()):
        times = min(ours[branch], theirs[branch])
        same += times * _leaves(branch).total()
        ours[branch] -= times
        theirs[branch] -= times
    mine, other = Counter(), Counter()
    for source, target in ((ours, mine), (theirs, other)):
        for branch, times in source.items():
            for leaf, n in _leaves(branch).items() if times else ():
                target[leaf] += n * times
    common = same + (mine & other).total()
    total = 2 * same + mine.total() + other.total()
    return min(2.0 * common / total, 1.0 - 1e-9) if total else 0.0


def changed_sections(a: str, b: str) -> list[int]:
    """Numbers of the sections of ``b`` whose branch is not in ``a``: where an edit lies."""
    known = set(a.split(";")[1:])
    return [i for i, branch in enumerate(b.split(";")[1:]) if branch not in known]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Root and tree of every text: the id, ``n_chars``, ``root``, ``fingerprint``.

    Null counts as empty; repeated rows and null ids stay; an empty table gives none; other columns
    are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py()) for text in batch.column(1)]
            sizes = [len(text.as_py()) for text in batch.column(1)]
            roots = [value[:ROOT_HEX] for value in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(roots, pa.string()), pa.array(found, pa.string())],
                names=["id", "n_chars", "root", "fingerprint"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, n_chars long, root string, fingerprint string")
    return made.withColumnRenamed("id", id_column)


def _place(cuts: list[int]):
    """Number of cuts at or below the id, as a balanced tree of comparisons."""

    def tree(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("id") < cuts[middle], tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(F.col("id").isNull(), F.lit(len(cuts))).otherwise(tree(0, len(cuts)))


def in_order(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows in ascending id order over many partitions, each partition followed by the next one's first row.

    Columns ``id``, ``text``, ``extra`` (true for that added row; the last partition is followed by the
    first row of all). Repeated ids are ordered by text, null ids come last, null texts count as empty.
    The ranges come from approximate quantiles of the ids, so they hold about equally many rows; the
    least id of each range is all that is collected. No window spans the table.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = [i / ranges for i in range(1, ranges)] or [1.0]
    cuts = sorted(set(rows.agg(F.percentile_approx("id", wanted, 10_000)).first()[0] or []))
    placed = rows.withColumn("part", _place(cuts))
    least = {row["part"]: row["least"] for row in placed.groupBy("part").agg(F.min("id").alias("least")).collect()}
    order = sorted(least)
    before = {least[part]: order[i - 1] for i, part in enumerate(order)}
    heads = rows.filter(F.col("id").isin([x for x in before if x is not None]) | (F.col("id").isNull() & F.lit(None in before)))
    to = F.lit(before.get(None, 0))
    for value, part in before.items():
        to = to if value is None else F.when(F.col("id") == value, part).otherwise(to)
    tails = heads.groupBy("id").agg(F.min("text").alias("text")).select("id", "text", to.alias("part"), F.lit(True).alias("extra"))
    both = placed.withColumn("extra", F.lit(False)).unionByName(tails)
    dealt = both.repartitionById(len(cuts) + 1, F.col("part").cast("int"))
    return dealt.sortWithinPartitions("part", "extra", F.col("id").asc_nulls_last(), "text").select("id", "text", "extra")


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of an edited text, and their likeness, in one pass in id order.

    Columns: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. See ``in_order`` for ties and nulls; a table of one row is followed
    by itself; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        last = None
        for batch in batches:
            made: list[list] = [[] for _ in names]
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                text = value.as_py()
                tree = fingerprint(text)
                if last is not None:
                    old_key, old, old_tree = last
                    new = edited(old, text)
                    new_tree = fingerprint(new)
                    digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    row = (old_key, len(old), digest, old_tree, new_tree, likeness(old_tree, new_tree), likeness(old_tree, tree))
                    for column, item in zip(made, row, strict=True):
                        column.append(item)
                last = (key.as_py(), text, tree)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)], names=names)

    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return in_order(docs, id_column, text_column).mapInArrow(run, schema).withColumnRenamed("id", id_column)
