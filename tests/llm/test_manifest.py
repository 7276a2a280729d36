"""Merkle manifest against a plain one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from candlewick.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node int, place string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_siblings(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((level[at ^ 1], at % 2 == 1) if at ^ 1 < len(level) else None)
        at //= 2
    return out


def plain_manifest(rows):
    def leaf(row, more=0):
        n_chars = None if row[4] is None else row[4] + more
        return sha("".join(framed(x) for x in (row[0], row[3], row[2], n_chars, row[1])))

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for group in order:
        groups[group].sort(key=lambda x: x[:3])
        trees.append(plain_tree([x[2] for x in groups[group]]))
    top, out = plain_tree([tree[-1][0] for tree in trees]), []
    for number, group in enumerate(order):
        for at, (_, _, node, row) in enumerate(groups[group]):
            met = plain_siblings(trees[number], at) + plain_siblings(top, number)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            now = leaf(row, 1) if hit else node
            for other in met:
                now = sha(now) if other is None else sha(other[0] + now) if other[1] else sha(now + other[0])
            proof = "".join(x[0] for x in met if x)
            out.append((str(row[0]), node, trees[number][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out)


def ours(docs, every):
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = manifest.manifest(docs, altered={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, every=every)
    return sorted(
        (str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], "".join(s["node"] for s in r["siblings"] if s), r["folded_root"], r["verified"])
        for r in found.collect()
    )


@pytest.mark.parametrize(("n", "every"), [(1, 8), (2, 1), (170, 1), (300, 3), (600, 8)])
def test_manifest_equals_plain_one(spark, n, every):
    """Null fields, empty and long texts, repeated ids and rows, groups of all sizes, columns named like ours."""
    rng = random.Random(n)
    rows = [
        (rng.choice([None, i, i, i, 7]), rng.choice([None, "", "tüx " * rng.randint(1, 5)]), rng.choice([None, "", "de", "en", "en", "é", f"one{i % 3}"]),
         rng.choice([None, "s"]), rng.choice([None, i]), i, "x")
        for i in range(n)
    ]
    rows += [(5, "same", "en", "s", 4, 0, None)] * (n // 10) + [(n, "long " * 100_000, "en", None, 0, 0, None)] * (n // 100)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert ours(docs, every) == plain_manifest(rows)


def test_manifest_of_no_rows(spark):
    assert manifest.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_every_few_levels_are_written(spark):
    leaves = spark.range(0, 1000).selectExpr("0L AS tree", "id AS place", "sha2(CAST(id AS string), 256) AS node")
    written, tops = manifest.grow(leaves, every=4)
    assert [level.count() for level in written] == [1000, 63, 4, 1]
    assert tops.select("height").first()[0] == 10
