"""Contour integration against a dense solver, whitening against numpy."""

import math
import random

import numpy as np
import pytest

from candlewick.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n long, x int"


def matrix(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        list(range(64, 0, -1)),
        [1 + 1e-7 * i for i in range(64)],
        [5, 5, 5, 5, 5, 5, 1, 1, 0, 0],
        [1e9, 1e9, 3, 1, 1e-9, 0, 0],
        [7, 0, 0, 0, 0],
        [3, 2],
        [2.5],
        [1, 1, 1, 1],
        [1e-30, 1e-31, 1e-32, 1e-40, 0],
    ],
)
def test_leading_eigenvalues(values):
    a = matrix(values)
    found, vectors = whitening.leading(a, 4)
    dense = np.linalg.eigvalsh(a)[::-1][:4]
    size = np.abs(a).max()
    assert np.abs(found - dense).max() <= 1e-13 * max(size, 1e-300) * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-12 * size * len(a)


def test_inertia_counts():
    a = matrix([9, 4, 4, 1, -2, 0.5])
    diagonal, off = whitening.tridiagonal(a)
    assert [whitening.count_above(diagonal, off, x) for x in (10, 5, 3, 0.7, 0, -3)] == [0, 1, 3, 4, 5, 6]


def plain(rows, components=4):
    usable = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    xs = [tuple(math.floor(256 * float(np.float32(c))) for c in r[1]) for r in usable]
    out = []
    for size in {len(x) for x in xs}:
        fit = sorted({x for x in xs if len(x) == size})
        n, sums = len(fit), [sum(x[i] for x in fit) for i in range(size)]
        centred = np.array([[(n * x[i] - sums[i]) / n for i in range(size)] for x in fit])
        v = centred.T @ centred / n
        values, vectors = np.linalg.eigh(v) if size else (np.zeros(0), np.zeros((0, 0)))
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        for row, x in zip(usable, xs, strict=True):
            if len(x) == size:
                far = sum((n * x[i] - sums[i]) ** 2 for i in range(size))
                d = np.array([(n * x[i] - sums[i]) / n for i in range(size)])
                for k, value in enumerate(values):
                    seen = value > 1e-9 * np.trace(v)
                    white = abs(d @ vectors[:, k]) / math.sqrt(value) if seen else None
                    out.append((str(row[0]), k + 1, n, far if far < 1 << 63 else None, white, value / np.trace(v) if np.trace(v) > 0 else None))
    return out


def ours(spark, rows, parts=4):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    return found, [(str(r["vec_id"]), r["component"], r["n"], r["deviation"], r["whitened"] and abs(r["whitened"]), r["explained"]) for r in found]


def agree(a, b):
    key = lambda r: (r[0], r[1], r[2], str(r[3]), round(r[4] or 0, 5))
    a, b = sorted(a, key=key), sorted(b, key=key)
    assert [r[:4] for r in a] == [r[:4] for r in b]
    for x, y in zip(a, b, strict=True):
        for p, q in zip(x[4:], y[4:], strict=True):
            assert (p is None) == (q is None) and (p is None or p == pytest.approx(q, rel=1e-6, abs=1e-6))


def test_whitening_equals_numpy(spark):
    """Null and non-finite entries, repeated rows and ids, a third of all rows one vector, other lengths, empty vectors."""
    rng = random.Random(3)
    rows = [(i % 70 or None, [rng.gauss(j, 1 + j % 5) for j in range(12)], "c", 1, 2) for i in range(200)]
    rows += [(1000, rows[0][1], "c", 1, 2)] * 100
    rows += [(2000 + i, [rng.random(), rng.random()], "", 0, 0) for i in range(9)] + [(1, [], "", 0, 0), (2, None, "", 0, 0)]
    rows += [(3, [None, 1.0], "", 0, 0), (4, [math.nan, 1.0], "", 0, 0), (5, [math.inf, 1.0], "", 0, 0)]
    found, mine = ours(spark, rows)
    agree(mine, plain(rows))
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "", 0, 0)], [(1, [1.0, 2.0], "", 0, 0)] * 3, [(1, None, "", 0, 0)], [(1, [0.0] * 3, "", 0, 0), (2, [1.0, 0.0, 0.0], "", 0, 0)]])
def test_tiny_tables(spark, rows):
    found, mine = ours(spark, rows, 1)
    agree(mine, plain(rows))


def test_huge_entries_stay_exact(spark):
    rows = [(i, [1e15 * i, float(i * i), 3.0], "", 0, 0) for i in range(8)] + [(9, [3e38, 0.0, 0.0], "", 0, 0)]
    found, _ = ours(spark, rows[:8])
    assert all(r["whitened"] is None or math.isfinite(r["whitened"]) for r in found)
    assert len(ours(spark, rows)[0]) == 27
