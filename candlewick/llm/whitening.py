"""Whitening of embeddings onto their leading principal components, found by contour integration (FEAST).

Vectors become whole numbers first, so counts, sums and products add up exactly, whatever the order. The covariance of the
distinct vectors is summed in tasks and by a grouped aggregation; only that matrix, as large
as the square of the vectors' length, reaches the driver. There its largest eigenvalues are
enclosed by counts of the inertia of shifted matrices; the projector onto that interval is a quadrature, along a
circle around it, of solutions of complex shifted systems; Rayleigh-Ritz takes the components out of the subspace.
At the end inertia counts show that no eigenvalue of the interval was missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import stored

#: Points of the quadrature on the half circle, rounds of filtering, and more directions than eigenvalues wanted.
POINTS, ROUNDS, SPARE = 16, 40, 4
#: Eigenvalues nearer than this part of the largest entry share an interval; counts are compared with this slack.
CLOSE, SLACK = 1e-9, 1e-11
#: A number from one vector entry: floor(SCALE * entry).
SCALE = 256

_LONG = 1 << 63


# --- eigenvalues of a symmetric matrix in an interval -----------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``a`` (Householder reflections)."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0.0:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        part = a[k + 1 :, :]
        part -= 2.0 * np.outer(x, x @ part)
        part = a[:, k + 1 :]
        part -= 2.0 * np.outer(part @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the shifted matrix (Sylvester's law of inertia)."""
    least = np.finfo(float).tiny * 1e16
    above, pivot = 0, 1.0
    for i, value in enumerate(diagonal):
        pivot = value - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < least:
            pivot = -least
        above += pivot > 0
    return above


def _edge(diagonal: np.ndarray, off: np.ndarray, wanted: int, low: float, high: float) -> float:
    """The ``wanted``-th largest eigenvalue, from below, by bisection of the inertia count."""
    for _ in range(200):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        if count_above(diagonal, off, middle) >= wanted:
            low = middle
        else:
            high = middle
    return low


def feast(a: np.ndarray, centre: float, radius: float, count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``a`` within ``radius`` of ``centre`` and unit eigenvectors, falling.

    Each round applies the contour's quadrature to the subspace, which damps everything outside the interval, and
    solves the small problem in it, until residuals fall no more. Fewer columns than ``count`` come back if that fails.
    """
    n = len(a)
    size = min(n, count + SPARE)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, size)))[0]
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turns = np.exp(1j * np.pi * (nodes + 1) / 2)  # the upper half circle; the lower one gives the conjugates
    best, values, vectors = np.inf, np.zeros(0), np.zeros((n, 0))
    for _ in range(ROUNDS):
        projected = np.zeros((n, size))
        for turn, weight in zip(turns, weights, strict=True):
            solved = np.linalg.solve((centre + radius * turn) * np.eye(n) - a, basis.astype(complex))
            projected += weight / 2 * np.real(radius * turn * solved)
        basis = np.linalg.qr(projected)[0]
        ritz, mixed = np.linalg.eigh(basis.T @ a @ basis)
        basis = basis @ mixed
        inside = np.flatnonzero(np.abs(ritz - centre) < radius)[::-1]
        if len(inside) == count:
            found = basis[:, inside]
            worst = np.abs(a @ found - found * ritz[inside]).max(initial=0.0)
            if worst >= best:
                break
            best, values, vectors = worst, ritz[inside], found
    return values, vectors


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric, positive semi-definite matrix and their unit eigenvectors, falling.

    Bisection of inertia counts finds where the eigenvalues lie; each one, or each cluster of values nearer to one
    another than ``CLOSE`` of the largest entry, has an interval of its own that ends half-way to the
    next, so the quadrature parts it well from the rest. A last Rayleigh-Ritz step over all
    intervals makes the components orthogonal. Every interval must hold as many eigenvalues as the inertia counts.
    """
    n = len(a)
    wanted = min(wanted, n)
    scale = float(np.abs(a).max(initial=0.0))
    if wanted == 0 or scale == 0.0:
        return np.zeros(wanted), np.eye(n)[:, :wanted]
    a = (a + a.T) / (2 * scale)
    diagonal, off = tridiagonal(a)
    top = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9)
    edges: list[float] = [2 * top + 1]

    def edge(k: int) -> float:
        while len(edges) <= k:
            edges.append(_edge(diagonal, off, len(edges), -top, top) if len(edges) <= n else -2 * top - 1)
        return edges[k]

    parts, first = [], 1
    while first <= wanted:
        last = first
        while edge(last) - edge(last + 1) < CLOSE:
            last += 1
        least = min(edge(first - 1) - edge(first), edge(last) - edge(last + 1))
        centre, radius = (edge(first) + edge(last)) / 2, (edge(first) - edge(last) + least) / 2
        count = count_above(diagonal, off, centre - radius) - count_above(diagonal, off, centre + radius)
        _, found = feast(a, centre, radius, count)
        if found.shape[1] != count or count != last - first + 1:
            raise ArithmeticError(f"contour integration found {found.shape[1]} of {count} eigenvalues near {centre * scale}")
        parts.append(found)
        first = last + 1
    basis = np.linalg.qr(np.hstack(parts))[0]
    values, mixed = np.linalg.eigh(basis.T @ a @ basis)
    values, vectors = values[::-1], (basis @ mixed)[:, ::-1]
    for k, value in enumerate(values, 1):
        if not count_above(diagonal, off, value + SLACK) < k <= count_above(diagonal, off, value - SLACK):
            raise ArithmeticError(f"eigenvalue {k} is not confirmed by the inertia count")
    return values[:wanted] * scale, vectors[:, :wanted]


# --- whole numbers, sums, and rows -----------------------------------------------------------------------------


def whole_numbers(rows: DataFrame, vector: str) -> DataFrame:
    """``x``: floor(256 * entry) of every entry as long; rows whose vector is null or has null, NaN or infinite entries are left out."""
    entry_ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    kept = rows.filter(F.col(vector).isNotNull() & entry_ok)
    return kept.withColumn("x", F.transform(vector, lambda c: F.floor(c.cast("double") * float(SCALE)).cast("long")))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), size)


def _by_size(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each vector length."""
    sizes = np.asarray(pc.list_value_length(column))
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def exact_sums(fit: DataFrame, column: str = "x") -> DataFrame:
    """``size``, ``i``, ``j``, ``total`` (decimal): sums of products ``x_i * x_j`` for i <= j; for j = -1 of ``x_i``, for i = j = -1 the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(0)
            for size, rows in _by_size(column):
                x = _matrix(column.take(pa.array(rows)), size)
                x = np.hstack([x, np.ones((len(x), 1), np.int64)])
                most = max(int(x.max()), -int(x.min()), 1)
                exact = most * most * len(x) < _LONG
                # Below 2 ** 53 sums of products are exact in double precision, where they are fastest.
                y = x.astype(np.float64) if most * most * len(x) < 1 << 53 else x if exact else x.astype(object)
                product = y.T @ y
                product = (product.astype(np.int64) if exact else product).astype(object)
                totals[size] = totals[size] + product if size in totals else product
        for size, total in totals.items():
            i, j = np.triu_indices(size + 1)
            values = [str(v) for v in total[i, j]]
            i, j = np.where(j == size, np.where(i == size, -1, i), i), np.where(j == size, -1, j)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, pa.string())],
                names=["size", "i", "j", "part"],
            )

    parts = fit.select(column).mapInArrow(run, "size int, i int, j int, part string")
    return parts.groupBy("size", "i", "j").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))


@dataclass
class Model:
    """Of one vector length: the fit list's rows ``n``, sums, components with falling variances, and their part of the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def fit_models(fit: DataFrame, components: int) -> dict[int, Model]:
    """A model per vector length from the exact sums; the covariance's entries are correctly rounded from whole numbers."""
    tables: dict[int, dict[tuple[int, int], int]] = {}
    for row in exact_sums(fit).collect():  # as many rows as a covariance has entries
        tables.setdefault(row["size"], {})[row["i"], row["j"]] = int(row["total"])
    models = {}
    for size, table in tables.items():
        n, sums = table[-1, -1], [table[i, -1] for i in range(size)]
        covariance = np.zeros((size, size))
        for (i, j), total in table.items():
            if j >= 0:
                covariance[i, j] = covariance[j, i] = (n * total - sums[i] * sums[j]) / (n * n)
        values, vectors = leading(covariance, components)
        trace = sum(n * table[i, i] - sums[i] ** 2 for i in range(size)) / (n * n)
        values = np.where(values > trace * 1e-13, values, 0.0)
        models[size] = Model(n, sums, values, vectors, values / trace if trace > 0 else np.full(len(values), np.nan))
    return models


def _centred(x: np.ndarray, model: Model) -> np.ndarray:
    """n * x - S: whole numbers, as long where the length allows, else without bound."""
    room = max((abs(int(v)) for v in (x.max(initial=0), x.min(initial=0))), default=0) * model.n + max(map(abs, model.sums), default=0)
    if room**2 * max(len(model.sums), 1) < _LONG:
        return x * np.int64(model.n) - np.array(model.sums, np.int64)
    return x.astype(object) * model.n - np.array(model.sums, object)


def _whitened(x: np.ndarray, model: Model) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        out = ((_centred(x, model) / model.n).astype(np.float64) @ model.vectors) / np.sqrt(model.values)
    return np.where(model.values > 0, out, np.nan)


def project(rows: DataFrame, models: dict[int, Model], keep: str | None) -> DataFrame:
    """Every row's list of ``whitened`` values; with the column ``keep`` also that, ``deviation``, ``n`` and the list ``explained``."""
    sent = rows.sparkSession.sparkContext.broadcast({size: tuple(vars(model).values()) for size, model in models.items()})  # a few vectors for each length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {size: Model(*fields) for size, fields in sent.value.items()}
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for size, at in _by_size(column):
                model, at = known[size], pa.array(at)
                x = _matrix(column.take(at), size)
                values = _whitened(x, model)
                width = values.shape[1]
                lists = lambda a, kind: pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(a.ravel(), kind, from_pandas=True)
                )
                out = [lists(values, pa.float64())]
                if keep:
                    far = (_centred(x, model).astype(object) ** 2).sum(axis=1) if size else np.zeros(len(x), object)
                    far = [int(v) if v < _LONG else None for v in far]
                    shares = lists(np.tile(model.explained, (len(x), 1)), pa.float64())
                    out = [batch.column(0).take(at), pa.array(far, pa.int64()), pa.array([model.n] * len(x), pa.int64()), *out, shares]
                yield pa.RecordBatch.from_arrays(out, names=["id", "deviation", "n", "whitened", "explained"] if keep else ["whitened"])

    if not keep:
        return rows.select("x").mapInArrow(run, "whitened array<double>")
    kind = rows.schema[keep].dataType.simpleString()
    return rows.select(keep, "x").mapInArrow(run, f"id {kind}, deviation long, n long, whitened array<double>, explained array<double>")


def identity_error(fit: DataFrame, models: dict[int, Model], components: int) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the identity, over all lengths; null without a component.

    Measured on the rows, not derived: covariances are summed around running means, a length at a time.
    """
    errors = []
    for size, model in models.items():
        used = int((model.values > 0).sum())
        if used == 0:
            continue
        pairs = [(i, j) for i in range(used) for j in range(i, used)]
        w = [F.get("whitened", F.lit(i)) for i in range(used)]
        own = fit if len(models) == 1 else fit.filter(F.size("x") == size)
        row = project(own, {size: model}, None).agg(*[F.covar_pop(w[i], w[j]) for i, j in pairs]).first()
        errors += [abs(value - (i == j)) for value, (i, j) in zip(row, pairs, strict=True)]
    return max(errors, default=None)


def whiten(rows: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Every usable row's whitened coordinates along the leading components of all distinct vectors.

    One row per row and component: the id, ``component`` (from 1), ``n`` (distinct vectors), ``deviation`` (squared
    distance of ``n`` times the whole-number vector from the sums; null beyond a long), ``whitened``, ``explained``,
    ``identity_error``. Left out: rows whose vector is null or holds null, NaN or infinite entries. Repeated
    rows and ids, and null ids, each give their own rows. Vectors of another length are a space of their own, with
    their own components; an empty vector has none. A component without variance (one distinct vector, or
    fewer dimensions than components) has a null ``whitened``. An empty table gives no rows. Other columns are not read.
    """
    numbers = whole_numbers(rows.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v")), "v")
    fit = stored(numbers.select("x").distinct(), "whitening-fit")
    models = fit_models(fit, components)
    error = identity_error(fit, models, components)
    found = project(numbers, models, "id")
    each = found.select("id", "n", "deviation", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "one"))
    return each.select(
        F.col("id").alias(id_column),
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("one.whitened").alias("whitened"),
        F.col("one.explained").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
