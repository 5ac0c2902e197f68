"""Whitening of embeddings: projections on the leading principal components, each with a variance of one.

Vectors are read where they lie, in a few passes. Tasks send sums only: first the exact sums of every dimension, then
the products of centred vectors. The driver gets one covariance matrix, whose size depends on the dimensions and not
on the rows. It is made tridiagonal by Householder reflections; its leading eigenvalues come from bisection on Sturm
counts, its eigenvectors from inverse iteration, with those of close eigenvalues made orthogonal to each other. Tasks get
the means and components and project.

Entries are taken as whole numbers, ``floor(scale * entry) + shift``; so sums and deviations are exact.

Rows whose vector is null or empty, or holds null or non-finite entries, are left out. If lengths differ, the most frequent
counts (of equally frequent ones the largest) and the others are left out. Whole numbers beyond 2**61 count as 2**61. Repeated rows
and ids each count; null ids are kept; extra columns are ignored. A component without variance has no whitened values: null. An empty table
has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST = float(1 << 61)
#: Matrices that are held by the driver and by every task: 64 MB.
MAX_DIMENSIONS = 2896


@dataclass
class Model:
    """What a projection needs: all of it a few times the dimensions, or the square of them."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray  # leading ones, falling
    components: np.ndarray  # one in each column
    trace: float
    scale: float
    shift: int
    identity_error: float = 0.0

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The means as the nearest whole numbers and what is left."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)]
        return np.array(whole, np.int64), np.array(rest)

    @property
    def varied(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        e = self.eigenvalues
        return e > len(self.sums) * np.finfo(float).eps * max(float(e[0]), 0.0) if len(e) else e > 0


# ---- eigenvalues and eigenvectors of a symmetric matrix


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflections of the tridiagonal matrix similar to ``a``."""
    a = np.array(a, float)
    d = len(a)
    reflections = []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        v = np.zeros_like(x)
        if size and np.any(x[1:]):
            v = x / size
            v[0] += np.copysign(1.0, v[0])
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            p = 2 * rest @ v
            w = p - (v @ p) * v
            rest -= np.outer(v, w)
            rest -= np.outer(w, v)
            x -= 2 * v * (v @ x)
            a[k + 1 :, k] = a[k, k + 1 :] = x
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def counts_below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm counts: eigenvalues of the tridiagonal matrix below each point."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = diagonal[0] - points
    found = (q < 0).astype(int)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        with np.errstate(over="ignore"):
            q = diagonal[i] - points - off[i - 1] ** 2 / q
        found += q < 0
    return found


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, by bisection down to neighbouring numbers."""
    d = len(diagonal)
    reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    room = (abs(low) + abs(high)) * 1e-12 + np.finfo(float).tiny
    lo, hi = np.full(k, low - room), np.full(k, high + room)
    order = d - np.arange(1, k + 1)  # as many eigenvalues are below the one looked for
    for _ in range(200):
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            break
        below = counts_below(diagonal, off, mid) <= order
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return lo + (hi - lo) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves the tridiagonal system less ``value`` times the identity: elimination with row exchanges, done once."""
    d = len(diagonal)
    least = np.finfo(float).eps * max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0)), np.finfo(float).tiny)
    p, q, r = diagonal - value, np.append(off, 0.0), np.zeros(d)  # a row's entries from the diagonal on
    factors, exchanged = np.zeros(d), np.zeros(d, bool)
    for i in range(d - 1):
        below, after = off[i], q[i + 1]
        if abs(below) > abs(p[i]):
            exchanged[i] = True
            p[i], q[i], r[i], own, own_next = below, p[i + 1], after, p[i], q[i]
            factors[i] = own / p[i]
            p[i + 1], q[i + 1] = own_next - factors[i] * q[i], -factors[i] * r[i]
        else:
            if abs(p[i]) < least:
                p[i] = least
            factors[i] = below / p[i]
            p[i + 1] -= factors[i] * q[i]
    if abs(p[-1]) < least:
        p[-1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for i in range(d - 1):
            if exchanged[i]:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= factors[i] * b[i]
        for i in range(d - 1, -1, -1):
            b[i] -= (q[i] * b[i + 1] if i + 1 < d else 0) + (r[i] * b[i + 2] if i + 2 < d else 0)
            b[i] /= p[i]
        return b

    return solve


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors of falling ``values``, one in each column, by inverse iteration.

    Those of a cluster, values within a thousandth of the matrix's size of the one before, are made orthogonal in every step.
    """
    d = len(diagonal)
    size = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0))
    if not size:
        return np.eye(d)[:, : len(values)]
    random = np.random.default_rng(7)
    found = np.zeros((d, len(values)))
    start, used = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            start = j
        # equal values are moved apart by rounding's size, so that their systems differ
        used = min(float(value), used - 4 * np.finfo(float).eps * size)
        solve = _solver(diagonal, off, used)
        v = random.standard_normal(d)
        for _ in range(6):
            v /= np.linalg.norm(v)
            v = solve(v)
            v /= np.abs(v).max()
            for _ in range(2):
                for i in range(start, j):
                    v -= (found[:, i] @ v) * found[:, i]
            if np.linalg.norm(v) < 1e-8:
                v = random.standard_normal(d)
        found[:, j] = v / np.linalg.norm(v)
    return found


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    A vector's largest entry is positive.
    """
    size = float(np.abs(a).max(initial=0)) or 1.0
    diagonal, off, reflections = tridiagonal(a / size)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = eigenvectors(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    return values * size, vectors * np.where(vectors[largest, np.arange(k)] < 0, -1.0, 1.0)


# ---- passes over the vectors


def _vectors(column: pa.Array, dimensions: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and entries of the usable vectors of a batch, for each length, or that of ``dimensions`` only."""
    lengths = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    known = flat.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(values)
    for d in np.unique(lengths) if dimensions is None else [dimensions]:
        rows = np.flatnonzero(lengths == d)
        if not d or not len(rows):
            continue
        at = starts[rows][:, None] + np.arange(d)
        usable = known[at].all(axis=1)
        if usable.any():
            yield rows[usable], values[at[usable]]


def _whole(entries: np.ndarray, scale: float, shift: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * entries), -MOST, MOST).astype(np.int64) + shift


def _sums(narrow: DataFrame, scale: float, shift: int) -> tuple[int, list[int]]:
    """``n`` and exact sums of the most frequent length's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, entries in _vectors(batch.column("vector"), None):
                x = _whole(entries, scale, shift)
                d = x.shape[1]
                n, high, low = held.get(d, (0, np.zeros(d, np.int64), np.zeros(d, np.int64)))
                # halves of 32 bits can't overflow, whatever the entries
                held[d] = [n + len(rows), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)]
        for d, (n, high, low) in held.items():
            cells = [pa.array([d] * d), pa.array(np.arange(d)), pa.array([n] * d), pa.array(high), pa.array(low)]
            yield pa.RecordBatch.from_arrays([c.cast(pa.int64()) for c in cells], names=["d", "at", "n", "high", "low"])

    parts = narrow.select("vector").mapInArrow(run, "d long, at long, n long, high long, low long")
    total = parts.groupBy("d", "at").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])
    most = total.groupBy("d").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).first()
    if most is None:
        return 0, []
    if most["d"] > MAX_DIMENSIONS:
        raise ValueError(f"vectors have {most['d']} dimensions; a covariance is held for at most {MAX_DIMENSIONS}")
    rows = total.where(F.col("d") == most["d"]).orderBy("at").collect()
    return most["n"], [(r["high"] << 32) + r["low"] for r in rows]


def _products(narrow: DataFrame, width: int, project: Callable[[pa.Array], Iterator[np.ndarray]], mean: np.ndarray) -> np.ndarray:
    """Sum of the outer products of what ``project`` makes of the vectors, less ``mean``. Tasks send one matrix each, by rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((width, width))
        for batch in batches:
            for y in project(batch.column("vector")):
                y = y - mean
                held += y.T @ y
        if held.any():
            task = TaskContext.get().partitionId()
            cells = pa.FixedSizeListArray.from_arrays(pa.array(held.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([task] * width), pa.array(np.arange(width)), cells], names=["task", "at", "cells"])

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("task").to_numpy())  # always the same sum of the same parts
        cells = table.column("cells").combine_chunks().flatten().to_numpy().reshape(-1, width)[order]
        return pa.table({"at": table.column("at").slice(0, 1), "cells": pa.array([cells.sum(axis=0)], pa.list_(pa.float64()))})

    parts = narrow.select("vector").mapInArrow(run, "task long, at long, cells array<double>")
    found = np.zeros((width, width))
    for row in parts.groupBy("at").applyInArrow(add, "at long, cells array<double>").collect():
        found[row["at"]] = row["cells"]
    return found


def _centred(model: Model) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    whole, rest = model.centre
    d, scale, shift = len(whole), model.scale, model.shift

    def project(column: pa.Array) -> Iterator[np.ndarray]:
        for _, entries in _vectors(column, d):
            yield (_whole(entries, scale, shift) - whole) - rest

    return project


def _whitener(model: Model) -> np.ndarray:
    """Components divided by their standard deviations, those with variance only."""
    return model.components[:, model.varied] / np.sqrt(model.eigenvalues[model.varied])


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 32, scale: float = 64, shift: int = 1_000_000) -> Model:
    """Means, leading eigenvalues and components of all usable vectors, and how far the covariance of the whitened is from the identity."""
    narrow = vectors.select(F.col(f"`{vector}`").alias("vector"))
    n, sums = _sums(narrow, scale, shift)
    model = Model(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0, scale, shift)
    if not n:
        return model
    d = len(sums)
    covariance = _products(narrow, d, _centred(model), np.zeros(d)) / n
    model.trace = float(np.trace(covariance))
    model.eigenvalues, model.components = leading_components(covariance, min(components, d))
    whitener, centred = _whitener(model), _centred(model)
    k = whitener.shape[1]
    if k:

        def with_one(column: pa.Array) -> Iterator[np.ndarray]:
            for y in centred(column):
                yield np.column_stack([y @ whitener, np.ones(len(y))])

        # the last row of products with one is the sum
        mean = _products(narrow, k + 1, with_one, np.zeros(k + 1))[-1, :k] / n
        found = _products(narrow, k, lambda column: (y @ whitener for y in centred(column)), mean) / n
        model.identity_error = float(np.abs(found - np.eye(k)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """Exact sums of ``(n * x - S) ** 2`` over the dimensions."""
    d = len(sums)
    most = max(int(np.abs(x).max(initial=0)) * n, max(abs(s) for s in sums))
    if most < 1 << 61:
        v = n * x - np.array(sums, np.int64)
        if int(np.abs(v).max(initial=0)) ** 2 * d < 1 << 62:
            return [Decimal(int(s)) for s in (v * v).sum(axis=1)]
    return [Decimal(sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))) for row in x.tolist()]


def whiten(vectors: DataFrame, model: Model, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row for each usable vector and component.

    ``deviation`` is a decimal of 38 digits, null beyond them.
    """
    narrow = vectors.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    k, d = len(model.eigenvalues), len(model.sums)
    schema = T.StructType(
        [
            T.StructField("id", narrow.schema["id"].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    (whole, rest), varied, whitener = (model.centre if model.n else ((), ())), model.varied, _whitener(model)
    explained = model.eigenvalues / model.trace if model.trace > 0 else np.full(k, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, entries in _vectors(batch.column("vector"), d):
                x = _whole(entries, model.scale, model.shift)
                values = np.full((len(x), k), np.nan)
                values[:, varied] = ((x - whole) - rest) @ whitener
                exact = [v if v < 10**38 else None for v in deviations(x, model.n, model.sums)]
                again = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)).take(again),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, model.n)),
                        pa.array(exact, pa.decimal128(38, 0)).take(again),
                        pa.array(values.ravel(), from_pandas=True),
                        pa.array(np.tile(explained, len(x)), from_pandas=True),
                        pa.array(np.full(len(x) * k, model.identity_error)),
                    ],
                    names=schema.names,
                )

    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id)
