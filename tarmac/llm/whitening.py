"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Vectors are quantised: every entry ``c`` becomes the integer ``floor(256 * c)``. The fit list holds each different quantised vector once. Its
counts, sums and centred scatter are gathered in tasks; then the scatter, whose size depends on the dimensions alone, is factored as ``L L'`` with diagonal
pivoting, and the columns of ``L`` are rotated against each other until all are orthogonal (one-sided Jacobi, the pairs of a round at once).
The squared norms of the rotated columns are the eigenvalues of the scatter, the normalised columns its unit eigenvectors. No matrix product
squares the condition on the way from scatter to components.

Centring is exact in its large part: the integer part of each mean is subtracted from the integers, its fraction from what is left.

Scale: one shuffle of quantised vectors finds the different ones (equal ones meet on the map side first); the fit list is written to the shared
folder and read three times, for sums, scatter and the check of the result. Sums travel as one row per task and dimension, scatters as strips
of at most ``STRIP`` numbers per task, added up in two steps so that a group holds about the square root of the tasks. The driver gets the sums and the scatter:
``d * d`` doubles for d dimensions, 128 MB at 4,096 of them. Rows are then whitened where they are read, without a shuffle.

Rows: a vector that is null, or holds nulls, NaN or infinities, is dropped; so is one without the most frequent length (of several, the longest): it has no
entry where others have one. Repeated rows come out repeatedly, null ids stay. Components whose eigenvalue is not above ``d`` times the rounding
of the largest one do not exist: fewer than ``components`` rows per vector come out then, none if all vectors are equal or the table is empty. Entries beyond
the range of 64-bit integers take its ends. ``deviation`` is null where it has more than 38 digits. Other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.session import stored

COMPONENTS = 4
STEPS = 256
#: numbers of a scatter that travel as one row; rows centred at once
STRIP, ROWS = 1 << 17, 4096
#: sweeps of Jacobi rotations at most; they end when all columns are orthogonal to rounding
SWEEPS = 60


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``L`` with ``a = L L'`` for a positive semidefinite matrix, as many columns as its numerical rank.

    Rows stay in the order of ``a``; they form a triangle in the order of the pivots.
    """
    a = np.array(a, float)
    d = len(a)
    left, least = np.ones(d, bool), d * np.finfo(float).eps * max(a.diagonal().max(initial=0), 0)
    columns = []
    while left.any():
        pivot = int(np.argmax(np.where(left, a.diagonal(), -np.inf)))
        if a[pivot, pivot] <= least:
            break
        column = np.where(left, a[:, pivot] / math.sqrt(a[pivot, pivot]), 0.0)
        a -= np.outer(column, column)
        left[pivot] = False
        columns.append(column)
    return np.stack(columns, 1) if columns else np.zeros((d, 0))


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns, in rounds of disjoint ones."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1]) if max(a, b) < n]
        if pairs:
            yield tuple(np.array(side) for side in zip(*pairs))
        ring[1:] = [ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of ``factor factor'`` and their unit eigenvectors, as columns."""
    u = np.array(factor, float)
    enough = np.finfo(float).eps * max(1, math.sqrt(len(u)))
    for _ in range(SWEEPS):
        turned = 0.0
        for i, j in _rounds(u.shape[1]):
            x, y = u[:, i], u[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(xx) * np.sqrt(yy)
            off = np.divide(np.abs(xy), size, out=np.zeros_like(xy), where=size > 0)
            turned = max(turned, off.max())
            apart = off > enough
            slope = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=apart)
            tangent = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.hypot(1, slope)) * apart
            cosine = 1 / np.hypot(1, tangent)
            sine = tangent * cosine
            u[:, i], u[:, j] = x * cosine - y * sine, x * sine + y * cosine
        if turned <= enough:
            break
    norms = np.linalg.norm(u, axis=0)
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, u[:, order] / np.where(norms[order] > 0, norms[order], 1)


class Whitening:
    """What was learned from a fit list: ``n``, sums, eigenvalues, components (columns), trace and the error of the result."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, components: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.components, self.trace = n, sums, values, components, trace
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.sums, self.n)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of ``(n * x - S) ** 2``, exact."""
        reach = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n + max(map(abs, self.sums), default=0)
        fits = len(self.sums) * reach * reach < 1 << 63
        x = x if fits else x.astype(object)
        apart = self.n * x - np.array(self.sums, np.int64 if fits else object)
        return (apart * apart).sum(1).tolist()


def centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """Integers less their means, in doubles."""
    whole = [s // n for s in sums]
    rest = np.array([(s % n) / n for s in sums])
    fits = max(map(abs, whole), default=0) + max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < 1 << 63
    apart = x - np.array(whole, np.int64) if fits else (x.astype(object) - np.array(whole, object)).astype(float)
    return apart - rest


def quantised(vector: Column) -> Column:
    """Integers of a usable vector, else null."""
    vector = vector.cast("array<double>")
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c * float(STEPS))))


def _vectors(batch: pa.RecordBatch, at: int, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """The quantised vectors of column ``at``, some rows at a time, with the first row's place."""
    for start in range(0, batch.num_rows, ROWS):
        part = batch.column(at).slice(start, ROWS)
        yield start, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d)


def _sums(fit_list: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, object), np.zeros(d, object)
        for batch in batches:
            for _, x in _vectors(batch, 0, d):
                n += len(x)
                high, low = high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        totals = [Decimal(int(h) * (1 << 32) + int(s)) for h, s in zip(high, low)]
        yield pa.RecordBatch.from_arrays([pa.array([*range(d), -1], pa.int32()), pa.array([*totals, Decimal(n)], pa.decimal128(38, 0))], names=["at", "total"])

    rows = fit_list.mapInArrow(run, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total")).collect()
    total = {row["at"]: int(row["total"]) for row in rows}
    return total.get(-1, 0), [total.get(i, 0) for i in range(d)]


def _added(strips: DataFrame, *keys: str) -> DataFrame:
    """The sum of the strips of each key."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = 0.0
        for cell in group["cells"]:
            total = total + np.frombuffer(cell)
        return group[list(keys)].head(1).assign(cells=[total.tobytes()])

    return strips.groupBy(*keys).applyInPandas(add, ", ".join(f"{k} int" for k in keys) + ", cells binary")


def _gathered(fit_list: DataFrame, d: int, project, width: int) -> np.ndarray:
    """Sum over the fit list of ``z' z``, with ``z = project(x)`` of ``width`` columns."""
    height = max(1, STRIP // max(1, width))
    groups = max(1, math.isqrt(fit_list.rdd.getNumPartitions()))  # of tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for batch in batches:
            for _, x in _vectors(batch, 0, d):
                z = project(x)
                total += z.T @ z
                some = True
        if some:
            starts = range(0, width, height)
            group = TaskContext.get().partitionId() % groups
            cells = [total[s : s + height].tobytes() for s in starts]
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array([group] * len(cells), pa.int32()), pa.array(cells, pa.binary())], names=["strip", "part", "cells"])

    strips = fit_list.mapInArrow(run, "strip int, part int, cells binary")
    out = np.zeros((width, width))
    for row in _added(_added(strips, "strip", "part"), "strip").collect():
        strip = np.frombuffer(row["cells"]).reshape(-1, width)
        out[row["strip"] : row["strip"] + len(strip)] = strip
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learns from ``x``, the quantised vectors (nulls are ignored); None if there are none."""
    usable = vectors.where("x is not null")
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if not lengths:
        return None
    d = lengths["d"]
    fit_list = stored(usable.where(F.size("x") == d).select("x").distinct(), "vectors")
    n, sums = _sums(fit_list, d)
    scatter = _gathered(fit_list, d, partial(centred, sums=sums, n=n), d)
    values, vectors_ = one_sided_jacobi(pivoted_cholesky(scatter / n))
    real = values > d * np.finfo(float).eps * values.max(initial=0)
    kept = np.flatnonzero(real)[:components]
    found = Whitening(n, sums, values[kept], vectors_[:, kept], float(np.trace(scatter) / n))
    if len(kept):
        # one column of ones beside the whitened ones: its products are their sums
        ones = lambda x: np.column_stack([found.whitened(x), np.ones(len(x))])
        products = _gathered(fit_list, d, ones, len(kept) + 1) / n
        means = products[-1, :-1]
        found.identity_error = float(np.abs(products[:-1, :-1] - np.outer(means, means) - np.eye(len(kept))).max())
    return found


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: ``id_col``, ``component`` (from 1), ``n``, ``deviation`` (decimal), ``whitened``, ``explained`` and ``identity_error``."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), quantised(F.col(f"`{vector_col}`")).alias("x"))
    found = fit(rows.select("x"), components)
    schema = f"id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    d, k = len(found.sums), len(found.values)
    shared = vectors.sparkSession.sparkContext.broadcast(pickle.dumps(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pickle.loads(shared.value)
        for batch in batches:
            for start, x in _vectors(batch, 1, d):
                m = len(x)
                whitened = found.whitened(x).ravel()
                deviation = [Decimal(v) if v < 10**38 else None for v in found.deviations(x)]
                columns = [
                    batch.column(0).take(pa.array(np.repeat(np.arange(start, start + m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, found.n)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))), pa.array(whitened),
                    pa.array(np.tile(found.values / found.trace, m)), pa.array(np.full(m * k, found.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kept = rows.where(F.size("x") == d)  # false for null
    return (kept if k else kept.limit(0)).mapInArrow(run, schema).withColumnRenamed("id", id_col)
