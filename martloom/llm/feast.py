"""Leading eigenpairs of a symmetric matrix by contour integration, slice by slice.

The spectrum is cut where inertia says how many eigenvalues lie above: counts of a shifted matrix's
positive and negative pivots are exact. For each slice, a block of vectors is multiplied by the
resolvent at the nodes of a quadrature rule around the slice, which projects the block onto the
slice's eigenvectors; Rayleigh-Ritz in the projected space gives the pairs. A slice is done when
it has as many converged pairs as its inertia counts.

The complex shifted solves, all of a round, are independent tasks of Spark. What meets on the driver
is of the size of the matrix, d x d, whatever the number of vectors it was made of.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Nodes on the upper half of a contour; the lower half is their mirror image.
NODES = 8
# Widest slice, in eigenvalues, unless they are too close to be told apart.
SLICE = 4
# Rounds of projection, and the residual, relative to the largest eigenvalue, that ends them.
ROUNDS = 12
RESIDUAL = 1e-13


def positive_pivots(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above `shift`: the inertia of matrix - shift * I, by symmetric
    elimination with pivots of one or two rows (Bunch and Parlett's choice)."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    ratio = (1 + 17**0.5) / 8
    while len(a):
        size = np.abs(a)
        p = int(size.diagonal().argmax())
        i, j = np.unravel_index(int(size.argmax()), a.shape)
        if size[i, j] == 0:
            break
        if i == j or size[p, p] >= ratio * size[i, j]:
            keep = np.arange(len(a)) != p
            above += int(a[p, p] > 0)
            column = a[keep, p]
            a = a[np.ix_(keep, keep)] - np.outer(column, column) / a[p, p]
        else:
            # a pivot of two rows with a large element off its diagonal has one sign each
            pair = [i, j]
            keep = np.ones(len(a), bool)
            keep[pair] = False
            above += 1
            block, columns = a[np.ix_(pair, pair)], a[np.ix_(keep, pair)]
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
        a = (a + a.T) / 2
    return above


@dataclass(frozen=True)
class Slice:
    low: float
    high: float
    count: int


def slices(matrix: np.ndarray, wanted: int) -> list[Slice]:
    """Intervals that hold the largest eigenvalues, `wanted` or a few more, from above. Cuts are
    made by halving until a slice holds at most SLICE or is too narrow to be cut."""
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    if top == 0:
        return []
    narrow = top * 1e-10

    def cut(low: float, high: float, above_low: int, above_high: int) -> list[Slice]:
        count = above_low - above_high
        if count == 0 or above_high >= wanted:
            return []
        if high - low <= narrow or count <= SLICE:
            return [Slice(low, high, count)]
        middle = (low + high) / 2
        above = positive_pivots(matrix, middle)
        return cut(middle, high, above, above_high) + cut(low, middle, above_low, above)

    floor = top * 1e-12
    return cut(floor, top, positive_pivots(matrix, floor), 0)


def _solver(matrix: np.ndarray):
    """mapInArrow function: for each (slice, re, im, weight_re, weight_im, block) the real part of
    weight * (z I - matrix)^-1 block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity = np.eye(len(matrix))
        for batch in batches:
            rows = batch.to_pylist()
            parts = []
            for row in rows:
                block = np.frombuffer(row["block"], np.float64).reshape(len(matrix), -1)
                shifted = complex(row["re"], row["im"]) * identity - matrix
                solved = np.linalg.solve(shifted, block.astype(np.complex128))
                weight = complex(row["weight_re"], row["weight_im"])
                parts.append((weight * solved).real.astype(np.float64).tobytes())
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array([r["slice"] for r in rows], pa.int32()),
                    "node": pa.array([r["node"] for r in rows], pa.int32()),
                    "part": pa.array(parts, pa.binary()),
                }
            )

    return run


def _project(spark: SparkSession, matrix: np.ndarray, blocks: dict[int, np.ndarray], found: list[Slice]):
    """Each block times the quadrature of the resolvent around its slice."""
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angles = (points + 1) * np.pi / 2
    rows = []
    for k, block in blocks.items():
        low, high = found[k].low, found[k].high
        centre, radius = (low + high) / 2, (high - low) / 2
        data = np.ascontiguousarray(block).tobytes()
        for node, (angle, weight) in enumerate(zip(angles, weights, strict=True)):
            turn = np.exp(1j * angle)
            z, w = centre + radius * turn, weight / 2 * radius * turn
            rows.append((k, node, float(z.real), float(z.imag), float(w.real), float(w.imag), data))
    schema = "slice int, node int, re double, im double, weight_re double, weight_im double, block binary"
    tasks = spark.createDataFrame(rows, schema).repartition(len(rows))
    solved = tasks.mapInArrow(_solver(matrix), "slice int, node int, part binary").collect()
    sums = {k: np.zeros_like(block) for k, block in blocks.items()}
    for row in sorted(solved, key=lambda r: (r["slice"], r["node"])):
        sums[row["slice"]] += np.frombuffer(row["part"], np.float64).reshape(len(matrix), -1)
    return sums


def leading_pairs(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the largest positive eigenvalues, falling, at most `wanted`.

    Eigenvalues below 1e-12 of the largest row sum count as zero and are left out. Raises if a
    slice has not got as many pairs as its inertia says.
    """
    found = slices(matrix, wanted)
    size = len(matrix)
    random = np.random.default_rng(0)
    blocks = {
        k: random.standard_normal((size, min(size, 2 * s.count + 4)))
        for k, s in enumerate(found)
    }
    scale = float(np.abs(matrix).sum(axis=1).max()) or 1.0
    done: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    worst: dict[int, float] = {}
    for _ in range(ROUNDS):
        waiting = {k: blocks[k] for k in blocks if k not in done}
        if not waiting:
            break
        for k, projected in _project(spark, matrix, waiting, found).items():
            basis, _ = np.linalg.qr(projected)
            small = basis.T @ matrix @ basis
            values, turns = np.linalg.eigh((small + small.T) / 2)
            vectors = basis @ turns
            blocks[k] = vectors
            s = found[k]
            # as many Ritz values as inertia counts, those nearest to the middle of the slice first
            order = np.argsort(np.abs(values - (s.low + s.high) / 2), kind="stable")[: s.count]
            residual = np.abs(matrix @ vectors[:, order] - vectors[:, order] * values[order]).max()
            inside = (values[order] > s.low) & (values[order] <= s.high)
            # converged, or no better than the round before
            if inside.all() and (residual <= RESIDUAL * scale or residual >= worst.get(k, np.inf) / 2 <= 1e-10 * scale):
                done[k] = values[order], vectors[:, order]
            worst[k] = residual
    if len(done) < len(found):
        raise ArithmeticError(f"eigenvalues of a slice are missing: {[found[k] for k in blocks if k not in done]}")
    if not done:
        return np.zeros(0), np.zeros((size, 0))
    values = np.concatenate([done[k][0] for k in sorted(done)])
    vectors = np.concatenate([done[k][1] for k in sorted(done)], axis=1)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]
