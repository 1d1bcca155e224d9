"""Whitened embeddings: scores on the leading principal components, with unit variance.

Entries are integers (fixed point), so counts, sums, deviations and the covariance's numerator are
exact and do not depend on how rows are dealt over tasks. Each task adds up its own rows; what
the tasks hold is added up by Spark, by position in the d x d matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martloom.llm.feast import leading_pairs

COMPONENTS = 8
# An entry c stands for the integer floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
# Entries of one block of rows in a task.
BLOCK = 1 << 20


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows whose vector has entries, none of them null or not finite."""
    rows = embeddings.select("vec_id", F.col(vector).alias("vector"))
    infinite = F.lit(float("inf"))
    finite = F.forall("vector", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < infinite))
    return rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(finite)


def _blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integers) of a batch in blocks of rows."""
    step = max(1, BLOCK // size)
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        entries = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        scaled = np.floor(entries * SCALE)
        if len(scaled) and np.abs(scaled).max() >= 2.0**62:
            raise OverflowError("an entry is too large for a long")
        yield part.column("vec_id"), (scaled.astype(np.int64) + SHIFT).reshape(-1, size)


def _exact_sum(x: np.ndarray) -> list[int]:
    """Sums over rows, as integers of any size."""
    if len(x) and int(np.abs(x).max()) * len(x) >= 1 << 62:
        return [int(v) for v in x.astype(object).sum(axis=0)]
    return x.sum(axis=0).tolist()


def _exact_products(y: np.ndarray) -> list[int]:
    """The sums of products y' y, the upper triangle row by row. Products of doubles are exact while
    they add up to less than 2^53, and then fast."""
    upper = np.triu_indices(y.shape[1])
    most = int(np.abs(y).max()) if y.size else 0
    if most * most >= 1 << 53:
        exact = y.astype(object)
        return [int(v) for v in (exact.T @ exact)[upper]]
    step = max(1, (1 << 53) // max(1, most * most))
    sums = [0] * len(upper[0])
    for start in range(0, len(y), step):
        part = y[start : start + step].astype(np.float64)
        for i, value in enumerate((part.T @ part)[upper].tolist()):
            sums[i] += int(value)
    return sums


def _task_sums(size: int, of: Callable[[np.ndarray], list[int]], width: int):
    """mapInArrow function: (place, value) of the sums that `of` makes, one row a place and task.
    Values leave as text, as they may be larger than a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, any_rows = [0] * width, False
        for batch in batches:
            for _, x in _blocks(batch, size):
                any_rows = any_rows or len(x) > 0
                for i, value in enumerate(of(x)):
                    sums[i] += value
        if any_rows:
            yield pa.RecordBatch.from_pydict(
                {
                    "place": pa.array(range(width), pa.int64()),
                    "value": pa.array([str(int(v)) for v in sums], pa.string()),
                }
            )

    return run


def _added(rows: DataFrame, size: int, of: Callable[[np.ndarray], list[int]], width: int) -> list[int]:
    """The sums of all tasks, `width` numbers."""
    parts = rows.mapInArrow(_task_sums(size, of, width), "place long, value string")
    total = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    sums = [0] * width
    for row in parts.groupBy("place").agg(total).collect():
        sums[row["place"]] = int(row["value"])
    return sums


def _covariance(count: int, sums: list[int], middle: list[int], products: list[int]) -> np.ndarray:
    """The covariance of integers, divisor `count`, from sums of y = x - middle: each entry is
    rounded once."""
    size = len(sums)
    left = [s - count * m for s, m in zip(sums, middle, strict=True)]
    matrix = np.zeros((size, size))
    for i, j, product in zip(*np.triu_indices(size), products, strict=True):
        entry = Fraction(count * product - left[i] * left[j], count * count)
        matrix[i, j] = matrix[j, i] = float(entry)
    return matrix


def _scores(count: int, sums: list[int], middle: list[int], directions: np.ndarray):
    """Function from integers to whitened scores; (x - S/n) is worked out as (x - m) - (S/n - m)."""
    rest = np.array([float(Fraction(s, count) - m) for s, m in zip(sums, middle, strict=True)])
    middles = np.array(middle, np.int64)

    def scores(x: np.ndarray) -> np.ndarray:
        return ((x - middles).astype(np.float64) - rest) @ directions

    return scores


def _score_sums(size: int, scores: Callable[[np.ndarray], np.ndarray], k: int):
    """mapInArrow function: count, mean and centred products of the scores of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _blocks(batch, size):
                w = scores(x)
                count += len(w)
                total += w.sum(axis=0)
                products += w.T @ w
        if count:
            values = np.concatenate([[float(count)], total, products.ravel()])
            yield pa.RecordBatch.from_pydict(
                {"place": pa.array(range(len(values)), pa.int64()), "value": pa.array(values)}
            )

    return run


def _identity_error(rows: DataFrame, size: int, scores: Callable[[np.ndarray], np.ndarray], k: int) -> float:
    """The largest absolute entry of the scores' covariance minus the identity, over all rows. The
    scores are of centred rows already; what is left of their mean is taken off, too."""
    parts = rows.mapInArrow(_score_sums(size, scores, k), "place long, value double")
    sums = np.zeros(1 + k + k * k)
    for row in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        sums[row["place"]] = row["value"]
    mean = sums[1 : k + 1] / sums[0]
    covariance = sums[k + 1 :].reshape(k, k) / sums[0] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, count: int, sums: list[int], middle: list[int]) -> list[int]:
    """The sum over dimensions of (n x - S)^2 of each row, exact."""
    left = [s - count * m for s, m in zip(sums, middle, strict=True)]
    y = x - np.array(middle, np.int64)
    most = count * (int(np.abs(y).max()) if y.size else 0) + max(map(abs, left))
    if most * most * x.shape[1] < 1 << 63:
        d = y * count - np.array(left, np.int64)
        return (d * d).sum(axis=1).tolist()
    return [sum((count * v - s) ** 2 for v, s in zip(row, left, strict=True)) for row in y.tolist()]


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row for each
    usable row of `embeddings` and component, repeated rows and null ids included.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are
    those whose length is not the commonest one (of several, the longest): the covariance is that of the
    rest. A component without variance cannot be whitened and is left out, so equal vectors, or
    one vector, give no rows; neither does an empty table. A deviation that is too large for a
    long is an error.
    """
    spark = embeddings.sparkSession
    schema = (
        f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, component int, n long, "
        "deviation long, whitened double, explained double, identity_error double"
    )
    rows = usable(embeddings)
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    size, count = common["size"], common["n"]
    rows = rows.filter(F.size("vector") == size)
    sums = _added(rows, size, _exact_sum, size)
    middle = [round(Fraction(s, count)) for s in sums]
    middles = np.array(middle, np.int64)
    products = _added(rows, size, lambda x: _exact_products(x - middles), size * (size + 1) // 2)
    covariance = _covariance(count, sums, middle, products)
    values, vectors = leading_pairs(spark, covariance, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    scores = _scores(count, sums, middle, vectors / np.sqrt(values))
    error = _identity_error(rows, size, scores, k)
    explained = values / np.trace(covariance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _blocks(batch, size):
                m = len(x)
                deviation = np.array(_deviations(x, count, sums, middle), np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": ids.take(pa.array(np.repeat(np.arange(m), k))),
                        "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        "n": pa.array(np.full(m * k, count), pa.int64()),
                        "deviation": pa.array(np.repeat(deviation, k)),
                        "whitened": pa.array(scores(x).ravel()),
                        "explained": pa.array(np.tile(explained, m)),
                        "identity_error": pa.array(np.full(m * k, error)),
                    }
                )

    return rows.mapInArrow(run, schema)
