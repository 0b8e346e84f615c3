"""Whitening of embeddings, with a covariance that is exact: it comes from whole numbers only."""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectors import matrix

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components that are returned.
MOST_COMPONENTS = 32
#: Entries from this size on have no whole number of 64 bits, and are taken for infinite.
_TOO_LARGE = 2.0**56
_ROWS_AT_ONCE = 1024
_PART = 10**18


def usable(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is not null and has no null, non-finite or too large entry."""
    good = F.forall(F.col(f"`{vector}`").cast("array<double>"), lambda c: c.isNotNull() & (F.abs(c) < _TOO_LARGE))
    return df.filter(F.coalesce(good, F.lit(False)))


def _whole(batches: Iterator[pa.RecordBatch], width: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some rows at a time, with floor(SCALE * c) of their last column; shorter vectors end in zeros."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
            part = batch.slice(start, _ROWS_AT_ONCE)
            column = part.column(part.num_columns - 1)
            longest = max(map(len, column)) if width is None else width
            numbers = matrix(column, longest) if longest else np.zeros((part.num_rows, 0))
            yield part, np.floor(SCALE * numbers).astype(np.int64)


def _fits(x: np.ndarray, bound: int) -> np.ndarray:
    """``x``, as Python's whole numbers of any size if ``bound``, the size of what is made of it, passes 64 bits."""
    return x if bound < 2**62 else x.astype(object)


def _most(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def _exact_sums(rows: DataFrame, sums_of, *args) -> dict[int, int]:
    """By place, the sum over all tasks of ``sums_of(batches, *args)``, which gives an array for the whole task.

    A sum leaves its task in two decimals, of 18 digits and of the digits before, so none can overflow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [int(s) for s in sums_of(batches, *args)]
        columns = [pa.array(np.arange(len(found)), pa.int64())]
        columns += [pa.array([Decimal(f(s)) for s in found], pa.decimal128(38, 0)) for f in (lambda s: s // _PART, lambda s: s % _PART)]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "high", "low"])

    sums = rows.mapInArrow(run, "place long, high decimal(38,0), low decimal(38,0)")
    total = sums.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {r.place: int(r.high) * _PART + int(r.low) for r in total.collect()}


def _count_and_sums(batches: Iterator[pa.RecordBatch]) -> list[int]:
    """The number of rows, then the sum of every dimension."""
    n, sums = 0, np.zeros(0, dtype=object)
    for _, x in _whole(batches):
        n += len(x)
        if x.shape[1] > len(sums):
            sums = np.concatenate([sums, np.zeros(x.shape[1] - len(sums), dtype=object)])
        sums[: x.shape[1]] += _fits(x, _most(x) * len(x)).sum(axis=0).astype(object)
    return [n, *sums]


def _squares(batches: Iterator[pa.RecordBatch], middle: list[int]) -> np.ndarray:
    """Of the centred whole numbers, the sums of squares of each dimension, then of the sums of two dimensions,
    (0, 1), (0, 2), ..., (1, 2), ..."""
    width = len(middle)
    sums = np.zeros(width * (width + 1) // 2, dtype=object)
    for _, x in _whole(batches, width):
        most = _most(x) + max(map(abs, middle), default=0)
        x = _fits(x, most) - np.array(middle, dtype=np.int64)
        x = _fits(x, (2 * most) ** 2 * len(x))
        sums[:width] += (x * x).sum(axis=0).astype(object)
        at = width
        for i in range(width - 1):
            both = x[:, i, None] + x[:, i + 1 :]
            sums[at : at + width - 1 - i] += (both * both).sum(axis=0).astype(object)
            at += width - 1 - i
    return sums


@dataclass
class Whitening:
    """A fitted whitening: ``sums`` and ``n`` of the x of the fit list, its components in columns, by falling
    eigenvalue, their eigenvalues and shares of the trace. ``spread`` tells the components that have any to double
    precision; of the others no whitened value exists."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    spread: np.ndarray
    identity_error: float | None = None

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """n * x - S, exactly; ``whole`` is x - SHIFT."""
        low = [s - self.n * SHIFT for s in self.sums]
        bound = self.n * _most(whole) + max(map(abs, low), default=0)
        return _fits(whole, bound) * self.n - np.array(low, dtype=np.int64 if bound < 2**62 else object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """The centred rows on the components, over the roots of the eigenvalues; NaN where there is no spread."""
        roots = np.where(self.spread, np.sqrt(np.where(self.spread, self.eigenvalues, 1.0)), np.nan)
        return (centred / self.n).astype(np.float64) @ self.components / roots


def covariance(n: int, sums: list[int], squares: list[int]) -> np.ndarray:
    """The covariance with divisor ``n``, each entry rounded once, from sums and sums of squares of whole numbers.

    By polarisation: twice the covariance of two dimensions is the variance of their sum less their own variances.
    ``squares`` are of numbers from which a whole number near the mean has been taken, ``sums`` are of these numbers,
    so n * n * squares - n * sums * sums is the sum of the squares of n * x - S.
    """
    width = len(sums)
    own = [n * n * q - n * s * s for q, s in zip(squares, sums)]
    out = np.diag([v / n**3 for v in own]) if width else np.zeros((0, 0))
    at = width
    for i in range(width):
        for j in range(i + 1, width):
            both = n * n * squares[at] - n * (sums[i] + sums[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**3)
            at += 1
    return out


def fit(df: DataFrame, vector: str = "embedding", most: int = MOST_COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors of ``df``; None if there is none, or none has an entry.

    Reads the vectors three times: for the sums, for the squares around the means, and for the covariance of the
    whitened rows, by which ``identity_error`` is measured. A task hands on one number for each dimension or pair of
    dimensions; the driver gets their totals, whose number depends on the vectors' width alone.
    """
    rows = usable(df, vector).select(F.col(f"`{vector}`").cast("array<double>").alias("v"))
    totals = _exact_sums(rows, _count_and_sums)
    n, width = totals.get(0, 0), len(totals) - 1
    if n == 0 or width == 0:
        return None
    sums = [totals[i + 1] for i in range(width)]
    middle = [s // n for s in sums]
    squares = _exact_sums(rows, _squares, middle)
    v = covariance(n, [s - n * m for s, m in zip(sums, middle)], [squares[i] for i in range(len(squares))])
    values, components = np.linalg.eigh(v)
    values, components = np.maximum(values[::-1][:most], 0.0), components[:, ::-1][:, :most]
    trace = float(np.trace(v))
    model = Whitening(
        n,
        [s + n * SHIFT for s in sums],
        components,
        values,
        values / trace if trace > 0 else np.full(len(values), np.nan),
        values > width * np.finfo(np.float64).eps * max(values.max(), 0.0),
    )
    model.identity_error = _identity_error(rows, model)
    return model


def _identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened rows' covariance, summed up over all rows, less the identity."""
    kept = np.flatnonzero(model.spread)
    if not len(kept):
        return None
    a, b = np.triu_indices(len(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((len(kept), len(kept))), np.zeros(len(kept))
        for _, x in _whole(batches, len(model.sums)):
            w = model.whitened(model.centred(x))[:, kept]
            products += w.T @ w
            sums += w.sum(axis=0)
        values = pa.array(np.concatenate([products[a, b], sums]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), values], names=["place", "value"])

    total = {r.place: r.value for r in rows.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()}
    mean = np.array([total[len(a) + i] for i in range(len(kept))]) / model.n
    products = np.array([total[i] for i in range(len(a))]) / model.n
    return float(np.abs(products - mean[a] * mean[b] - (a == b)).max())


def whiten(df: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For every usable vector and component: the key, component (from 1), n, deviation decimal(38,0) (the sum over
    dimensions of (n*x - S)^2), whitened, explained, identity_error.

    Rows whose vector is null, or has a null, non-finite or too large entry (2**56 or more), are left out. Rows with
    a null key stay, repeated rows count and come out each. Vectors shorter than the longest end in zeros, and so
    count as having these entries. No rows, or only empty vectors, give no rows. A component without spread has a
    null for whitened; where no vector differs from another, explained and identity_error are null as well. A
    deviation of more than 38 digits is null. Other columns are not looked at. Nothing is shuffled.
    """
    kinds = [df.schema[key].dataType, T.IntegerType(), T.LongType(), T.DecimalType(38, 0), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    names = ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = T.StructType([T.StructField(name, kind) for name, kind in zip(names, kinds)])
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        for part, x in _whole(batches, len(model.sums)):
            centred, rows = model.centred(x), len(x)
            exact = (squared := _fits(centred, _most(centred) ** 2 * centred.shape[1])) * squared
            deviation = [Decimal(s) if s < 10**38 else None for s in map(int, exact.sum(axis=1))]
            keys = pa.array(np.repeat(np.arange(rows), k))
            whitened, explained = (pa.array(a.ravel(), from_pandas=True) for a in (model.whitened(centred), np.tile(model.explained, (rows, 1))))
            columns = [
                part.column(0).take(keys),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n)),
                pa.array(deviation, pa.decimal128(38, 0)).take(keys),
                whitened,
                explained,
                pa.array([model.identity_error] * (rows * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = usable(df, vector).select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
