"""Whitening of embeddings by an exact covariance.

The covariance is recovered by polarisation: for every dimension, and for the sum of every two dimensions, the
squared centred values are added up in whole numbers; the variance of a sum less the variances of its parts is
twice their covariance.  Values are centred twice: by the whole part of the mean before they are squared, which
keeps the squares small, and by its remainder, as a fraction of n, in the sums.  No step rounds before the
quotient that becomes a double, so an offset much larger than the spread costs no digit.

Every task adds up its rows and hands on one number a pair; Spark adds these, and the driver gets
d * (d + 1) / 2 sums for vectors of d components, whatever the number of rows, solves one symmetric
eigenproblem of d x d and sends its first components back.  Three passes over the table, none of which
shuffles a vector.

Defined cases: rows whose vector is null or holds a null, infinite or undefined entry take no part and are not
returned.  Shorter vectors are filled up with zeros to the longest.  Repeated rows count each.  Directions
without spread (constant dimensions, fewer rows than dimensions) have no whitened value and are left out, so a
table of one row, or of equal rows, returns each row with an empty list.  An empty table returns no row.  Ids
of any type, null ids and very long vectors need no special care; d x d doubles must fit the driver.  Columns
called like the added ones are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowdigest.llm.common import batches
from slowdigest.llm.vectors import floored, matrix, named, usable

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32

_LIMB = 40
_LIMBS = 4
_STEP = 8192
#: Sums of two such values squared, added over ``_STEP`` rows, fit a long.
_SMALL = 1 << 23


@dataclass(frozen=True)
class Whitening:
    """Exact moments and the components by falling eigenvalue."""

    n: int
    #: Whole part of the mean per dimension, and what is left of it times n.
    base: np.ndarray
    rest: list[int]
    #: Unit eigenvectors as columns, and their eigenvalues.
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def _limbs(total: int) -> list[int]:
    """A whole number in parts that Spark may add up one by one."""
    low = [(total >> (_LIMB * k)) & ((1 << _LIMB) - 1) for k in range(_LIMBS - 1)]
    return [*low, total >> (_LIMB * (_LIMBS - 1))]


def _summed(df: DataFrame, function) -> dict[tuple[int, int], int]:
    """``function`` yields ((a, b), whole number) pairs per task; their exact sums over all tasks."""

    def local(parts):
        keys, limbs = [], []
        for key, total in function(parts):
            keys.append(key)
            limbs.append(_limbs(int(total)))
        if keys:
            columns = {"a": [k[0] for k in keys], "b": [k[1] for k in keys]}
            columns |= {f"l{k}": [x[k] for x in limbs] for k in range(_LIMBS)}
            kinds = {"a": pa.int32(), "b": pa.int32()}
            yield from batches({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in columns.items()})

    names = [f"l{k}" for k in range(_LIMBS)]
    found = df.mapInArrow(local, "a int, b int, " + ", ".join(f"{c} long" for c in names))
    sums = found.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in names)).toArrow().to_pylist()
    return {(r["a"], r["b"]): sum(r[c] << (_LIMB * k) for k, c in enumerate(names)) for r in sums}


def _column_sums(rows: np.ndarray) -> list[int]:
    high, low = rows >> 31, rows & ((1 << 31) - 1)
    return [(int(h) << 31) + int(x) for h, x in zip(high.sum(0), low.sum(0))]


def _sums(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int]]:
    """Rows under (-1, 0), the longest vector under (-1, its length), sums of components under (dimension, 0)."""
    n, sums = 0, []
    for batch in parts:
        column = batch.column(0)
        n += len(column)
        lengths = np.diff(column.offsets.to_numpy())
        width = int(lengths.max(initial=0))
        sums += [0] * (width - len(sums))
        for j, s in enumerate(_column_sums(matrix(column, width))):
            sums[j] += s
    yield (-1, 0), n
    yield from (((j, 0), s) for j, s in enumerate(sums))


def _squares(rows: np.ndarray, own: np.ndarray, pairs: list[np.ndarray]) -> None:
    """Add the squares of every component and of every sum of two to exact totals."""
    by_dimension = np.ascontiguousarray(rows.T)
    exact = rows.dtype == object
    own += (by_dimension * by_dimension).sum(1)
    for i, total in enumerate(pairs):
        both = by_dimension[i + 1 :] + by_dimension[i]
        total += (both * both).sum(1) if exact else np.einsum("ij,ij->i", both, both)


def fit(df: DataFrame, vector: str = "embedding", *, scale: int = SCALE, offset: int = OFFSET,
        components: int = COMPONENTS) -> Whitening | None:
    """Moments and components of all usable vectors; None without any."""
    rows = df.filter(usable(named(vector))).select(floored(named(vector), scale).alias("x"))
    sums = _summed(rows, _sums)
    n = sums.pop((-1, 0), 0)
    if not n:
        return None
    width = len(sums)
    totals = [sums[j, 0] + n * offset for j in range(width)]
    base = [t // n for t in totals]
    rest = [t - n * b for t, b in zip(totals, base)]
    shift = np.array([b - offset for b in base], dtype=np.int64)

    def squares(parts):
        own = np.zeros(width, dtype=object)
        pairs = [np.zeros(width - i - 1, dtype=object) for i in range(width)]
        for batch in parts:
            values = matrix(batch.column(0), width) - shift
            small = (np.abs(values) < _SMALL).all(1) if width else np.ones(len(values), bool)
            calm = values[small]
            for at in range(0, len(calm), _STEP):
                _squares(calm[at : at + _STEP], own, pairs)
            if not small.all():
                _squares(values[~small].astype(object), own, pairs)
        yield from (((i, i), s) for i, s in enumerate(own))
        yield from (((i, i + 1 + j), s) for i, total in enumerate(pairs) for j, s in enumerate(total))

    found = _summed(rows, squares)
    # n * n times the variance of a dimension, or of the sum of two.
    spread = {(i, j): n * s - (rest[i] + (rest[j] if i != j else 0)) ** 2 for (i, j), s in found.items()}
    covariance = np.zeros((width, width))
    for (i, j), s in spread.items():
        covariance[i, j] = covariance[j, i] = (
            s / (n * n) if i == j else (s - spread[i, i] - spread[j, j]) / (2 * n * n)
        )
    trace = sum(spread[i, i] for i in range(width)) / (n * n) if width else 0.0
    values, vectors = np.linalg.eigh(covariance) if width else (np.zeros(0), np.zeros((0, 0)))
    values, vectors = values[::-1], vectors[:, ::-1]
    wanted = np.flatnonzero(values > max(trace, 0.0) * max(width, 1) * 1e-14)[:components]
    vectors = vectors[:, wanted]
    if len(wanted):
        largest = np.abs(vectors).argmax(0)
        vectors = vectors * np.where(vectors[largest, np.arange(len(wanted))] < 0, -1.0, 1.0)
    return Whitening(n, shift, rest, vectors, values[wanted], trace)


def _centred(rows: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers less the whole part of the mean, and the same less the whole mean as doubles."""
    whole = rows - model.base
    return whole, whole - np.array([r / model.n for r in model.rest])


def _projected(rows: np.ndarray, model: Whitening) -> np.ndarray:
    return (_centred(rows, model)[1] @ model.vectors) / np.sqrt(model.values)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding", *, scale: int = SCALE) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over all rows."""
    rows = df.filter(usable(named(vector))).select(floored(named(vector), scale).alias("x"))
    width, k = len(model.base), len(model.values)
    if not k:
        return 0.0

    def moments(parts):
        total = np.zeros((k + 1, k))
        for batch in parts:
            w = _projected(matrix(batch.column(0), width), model)
            total[0] += w.sum(0)
            total[1:] += w.T @ w
        at = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield from batches({"a": pa.array(at[0]), "b": pa.array(at[1]), "s": pa.array(total.ravel())})

    found = rows.mapInArrow(moments, "a int, b int, s double").groupBy("a", "b").agg(F.sum("s").alias("s")).toArrow()
    total = np.zeros((k + 1, k))
    total[found["a"].to_numpy(), found["b"].to_numpy()] = found["s"].to_numpy()
    total /= model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def _deviations(whole: np.ndarray, model: Whitening) -> list[Decimal | None]:
    """Sum over dimensions of (n * x - sum) squared, exact; null beyond 38 digits."""
    n, width = model.n, whole.shape[1]
    largest = n * (int(np.abs(whole).max(initial=0)) + 1)
    kind = np.int64 if max(width, 1) * largest * largest < 1 << 63 else object
    apart = whole.astype(kind) * n - np.array(model.rest, dtype=kind)
    return [Decimal(int(s)) if int(s) < 10**38 else None for s in (apart * apart).sum(1)]


def whiten(df: DataFrame, model: Whitening | None, vector: str = "embedding", *, scale: int = SCALE) -> DataFrame:
    """``df``'s usable rows with ``whitened`` (one double a component) and ``deviation``, an exact decimal."""
    added = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.DecimalType(38, 0))]
    taken = {f.name for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*kept, *added])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    # Columns pass the tasks under numbers, since names may hold dots.
    numbered = [T.StructField(f"c{n}", f.dataType) for n, f in enumerate(kept)]
    rows = df.filter(usable(named(vector))).select(
        *(named(f.name).alias(c.name) for f, c in zip(kept, numbered)), floored(named(vector), scale).alias("x")
    )
    width, k = len(model.base), len(model.values)

    def out(parts):
        for batch in parts:
            values = matrix(batch.column("x"), width)
            flat = pa.array(_projected(values, model).ravel())
            ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * k)
            columns = {c.name: batch.column(c.name) for c in numbered}
            columns["whitened"] = pa.ListArray.from_arrays(ends, flat)
            columns["deviation"] = pa.array(_deviations(values - model.base, model), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(out, T.StructType([*numbered, *added])).toDF(*schema.names)
