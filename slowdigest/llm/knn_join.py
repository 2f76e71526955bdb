"""Exact top-k search by a Voronoi join: every query's rows of highest inner product, among all rows.

A query's own length changes no order, so rows are compared by length times the cosine of the angle between
row and query; angles obey the triangle inequality.

1. Pivots, directions of a bounded number of rows, cut the sphere into Voronoi cells.  One pass over the table
   sums up, per cell, the rows by angle to the pivot (64 bins, narrow near the pivot; number, shortest and
   longest row) and the queries with their largest angle: summaries of fixed size, all that the driver sees.
2. For each cell of queries the summaries give a score that at least k + 1 rows reach (one may be the query
   itself), and the bins whose best possible score is lower are not needed.
3. Cells that need few rows for the queries they hold are solved on their own; the others form one pool.  The
   queries of a cell or pool are dealt into sets, the rows that it needs into chunks; a row is sent once for each
   set that needs it, a query once for each chunk.  No task holds more than one set and about one chunk, whatever the
   size of a cell, so a vector that a third of the rows repeat is no longer than any other.
4. Each task solves its set against its chunk in blocks of one matrix product, and the best k of each chunk are
   ranked by query.

Scores are whole numbers: products of floors that stay below 2^53 are exact as doubles; a table with larger
ones is computed in Python's whole numbers, and scores outside the range of longs are set to its end.  Bounds
are widened by more than their rounding, so no row is lost to it.

Where vectors lie evenly in many dimensions no bound excludes anything: then every set meets every row, and what
is sent grows with sets times rows.  ``queries_per_set`` and ``rows_per_chunk`` state the memory of a task.

Defined cases: rows whose vector is null or holds a null, infinite or undefined component take no part.  Shorter
vectors are filled up with zeros.  Ids are whole numbers or null; others are refused.  A null id is no query
unless ``queries`` says so, and ranks behind other ids on ties; rows with one id are rows of their own: each is
answered apart and may be found by the other.  With fewer than k other rows all are returned.  Without queries or
rows the result is empty.  Columns other than id and vector are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowdigest.llm.common import batches, staged
from slowdigest.llm.vectors import floored, matrix, named, usable

SCALE = 64
TOP = 20
#: At most so many pivots, and so many components of all pivots together.
PIVOTS = 1024
PIVOT_CELLS = 1 << 22
BINS = 64
QUERIES_PER_SET = 8192
ROWS_PER_CHUNK = 16384
#: Scores computed at once.
_BLOCK = 1 << 22
_POOL = -1

OUT = "query_row long, query_id long, vec_id long, score long, row long"


@dataclass(frozen=True)
class Space:
    """What every task knows: unit pivots, the length of the longest row, the type that holds components."""

    pivots: np.ndarray
    longest: float
    kind: str

    @property
    def width(self) -> int:
        return self.pivots.shape[1]

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, angle to its pivot and length of each row; rows of length 0 have angle 0 to any."""
        x = x.astype(np.float64)
        length = np.sqrt((x * x).sum(1))
        product = x @ self.pivots.T
        cell = product.argmax(1)
        unit = np.divide(product[np.arange(len(x)), cell], length, out=np.ones(len(x)), where=length > 0)
        return cell, np.arccos(np.clip(unit, -1.0, 1.0)), length


#: Upper ends of the bins of angles; narrow ones first.
EDGES = np.pi * (np.arange(1, BINS + 1) / BINS) ** 2


def _bins(angle: np.ndarray) -> np.ndarray:
    return np.minimum(np.searchsorted(EDGES, angle), BINS - 1)


@dataclass(frozen=True)
class Summaries:
    """Per cell and bin: rows, shortest and longest; per cell: queries and their largest angle."""

    count: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray
    queries: np.ndarray
    angle: np.ndarray


@dataclass(frozen=True)
class Plan:
    """Per class (a cell of queries, or the pool): first and last needed bin of each cell, and its division."""

    of_cell: np.ndarray
    first: dict[int, np.ndarray]
    last: dict[int, np.ndarray]
    sets: dict[int, int]
    chunks: dict[int, int]
    needed: dict[int, int]


def _space(rows: DataFrame, pivots: int) -> Space | None:
    """Pivots by a hash of the row, at most ``pivots``; None for an empty table."""
    found = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("x")).alias("width"),
        F.max(F.expr("aggregate(x, 0D, (s, c) -> s + cast(c as double) * c)")).alias("square"),
        F.max(F.expr("aggregate(x, 0L, (m, c) -> greatest(m, abs(c)))")).alias("largest"),
    ).first()
    if not found["n"]:
        return None
    n, width, largest = found["n"], found["width"], found["largest"]
    wanted = max(1, min(pivots, PIVOT_CELLS // (width + 1), int(np.ceil(n**0.5 / 2))))
    chosen = rows.orderBy(F.xxhash64("row"), "row").limit(wanted).select("x").toArrow()
    x = np.unique(matrix(chosen["x"].combine_chunks(), width).astype(np.float64), axis=0)
    length = np.sqrt((x * x).sum(1, keepdims=True))
    x = (x / np.maximum(length, 1.0))[length[:, 0] > 0]
    exact = max(width, 1) * largest * largest < 1 << 53
    kind = "O" if not exact else next(k for k, top in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 62)) if largest < top)
    return Space(x if len(x) else np.eye(1, width), float(np.sqrt(found["square"])), kind)


def _summaries(rows: DataFrame, space: Space) -> Summaries:
    cells, width = len(space.pivots), space.width

    def local(parts):
        count = np.zeros(cells * BINS, dtype=np.int64)
        shortest, longest = np.full(cells * BINS, np.inf), np.zeros(cells * BINS)
        queries, far = np.zeros(cells, dtype=np.int64), np.zeros(cells)
        for batch in parts:
            cell, angle, length = space.split(matrix(batch.column("x"), width))
            at = cell * BINS + _bins(angle)
            count += np.bincount(at, minlength=cells * BINS)
            np.minimum.at(shortest, at, length)
            np.maximum.at(longest, at, length)
            asks = batch.column("query").to_numpy(zero_copy_only=False)
            queries += np.bincount(cell[asks], minlength=cells)
            # A query of length 0 scores 0 everywhere: no angle bounds it.
            np.maximum.at(far, cell[asks], np.where(length[asks] > 0, angle[asks], np.pi))
        at, asked = np.flatnonzero(count), np.flatnonzero(queries)
        yield from batches({
            "cell": pa.array(np.append(at // BINS, asked).astype(np.int32)),
            "bin": pa.array(np.append(at % BINS, np.full(len(asked), -1)).astype(np.int32)),
            "n": pa.array(np.append(count[at], queries[asked])),
            "low": pa.array(np.append(shortest[at], far[asked])),
            "high": pa.array(np.append(longest[at], far[asked])),
        })

    sums = rows.mapInArrow(local, "cell int, bin int, n long, low double, high double").groupBy("cell", "bin").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    out = Summaries(
        np.zeros((cells, BINS), np.int64), np.zeros((cells, BINS)), np.zeros((cells, BINS)),
        np.zeros(cells, np.int64), np.zeros(cells),
    )
    for r in sums.toArrow().to_pylist():
        if r["bin"] < 0:
            out.queries[r["cell"]], out.angle[r["cell"]] = r["n"], r["high"]
        else:
            at = r["cell"], r["bin"]
            out.count[at], out.shortest[at], out.longest[at] = r["n"], r["low"], r["high"]
    return out


def _times(length_up: np.ndarray, length_down: np.ndarray, angle: np.ndarray) -> np.ndarray:
    """Length times cosine, with one length where the cosine is positive and another where it is not."""
    cosine = np.cos(angle)
    return np.where(cosine > 0, length_up, length_down) * cosine


def plan_sets(space: Space, found: Summaries, k: int, per_set: int, per_chunk: int) -> Plan:
    """Bounds from the summaries, and how cells are solved."""
    n = int(found.count.sum())
    filled = found.count > 0
    # The arc cosine of a rounded product is off by up to the root of its rounding.
    low_edge = np.append(0.0, EDGES[:-1]) - 1e-6
    high_edge = EDGES + 1e-6
    asked = np.flatnonzero(found.queries)
    need, alone = {}, []
    for i in asked:
        apart = np.arccos(np.clip(space.pivots @ space.pivots[i], -1.0, 1.0))[:, None]
        own = found.angle[i] + 1e-6
        nearest = np.clip(apart - own - high_edge, 0.0, np.pi)
        farthest = np.clip(apart + own + high_edge, 0.0, np.pi)
        nearest = np.maximum(nearest, low_edge - own - apart)
        best = _times(found.longest, found.shortest, nearest)
        worst = _times(found.shortest, found.longest, farthest)
        order = np.argsort(-worst[filled], kind="stable")
        enough = np.searchsorted(np.cumsum(found.count[filled][order]), k + 1)
        reached = worst[filled][order[enough]] if enough < len(order) else -np.inf
        need[i] = filled & ~(best < reached - 1e-6 * space.longest)
        if int(found.count[need[i]].sum()) * per_set < n * found.queries[i]:
            alone.append(int(i))
    of_cell = np.full(len(space.pivots), _POOL)
    of_cell[alone] = alone
    pool = [int(i) for i in asked if of_cell[i] == _POOL]
    wanted = {c: need[c] for c in alone}
    holds = {c: int(found.queries[c]) for c in alone}
    if pool:
        wanted[_POOL] = np.any([need[i] for i in pool], axis=0)
        holds[_POOL] = int(found.queries[pool].sum())
    first = {c: np.where(w.any(1), w.argmax(1), BINS).astype(np.int16) for c, w in wanted.items()}
    last = {c: np.where(w.any(1), BINS - 1 - w[:, ::-1].argmax(1), -1).astype(np.int16) for c, w in wanted.items()}
    at = np.arange(BINS)
    needed = {c: int(found.count[(at >= first[c][:, None]) & (at <= last[c][:, None])].sum()) for c in wanted}
    sets = {c: -(-holds[c] // per_set) for c in wanted}
    chunks = {c: max(1, -(-needed[c] // per_chunk)) for c in wanted}
    return Plan(of_cell, first, last, sets, chunks, needed)


def _spread(rows: DataFrame, space: Space, plan: Plan) -> DataFrame:
    """Blocks of queries and of needed rows for each (class, set, chunk)."""
    width = space.width
    schema = "cell int, part int, chunk int, asks boolean, n int, row binary, id binary, no_id binary, x binary"
    names = ("cell", "part", "chunk", "asks", "n", "row", "id", "no_id", "x")
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), *[pa.binary()] * 4)

    def packed(row, ids, none, x):
        if space.kind == "O":
            x = x.astype("<i8")
        return len(row), row.astype("<i8").tobytes(), ids.astype("<i8").tobytes(), none.tobytes(), x.astype(
            space.kind if space.kind != "O" else "<i8"
        ).tobytes()

    def mixed(row: np.ndarray, salt: int) -> np.ndarray:
        x = (row.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)

    def blocks(row, ids, none, x, asks):
        cell, angle, _ = space.split(x)
        at_bin = _bins(angle)
        for c in plan.first:
            take = np.flatnonzero((at_bin >= plan.first[c][cell]) & (at_bin <= plan.last[c][cell]))
            chunk = mixed(row[take], 7) % np.uint64(plan.chunks[c])
            for at in np.unique(chunk):
                own = take[chunk == at]
                block = packed(row[own], ids[own], none[own], x[own])
                for part in range(plan.sets[c]):
                    yield c, part, int(at), False, *block
        asking = np.flatnonzero(asks)
        own_class = plan.of_cell[cell[asking]]
        for c in np.unique(own_class):
            of_class = asking[own_class == c]
            part = mixed(row[of_class], 3) % np.uint64(plan.sets[c])
            for at in np.unique(part):
                own = of_class[part == at]
                block = packed(row[own], ids[own], none[own], x[own])
                for chunk in range(plan.chunks[c]):
                    yield int(c), int(at), chunk, True, *block

    def flushed(held):
        columns = [np.concatenate(c) for c in zip(*held)]
        out, size = [], 0
        for made in blocks(*columns):
            out.append(made)
            size += len(made[-1])
            if size >= 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names)

    def local(parts):
        held, size = [], 0
        for batch in parts:
            ids = batch.column("id")
            held.append((
                batch.column("row").to_numpy(),
                ids.fill_null(0).to_numpy(zero_copy_only=False),
                ids.is_null().to_numpy(zero_copy_only=False),
                matrix(batch.column("x"), width),
                batch.column("query").to_numpy(zero_copy_only=False),
            ))
            size += len(ids)
            if size >= ROWS_PER_CHUNK:
                yield from flushed(held)
                held, size = [], 0
        if held:
            yield from flushed(held)

    return rows.mapInArrow(local, schema)


def _opened(table: pa.Table, kind: str, width: int):
    """Row numbers, ids, missing ids and vectors of packed blocks, by id and row number, null ids last."""
    stored = "<i8" if kind == "O" else kind
    columns = [b"".join(table[c].to_pylist()) for c in ("row", "id", "no_id", "x")]
    row, ids = (np.frombuffer(c, dtype="<i8") for c in columns[:2])
    none = np.frombuffer(columns[2], dtype=bool)
    x = np.frombuffer(columns[3], dtype=stored).reshape(len(row), width)
    order = np.lexsort((row, ids, none))
    return row[order], ids[order], none[order], x[order]


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores of each row, earlier columns first on ties."""
    n = scores.shape[1]
    k = min(k, n)
    if scores.dtype != object and n and np.abs(scores).max(initial=0) < (1 << 62) // n:
        keys = scores.astype(np.int64) * n + np.arange(n - 1, -1, -1)
        top = np.argpartition(keys, n - k, axis=1)[:, n - k :] if k < n else np.broadcast_to(np.arange(n), keys.shape)
        order = np.argsort(-np.take_along_axis(keys, top, 1), axis=1)
        return np.take_along_axis(top, order, 1)
    return np.array([sorted(range(n), key=lambda j, s=s: (-int(s[j]), j))[:k] for s in scores]).reshape(len(scores), k)


def solve(queries: pa.Table, rows: pa.Table, kind: str, width: int, k: int) -> pa.Table:
    """The best k rows of one chunk for each query of one set, the query's own row left out."""
    ask, ask_id, ask_none, q = _opened(queries, kind, width)
    row, ids, none, x = _opened(rows, kind, width)
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    exact = kind == "O"
    x = x.astype(object) if exact else x.astype(np.float64)
    by_row = np.argsort(row)
    step = max(1, _BLOCK // max(1, len(row)))
    for at in range(0, len(ask) if len(row) else 0, step):
        part = q[at : at + step]
        scores = part.astype(object) @ x.T if exact else part.astype(np.float64) @ x.T
        # One more than k, so that leaving out the own row still leaves k.
        top = _best(scores, k + 1)
        place = by_row[np.minimum(np.searchsorted(row, ask[at : at + step], sorter=by_row), len(row) - 1)]
        own = np.where(row[place] == ask[at : at + step], place, -1)
        keep = top != own[:, None]
        keep &= np.cumsum(keep, axis=1) <= k
        i, j = np.nonzero(keep)
        found = top[i, j]
        got = scores[i, found]
        if exact:
            got = np.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in got], dtype=np.int64)
        for column, values in zip(out, (ask[at + i], ask_id[at + i], ask_none[at + i], found, got)):
            column.append(values)
    ask, ask_id, ask_none, found, got = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out[:5])
    found = found.astype(np.int64)
    return pa.table({
        "query_row": pa.array(ask.astype(np.int64)),
        "query_id": pa.array(ask_id.astype(np.int64), mask=ask_none.astype(bool)),
        "vec_id": pa.array(ids[found].astype(np.int64), mask=none[found].astype(bool)),
        "score": pa.array(got.astype(np.int64)),
        "row": pa.array(row[found].astype(np.int64)),
    })


def top_k(
    data: DataFrame, queries: Column, *, k: int = TOP, row_id: str = "vec_id", vector: str = "embedding",
    scale: int = SCALE, pivots: int = PIVOTS, queries_per_set: int = QUERIES_PER_SET,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest score for each row that meets ``queries``."""
    if not isinstance(data.schema[row_id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{row_id} must hold whole numbers")
    rows = staged(
        data.filter(usable(named(vector))).select(
            F.monotonically_increasing_id().alias("row"),
            named(row_id).cast("long").alias("id"),
            F.coalesce(queries, F.lit(False)).alias("query"),
            floored(named(vector), scale).alias("x"),
        )
    )
    space = _space(rows, pivots)
    if space is None:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    plan = plan_sets(space, _summaries(rows, space), k, queries_per_set, rows_per_chunk)
    kind, width = space.kind, space.width

    def local(blocks: pa.Table) -> pa.Table:
        asks = blocks["asks"].to_numpy()
        where = np.flatnonzero
        return solve(blocks.take(pa.array(where(asks))), blocks.take(pa.array(where(~asks))), kind, width, k)

    found = _spread(rows, space, plan).groupBy("cell", "part", "chunk").applyInArrow(local, OUT)
    place = W.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
