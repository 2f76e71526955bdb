"""Sharding by histogram sort: shards of nearly equal bytes, ordered by a hash of the text.

Rows are ordered by (hash of the text, id), so equal texts lie together, and a group too large for one
shard is cut by id. Splitters are found by counting: every round cuts each interval that still holds a
splitter into even parts, counts the exact bytes below all cut points over all partitions, and keeps the
part around each target, until every splitter is within the tolerance or at a single key. Then the rows
are exchanged once.

Column functions only. Rounds read one staged narrow table; the driver receives at most
``parts`` sums per open splitter. Slots are numbered inside cells of a shard (by hash of the
id) behind the exact sizes of the cells before, so no shard is gathered in one task.

Defined cases: a null text counts as empty (size 16); a null id ranks first. Rows equal in id and text
cannot be told apart and share a shard; their slots differ. An empty table has no rows. Input
columns stay; one that has the name of a result column is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slowdigest.llm.common import fresh, quoted, staged, whole_text

SHARDS = 40
PARTS = 256
TOLERANCE = 0.001
CELL_ROWS = 1_000_000
_ID_LOW = -(1 << 63)


def _at_least(h: Column, i: Column, key: tuple[int, int]) -> Column:
    return (h > key[0]) | ((h == key[0]) & (i >= key[1]))


class _Interval:
    """Keys between ``low`` (included) and ``high``; ``below`` bytes lie under ``low``."""

    def __init__(self, low: tuple[int, int], high: tuple[int, int], below: int, size: int):
        self.low, self.high, self.below, self.size = low, high, below, size

    def probes(self, parts: int) -> list[tuple[int, int]]:
        """Cut points strictly inside, evenly spaced in the hash, or in the id where the hash is one."""
        (h0, i0), (h1, i1) = self.low, self.high
        if h1 - h0 > 1:
            step = max(1, (h1 - h0) // parts)
            return [(h, _ID_LOW) for h in range(h0 + step, h1, step)] + [(h1, _ID_LOW)] * (i1 > _ID_LOW)
        if h1 > h0 and i1 > _ID_LOW:
            return [(h1, _ID_LOW)]
        top = i1 if h1 == h0 else 1 << 63
        step = max(1, (top - i0) // parts)
        return list(range_keys(h0, i0, top, step))


def range_keys(h: int, low: int, high: int, step: int):
    return ((h, i) for i in range(low + step, high, step))


def splitters(
    narrow: DataFrame, shards: int = SHARDS, parts: int = PARTS, tolerance: float = TOLERANCE
) -> list[tuple[int, int]]:
    """The ``shards - 1`` keys (hash, id) at which the next shard begins, for rows (h, i, size)."""
    first = narrow.agg(
        F.sum("size").alias("total"), F.min("h"), F.max("h"), F.min("i"), F.max("i")
    ).first()
    total = first["total"] or 0
    if not total:
        return [(0, 0)] * (shards - 1)
    slack = tolerance * total / shards
    start = _Interval((first[1], first[3]), (first[2], first[4] + 1), 0, total)
    around = {k: start for k in range(1, shards)}
    found: dict[int, tuple[int, int]] = {}
    while around:
        open_ones = list({id(x): x for x in around.values()}.values())
        cuts = {id(x): x.probes(parts) for x in open_ones}
        number, low, below = F.lit(None).cast("int"), [], []
        h, i = F.col("h"), F.col("i")
        for n, x in reversed(list(enumerate(open_ones))):
            inside = _at_least(h, i, x.low) & ~_at_least(h, i, x.high)
            number = F.when(inside, F.lit(n)).otherwise(number)
        cell = reduce(
            lambda rest, x: F.when(F.col("n") == x[0], _cell(cuts[id(x[1])], x[1])).otherwise(rest),
            enumerate(open_ones),
            F.lit(0).cast("long"),
        )
        counted = (
            narrow.withColumn("n", number)
            .filter("n is not null")
            .groupBy("n", cell.alias("cell"))
            .agg(F.sum("size").alias("size"))
            .collect()
        )
        sums: dict[tuple[int, int], int] = {(r["n"], r["cell"]): r["size"] for r in counted}
        at = {id(x): n for n, x in enumerate(open_ones)}
        spans: dict[tuple[int, int], _Interval] = {}
        following: dict[int, _Interval] = {}
        for k, x in around.items():
            keys = [x.low, *cuts[id(x)], x.high]
            low, goal, c = x.below, total * k / shards, 0
            while c < len(keys) - 2 and low + sums.get((at[id(x)], c), 0) < goal:
                low += sums.get((at[id(x)], c), 0)
                c += 1
            size = sums.get((at[id(x)], c), 0)
            if goal - low <= slack:
                found[k] = keys[c]
            elif low + size - goal <= slack:
                found[k] = keys[c + 1]
            elif len(keys) == 2:
                found[k] = keys[0] if goal - low <= low + size - goal else keys[1]
            else:
                following[k] = spans.setdefault((at[id(x)], c), _Interval(keys[c], keys[c + 1], low, size))
        around = following
    return [found[k] for k in range(1, shards)]


def _cell(cuts: list[tuple[int, int]], x: _Interval) -> Column:
    """The number of cut points at or below a key of the interval."""
    if not cuts:
        return F.lit(0).cast("long")
    h, i = F.col("h"), F.col("i")
    if cuts[0][1] != _ID_LOW or cuts[0][0] == x.low[0]:
        step = cuts[0][1] - x.low[1]
        past = (i.cast("decimal(20,0)") - F.lit(x.low[1]).cast("decimal(20,0)")) / F.lit(step)
        return F.least(F.floor(past).cast("long"), F.lit(len(cuts)).cast("long"))
    step = cuts[0][0] - x.low[0]
    even = sum(1 for n, c in enumerate(cuts) if c[0] == x.low[0] + (n + 1) * step)
    cell = F.least(F.expr(f"(h - {x.low[0]}L) div {step}L"), F.lit(even).cast("long"))
    last = cuts[-1] if even < len(cuts) else None
    return cell + F.when(_at_least(h, i, last), 1).otherwise(0) if last else cell


def shard_of(h: Column, i: Column, keys: list[tuple[int, int]]) -> Column:
    return reduce(lambda a, b: a + b, [_at_least(h, i, k).cast("int") for k in keys], F.lit(0))


def shard(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = SHARDS, keep: list[str] | None = None
) -> DataFrame:
    """Add size, text_crc32, law, shard, slot and grown_shard.

    The columns ``keep`` (all, unless given) are staged and exchanged with the keys.
    """
    made = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    h, i, cell, part = (fresh(docs, x) for x in ("h", "i", "cell", "cell_start"))
    in_shard, in_cell = (fresh(docs, x) for x in ("in_shard", "in_cell"))
    whole = whole_text(F.col(text))
    rows = docs.withColumns(
        {
            "size": F.octet_length(whole).cast("long") + 16,
            "text_crc32": F.crc32(whole.cast("binary")),
            h: F.shiftrightunsigned(F.xxhash64(whole), 2),
            i: F.coalesce(F.col(doc_id).cast("long"), F.lit(_ID_LOW)),
        }
    )
    rows = staged(rows.select(*quoted(carried), "size", "text_crc32", h, i))
    keys = splitters(rows.select(F.col(h).alias("h"), F.col(i).alias("i"), "size"), shards)
    cells = max(1, -(-rows.count() // (shards * CELL_ROWS)))
    rows = rows.withColumns(
        {
            "shard": shard_of(F.col(h), F.col(i), keys),
            cell: F.pmod(F.xxhash64(i, h), F.lit(cells)).cast("int"),
        }
    )
    counts = rows.groupBy("shard", cell).agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col("shard").alias(in_shard), F.col(cell).alias(in_cell), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(part)
    )
    place = F.row_number().over(W.partitionBy("shard", cell).orderBy(h, i)) - 1
    out = rows.withColumn("slot", place.cast("long")).join(
        F.broadcast(starts) if cells == 1 else starts,
        (F.col("shard") == F.col(in_shard)) & (F.col(cell) == F.col(in_cell)),
    )
    return out.withColumns(
        {
            "slot": F.col("slot") + F.col(part),
            "law": F.lit("bytes"),
            "grown_shard": F.lit(None).cast("int"),
        }
    ).drop(h, i, cell, part, in_shard, in_cell)
