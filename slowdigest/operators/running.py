"""Running totals and rolling means over one key that may own most of the rows.

A plain window over the key would pull the whole key into one task.  Here a key
is cut into slots by its order column; windows run inside a slot, and totals per
slot (one small row each) carry the earlier part over.  Sparse order values make as
many slots as rows, so slots are summed up the same way, in two more levels of
``FAN`` each: no window holds more than ``slot_rows`` rows or ``FAN`` totals,
however the values lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT_ROWS = 65_536
#: Slots whose totals are added up in one window; two levels of it span all longs.
FAN = 1 << 21
_LEVELS = 2


def _floor(number: str, by: int) -> Column:
    """Whole quotient, rounded down; exact for all longs, which a division of doubles is not."""
    n = f"cast(`{number}` as bigint)"
    return F.expr(f"({n} div {by}L) - if({n} % {by}L < 0, 1L, 0L)")


def _before(totals: DataFrame, names: list[str], levels: int) -> DataFrame:
    """(_key, _slot) with the sums of all earlier slots of the key as ``_before_<name>``."""

    def earlier(*keys: str) -> list[Column]:
        window = W.partitionBy(*keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
        return [F.coalesce(F.sum(f"_total_{n}").over(window), F.lit(0)).alias(f"_before_{n}") for n in names]

    if not levels:
        return totals.select("_key", "_slot", *earlier("_key"))
    parts = totals.withColumn("_above", _floor("_slot", FAN))
    above = parts.groupBy("_key", "_above").agg(*(F.sum(f"_total_{n}").alias(f"_total_{n}") for n in names))
    carried = _before(above.withColumnRenamed("_above", "_slot"), names, levels - 1).select(
        "_key", F.col("_slot").alias("_above"), *(F.col(f"_before_{n}").alias(f"_far_{n}") for n in names)
    )
    near = parts.select("_key", "_above", "_slot", *earlier("_key", "_above"))
    return near.join(carried, ["_key", "_above"]).select(
        "_key", "_slot", *((F.col(f"_before_{n}") + F.col(f"_far_{n}")).alias(f"_before_{n}") for n in names)
    )


def running_sums(
    df: DataFrame, key: str, order: str, sums: dict[str, str], *, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """Add a running sum per key for each ``{new column: numeric column}``.

    ``order`` is an integer that is unique within the key; a slot spans
    ``slot_rows`` of its values, so it never holds more rows than that.
    """
    if slot_rows <= 0:
        raise ValueError("slot_rows must be positive")
    # A struct of the key is never null, so rows with a null key join like others.
    slotted = df.withColumn("_key", F.struct(key)).withColumn("_slot", _floor(order, slot_rows))
    totals = slotted.groupBy("_key", "_slot").agg(
        *(F.sum(c).alias(f"_total_{name}") for name, c in sums.items())
    )
    before = _before(totals, list(sums), _LEVELS)
    inside = W.partitionBy("_key", "_slot").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    within = slotted.select("*", *(F.sum(c).over(inside).alias(f"_in_{n}") for n, c in sums.items()))
    return within.join(before, ["_key", "_slot"]).select(
        *df.columns,
        *(
            (F.col(f"_before_{n}") + F.coalesce(F.col(f"_in_{n}"), F.lit(0))).alias(n)
            for n in sums
        ),
    )


def rolling_mean(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    *,
    size: int,
    name: str,
    full_only: bool = True,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Add the mean of ``value`` over the last ``size`` rows of the key.

    With ``full_only`` it is null until ``size`` rows exist.  Rows are numbered
    first, then cut into frames of ``slot_rows``; the last ``size - 1`` rows of a
    frame are also handed to the next one, which makes every frame self-contained.
    """
    if not 0 < size <= slot_rows:
        raise ValueError("size must be between 1 and slot_rows")
    numbered = running_sums(
        df.withColumn("_one", F.lit(1)), key, order, {"_at": "_one"}, slot_rows=slot_rows
    ).withColumn("_frame", F.floor((F.col("_at") - 1) / slot_rows))
    tail = (F.col("_at") - 1) % slot_rows >= slot_rows - (size - 1)
    frames = F.when(tail, F.array(F.col("_frame"), F.col("_frame") + 1)).otherwise(
        F.array("_frame")
    )
    spread = numbered.withColumn("_in_frame", F.explode(frames))
    last = W.partitionBy(key, "_in_frame").orderBy("_at").rowsBetween(-(size - 1), 0)
    mean = F.avg(value).over(last)
    if full_only:
        mean = F.when(F.col("_at") >= size, mean)
    return (
        spread.withColumn(name, mean)
        .filter(F.col("_in_frame") == F.col("_frame"))
        .select(*df.columns, name)
    )
