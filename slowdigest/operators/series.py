"""Summaries of numeric time series, one per key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ends(ts: str, value: str, tie: str | None) -> tuple[Column, Column]:
    """First and last value by time.

    Without ``tie`` all buffers have a fixed width and the aggregation hashes;
    times must then be unique per key for a stable answer.
    """
    rank = F.struct(ts, tie) if tie else F.col(ts)
    return F.min_by(value, rank), F.max_by(value, rank)


def trailing_trend(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    *,
    minutes: float = 5,
    as_of: datetime | Column,
    tie: str | None = None,
) -> DataFrame:
    """Trend over the last ``minutes`` up to ``as_of``, per key.

    Keys whose points do not span any time give no row.  With a literal
    ``as_of`` the time bound reaches the scan.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    since = now - F.make_dt_interval(mins=F.lit(minutes))
    first, last = _ends(ts, value, tie)
    points = df.filter((F.col(ts) >= since) & F.col(value).isNotNull())
    micros = F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))
    return (
        points.groupBy(key)
        .agg(
            (micros / 60_000_000).alias("duration_minutes"),
            (last - first).alias("growth"),
            F.avg(value).alias("average"),
            F.max(value).alias("peak"),
            last.alias("current"),
        )
        .filter(F.col("duration_minutes") > 0)
        .select(
            key,
            "duration_minutes",
            "growth",
            (F.col("growth") / F.col("duration_minutes")).alias("growth_per_minute"),
            "average",
            "peak",
            "current",
        )
    )


def series_growth(
    df: DataFrame, key: str, ts: str, value: str, *, tie: str | None = None
) -> DataFrame:
    """Last value minus first value, per key."""
    first, last = _ends(ts, value, tie)
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg((last - first).alias("growth"))


def threshold_status(value: str | Column, warning: float, critical: float) -> Column:
    """'critical', 'warning' or 'normal'; a bound itself counts as reached."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v >= critical, "critical").when(v >= warning, "warning").otherwise("normal")
