"""Which parsed records count as slow queries, and why the others do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowdigest.operators.blocks import check_profile

# Reasons in the order they are tested; the first that applies is reported.
OVERSIZED = "oversized"
EMPTY_QUERY = "empty_query"
NO_TIMESTAMP = "no_timestamp"
BELOW_MIN_TIME = "below_min_time"
NO_USER = "no_user"
NOT_SELECT = "not_select"
BAD_TIMESTAMP = "bad_timestamp"
REASONS = (
    OVERSIZED,
    EMPTY_QUERY,
    NO_TIMESTAMP,
    BELOW_MIN_TIME,
    NO_USER,
    NOT_SELECT,
    BAD_TIMESTAMP,
)


def reject_reason(
    min_query_time: float = 0.1, profile: str = "modular", oversize: Column | None = None
) -> Column:
    """Null for a valid record, else the first failed test.

    ``SELECT`` counts anywhere in the text.  ``bad_timestamp`` marks a time that
    is present but cannot be read; a date field could not hold it.
    """
    check_profile(profile)
    if min_query_time <= 0:
        raise ValueError("min_query_time must be positive")
    empty = F.coalesce(F.col("query"), F.lit("")) == ""
    untimed = F.coalesce(F.col("timestamp_raw"), F.lit("")) == ""
    fast = F.coalesce(F.col("query_time"), F.lit(0.0)) < min_query_time
    nameless = F.coalesce(F.col("user.name"), F.lit("")) == ""
    no_select = ~F.contains(F.upper("query"), F.lit("SELECT"))
    unreadable = F.col("timestamp_raw").isNotNull() & F.col("ts").isNull()
    if profile == "modular":
        tests = [
            (empty, EMPTY_QUERY),
            (untimed, NO_TIMESTAMP),
            (fast, BELOW_MIN_TIME),
            (nameless, NO_USER),
            (no_select, NOT_SELECT),
        ]
    else:
        tests = [(empty, EMPTY_QUERY), (no_select, NOT_SELECT), (fast, BELOW_MIN_TIME)]
    tests.append((unreadable, BAD_TIMESTAMP))
    if oversize is not None:
        tests.insert(0, (oversize == "dropped", OVERSIZED))
    reason = F.lit(None).cast("string")
    for failed, name in reversed(tests):
        reason = F.when(failed, name).otherwise(reason)
    return reason


def with_reject_reason(
    df: DataFrame, min_query_time: float = 0.1, profile: str = "modular"
) -> DataFrame:
    """Add ``reject_reason``; an ``oversize`` column is taken into account."""
    oversize = F.col("oversize") if "oversize" in df.columns else None
    return df.withColumn("reject_reason", reject_reason(min_query_time, profile, oversize))


def validate(df: DataFrame, min_query_time: float = 0.1, profile: str = "modular") -> DataFrame:
    """Keep the valid records only."""
    return (
        with_reject_reason(df, min_query_time, profile)
        .filter(F.col("reject_reason").isNull())
        .drop("reject_reason")
    )


def rejects(df: DataFrame, min_query_time: float = 0.1, profile: str = "modular") -> DataFrame:
    """The records that ``validate`` removes, with their reason."""
    return with_reject_reason(df, min_query_time, profile).filter(
        F.col("reject_reason").isNotNull()
    )


def reject_summary(df: DataFrame) -> DataFrame:
    """Number of rejected records per reason; ``df`` carries ``reject_reason``."""
    return (
        df.filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("blocks"))
    )
