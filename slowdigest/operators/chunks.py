"""Progress reports over input-chunk records (``CHUNK_SCHEMA``)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The states a chunk can be in.
STATUSES = ("pending", "processing", "completed", "failed")
# Completed chunks that the recent rate looks at; attempts a chunk may use.
RECENT = 100
MAX_ATTEMPTS = 3


def _is(status: str) -> Column:
    return F.col("status") == status


def with_duration(df: DataFrame) -> DataFrame:
    """Add ``duration_seconds``: end minus start, null while either is missing."""
    span = F.unix_micros("end_time") - F.unix_micros("start_time")
    return df.withColumn("duration_seconds", span / 1_000_000)


def status_counts(df: DataFrame) -> DataFrame:
    """One row with the number of chunks in each state."""
    return df.agg(*(F.count_if(_is(s)).alias(s) for s in STATUSES))


def failed_chunks(df: DataFrame) -> DataFrame:
    """Failed chunks with their attempts and error."""
    return df.filter(_is("failed")).select("chunk_id", "attempt_count", "error")


def retryable_chunks(df: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Failed chunks that may be tried again."""
    return df.filter(_is("failed") & (F.col("attempt_count") < max_attempts)).select("chunk_id")


def chunk_progress(df: DataFrame, total_bytes: int | None = None) -> DataFrame:
    """One row: counts, bytes done, percent by bytes and by chunks, mean chunk time.

    ``total_bytes`` defaults to the bytes of all chunks.
    """
    done = _is("completed")
    sums = with_duration(df).agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.count_if(done).alias("completed_chunks"),
        F.count_if(_is("failed")).alias("failed_chunks"),
        F.count_if(_is("processing")).alias("processing_chunks"),
        F.coalesce(F.sum(F.when(done, F.col("size_bytes"))), F.lit(0)).alias("processed_bytes"),
        (
            F.coalesce(F.sum("size_bytes"), F.lit(0))
            if total_bytes is None
            else F.lit(total_bytes).cast("bigint")
        ).alias("total_bytes"),
        F.avg(F.when(done, F.col("duration_seconds"))).alias("mean"),
    )

    def percent(part: str, whole: str) -> Column:
        share = F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100).otherwise(0.0)
        return F.round(share, 2)

    return sums.select(
        "total_chunks",
        "completed_chunks",
        "failed_chunks",
        "processing_chunks",
        "processed_bytes",
        "total_bytes",
        percent("processed_bytes", "total_bytes").alias("progress_percentage"),
        percent("completed_chunks", "total_chunks").alias("chunk_percentage"),
        F.coalesce("mean", F.lit(0.0)).alias("average_chunk_seconds"),
    )


def _recent(df: DataFrame, last: int) -> DataFrame:
    """The last completed chunks that took any time: a distributed top-k."""
    return (
        with_duration(df.filter(_is("completed")))
        .filter(F.col("duration_seconds") != 0)
        .orderBy(F.desc("end_time"), F.desc("chunk_id"))
        .limit(last)
    )


def _rate(size: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, size / seconds).otherwise(0.0)


def recent_rate(df: DataFrame, last: int = RECENT) -> DataFrame:
    """One row: bytes per second over the last completed chunks, 0 without any."""
    return _recent(df, last).agg(
        _rate(F.sum("size_bytes"), F.sum("duration_seconds")).alias("bytes_per_second")
    )


def run_rate(df: DataFrame, *, as_of: datetime | Column) -> DataFrame:
    """One row: bytes per second over the whole run up to ``as_of``."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    span = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.min("start_time"))) / 1_000_000
    done = F.coalesce(F.sum(F.when(_is("completed"), F.col("size_bytes"))), F.lit(0))
    return df.agg(_rate(done, span).alias("bytes_per_second"))


def completion_estimate(
    df: DataFrame,
    total_bytes: int,
    *,
    as_of: datetime | Column,
    last: int = RECENT,
) -> DataFrame:
    """One row: when the rest will be done at the recent rate.

    ``as_of`` itself if nothing remains; null without a rate.
    """
    now = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")
    # The two inputs of the estimate are summed as one stream of rows, not joined.
    recent = _recent(df, last).select(
        F.lit(0).cast("bigint").alias("done"), "size_bytes", "duration_seconds"
    )
    done = df.filter(_is("completed")).select(
        F.col("size_bytes").alias("done"),
        F.lit(0).cast("bigint").alias("size_bytes"),
        F.lit(0.0).alias("duration_seconds"),
    )
    sums = recent.unionByName(done).agg(
        F.coalesce(F.sum("done"), F.lit(0)).alias("processed_bytes"),
        _rate(F.sum("size_bytes"), F.sum("duration_seconds")).alias("rate"),
    )
    left = F.lit(total_bytes) - F.col("processed_bytes")
    micros = F.round(left / F.col("rate") * 1_000_000).cast("bigint")
    finish = F.when(
        F.col("rate") > 0,
        F.when(left <= 0, now).otherwise(F.timestamp_micros(F.unix_micros(now) + micros)),
    )
    return sums.select(
        "processed_bytes",
        F.greatest(left, F.lit(0)).alias("remaining_bytes"),
        F.col("rate").alias("bytes_per_second"),
        finish.alias("estimated_completion"),
    )
