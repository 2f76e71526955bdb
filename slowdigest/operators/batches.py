"""Statistics over write-batch records (``BATCH_SCHEMA``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowdigest.operators.running import SLOT_ROWS, rolling_mean, running_sums


def _ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where ``bottom`` is 0 or missing."""
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _good() -> Column:
    return F.when(F.col("success"), F.col("size")).otherwise(0)


def _bad() -> Column:
    return F.when(F.col("success"), 0).otherwise(F.col("size"))


def run_summary(df: DataFrame) -> DataFrame:
    """Per job: queries processed, documents indexed, errors, time and batches."""
    return df.groupBy("job").agg(
        F.sum("size").alias("processed_queries"),
        F.sum(_good()).alias("indexed_documents"),
        F.sum(_bad()).alias("error_count"),
        F.sum("duration").alias("total_duration"),
        F.count(F.lit(1)).alias("batches_processed"),
        F.coalesce(F.avg("duration"), F.lit(0.0)).alias("average_batch_duration"),
    )


def batch_summary(df: DataFrame) -> DataFrame:
    """Per job: document totals, success rate in percent, means and throughput.

    A batch that failed in part counts as failed as a whole.
    """
    sums = df.groupBy("job").agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_documents"),
        F.sum(_good()).alias("successful_documents"),
        F.sum(_bad()).alias("failed_documents"),
        F.count(F.lit(1)).alias("total_batches"),
        F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_processing_time"),
        F.coalesce(F.avg("size"), F.lit(0.0)).alias("average_batch_size"),
        F.coalesce(F.avg("duration"), F.lit(0.0)).alias("average_batch_time"),
    )
    return sums.select(
        "job",
        "total_documents",
        "successful_documents",
        "failed_documents",
        _ratio(F.col("successful_documents") * 100.0, F.col("total_documents")).alias(
            "success_rate"
        ),
        "total_batches",
        "total_processing_time",
        "average_batch_size",
        "average_batch_time",
        _ratio(F.col("total_documents"), F.col("total_processing_time")).alias(
            "documents_per_second"
        ),
    )


def error_distribution(df: DataFrame) -> DataFrame:
    """Occurrences per job and error type."""
    return (
        df.filter(F.col("error_type").isNotNull())
        .groupBy("job", "error_type")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def error_list(df: DataFrame, time_col: str) -> DataFrame:
    """Time and error of every record that has both."""
    return df.filter(F.col("error_type").isNotNull() & F.col(time_col).isNotNull()).select(
        F.col(time_col).alias("timestamp"), F.col("error_type").alias("error")
    )


def batch_running_totals(df: DataFrame, *, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Per batch: successes and errors of its job so far.  ``batch_id`` is unique per job."""
    parts = df.withColumn("_good", _good()).withColumn("_bad", _bad())
    return running_sums(
        parts,
        "job",
        "batch_id",
        {"success_count": "_good", "error_count": "_bad"},
        slot_rows=slot_rows,
    ).select(*df.columns, "success_count", "error_count")


def batch_rolling_mean(
    df: DataFrame,
    value: str = "duration",
    *,
    size: int = 10,
    full_only: bool = True,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Per batch: mean of the last ``size`` batches of its job as ``rolling_mean``.

    Null until ``size`` batches exist, unless ``full_only`` is off.
    """
    return rolling_mean(
        df,
        "job",
        "batch_id",
        value,
        size=size,
        name="rolling_mean",
        full_only=full_only,
        slot_rows=slot_rows,
    )
