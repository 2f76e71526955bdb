"""Declared schemas; nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

USER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("host", T.StringType()),
    ]
)

# Where a record stood in its input: orders records of one run by arrival.  Files go by
# their time of change where the reader was asked for it, then by name.
SEQ = T.StructType(
    [
        T.StructField("modified", T.TimestampType()),
        T.StructField("file", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)

PARSED_SCHEMA = T.StructType(
    [
        T.StructField("instance_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("seq", SEQ),
        T.StructField("timestamp_raw", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user", USER),
        T.StructField("query_time", T.DoubleType()),
        T.StructField("lock_time", T.DoubleType()),
        T.StructField("rows_examined", T.LongType()),
        T.StructField("rows_sent", T.LongType()),
        T.StructField("query", T.StringType()),
    ]
)

# One row per fingerprint.  The distinct occurrence times live in their own long
# table (OCCURRENCE_SCHEMA), because they grow with the log.
DIGEST_SCHEMA = T.StructType(
    [
        T.StructField("index_name", T.StringType()),
        T.StructField("instance_id", T.StringType()),
        T.StructField("query_hash", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("normalized_query", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("user", USER),
        T.StructField("query_time", T.DoubleType()),
        T.StructField("lock_time", T.DoubleType()),
        T.StructField("rows_examined", T.LongType()),
        T.StructField("rows_sent", T.LongType()),
        T.StructField("execution_count", T.LongType()),
        T.StructField("max_query_time", T.DoubleType()),
        T.StructField("last_seen", T.TimestampType()),
    ]
)

OCCURRENCE_SCHEMA = T.StructType(
    [
        T.StructField("instance_id", T.StringType()),
        T.StructField("query_hash", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

# A digest with its occurrence times attached, in pages of bounded length.
DOCUMENT_SCHEMA = T.StructType(
    DIGEST_SCHEMA.fields
    + [
        T.StructField("page", T.LongType()),
        T.StructField("timestamps", T.ArrayType(T.TimestampType())),
    ]
)

CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("attempt_count", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
    ]
)

BATCH_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error_type", T.StringType()),
    ]
)
