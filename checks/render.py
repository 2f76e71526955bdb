"""Slow-log text derived from the ``events`` table: the input of the checks.

One block per event.  ``event_id % 4`` picks the statement: equality on
literals, an IN list, a ``use`` line with a quoted literal, or an UPDATE (which
validation rejects).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INSTANCE = "db-1"
PREFIX = "mysql-slowlog"

# Statement texts by event_id % 4 as format strings; every blank is one text argument.
STATEMENTS = (
    (
        "SELECT user_id, value FROM %s_u%s WHERE user_id = %s AND props = 'k%s it''s';",
        ("event_type", "user_id", "user_id", "event_id"),
    ),
    (
        "SELECT MIN(value), COUNT(*)\nFROM %s_log\n  WHERE  event_id IN (%s, %s, 7);",
        ("event_type", "event_id", "user_id"),
    ),
    (
        'use shop;\nSELECT t.a FROM %s t\n\tJOIN u%s u ON t.id = u.id\nWHERE t.name = "v%s" LIMIT 10;',
        ("event_type", "user_id", "event_id"),
    ),
    ("UPDATE %s_log SET value = %s WHERE event_id = %s;", ("event_type", "user_id", "event_id")),
)


#: Rows of a partition; rendered as log blocks and parsed, they keep a task busy for half a minute at most.
ROWS_PER_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A test table, spread over the cores and in partitions of bounded length.

    A row of a few bytes becomes a log block of hundreds, so the size of the files says too little about the work.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    wanted = max(spark.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def statement() -> Column:
    """Statement lines of an event."""
    kind = F.col("event_id") % len(STATEMENTS)
    made = F.lit(None)
    for i, (text, args) in enumerate(STATEMENTS):
        made = F.when(
            kind == i, F.format_string(text, *(F.col(a).cast("string") for a in args))
        ).otherwise(made)
    return made


def log_blocks(df: DataFrame) -> DataFrame:
    """Add ``text``: the log block of each event."""
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    user = F.col("user_id").cast("string")
    head = F.format_string(
        "# Time: %s\n# User@Host: u%s[u%s] @ h%s []\n"
        "# Query_time: %.6f  Lock_time: 0.000123 Rows_sent: %d  Rows_examined: %d\n"
        "SET timestamp=%d;\n",
        at,
        user,
        user,
        (F.col("user_id") % 5).cast("string"),
        F.col("value"),
        F.col("event_id") % 100,
        F.col("event_id") * 10,
        F.unix_seconds(F.col("ts").cast("timestamp")),
    )
    return df.withColumn("text", F.concat(head, statement()))


def write_logs(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write ``text`` as slow-log files named ``slowquery-…``."""
    lines = log_blocks(df).select("text")
    if files is not None:
        lines = lines.repartition(files)
    (
        lines.write.mode("overwrite")
        .option("mapreduce.output.basename", "slowquery")
        .text(path)
    )
