"""Reading slow-log files and reading or writing digest tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowdigest.operators.blocks import split_blocks
from slowdigest.operators.digest import DEFAULT_INDEX_PREFIX, index_name
from slowdigest.schema import DIGEST_SCHEMA
from slowdigest.sources.storage import observed

# The marker that starts a block and the part of a name that marks a slow log.
BLOCK_MARKER = "\n# Time:"
NAME_GLOB = "*slowquery*"

_TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def _as_column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


FILE_ORDERS = ("name", "modified")


def _blocks(
    lines: DataFrame, instance_id: str | Column, profile: str, file_order: str
) -> DataFrame:
    if file_order not in FILE_ORDERS:
        raise ValueError(f"file_order must be one of {FILE_ORDERS}, not {file_order!r}")
    changed = F.col("_metadata.file_modification_time")
    placed = lines.select(
        _as_column(instance_id).alias("instance_id"),
        F.col("_metadata.file_path").alias("source_file"),
        (changed if file_order == "modified" else F.lit(None).cast("timestamp")).alias(
            "source_modified"
        ),
        F.col("_metadata.file_block_start").alias("split_start"),
        "value",
    )
    return split_blocks(placed, "value", marker_consumed=True, profile=profile)


def read_slow_log(
    spark: SparkSession,
    path: str | list[str],
    instance_id: str | Column,
    *,
    name_glob: str = NAME_GLOB,
    profile: str = "modular",
    file_order: str = "name",
) -> DataFrame:
    """Blocks of every slow-log file under ``path``.

    The block marker is the record delimiter, so large files are split over many
    tasks and no block is ever cut.  ``instance_id`` may be a Column, for
    instance one taken from ``_metadata.file_path``.  Where the order of arrival counts,
    files go by name, or with ``file_order="modified"`` by their time of change, as rotated
    files need whose names run backwards.
    """
    lines = (
        spark.read.option("lineSep", BLOCK_MARKER)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", "true")
        .text(path)
    )
    return _blocks(lines, instance_id, profile, file_order)


def stream_slow_log(
    spark: SparkSession,
    path: str,
    instance_id: str | Column,
    *,
    name_glob: str = NAME_GLOB,
    profile: str = "modular",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    file_order: str = "name",
) -> DataFrame:
    """Streaming twin of ``read_slow_log``: each arriving file is read once.

    Files must be complete when they land (rotated logs): a file that grows later
    is not read again.
    """
    reader = (
        spark.readStream.schema(_TEXT_SCHEMA)
        .option("lineSep", BLOCK_MARKER)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return _blocks(reader.text(path), instance_id, profile, file_order)


@dataclass(frozen=True)
class WriteCounts:
    ok: int
    failed: int


def write_digest(df: DataFrame, path: str, *, mode: str = "overwrite") -> WriteCounts:
    """Write digests as Parquet under ``index_name=…`` folders and count them.

    Rows without a key cannot be stored; they are counted as failed and the rest
    is still written.  REBALANCE lets adaptive execution merge small partitions
    of one index and split a large index over several files.
    """
    counts = Observation()
    keyless = F.col("query_hash").isNull() | F.col("index_name").isNull()
    (
        df.observe(
            counts,
            F.count_if(~keyless).alias("ok"),
            F.count_if(keyless).alias("failed"),
        )
        .filter(~keyless)
        .hint("rebalance", "index_name")
        .write.mode(mode)
        .partitionBy("index_name")
        .parquet(path)
    )
    seen = observed(counts)
    return WriteCounts(seen.get("ok", 0), seen.get("failed", 0))


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """Read what ``write_digest`` wrote; an empty table if nothing is there."""
    try:
        return spark.read.schema(DIGEST_SCHEMA).parquet(path).select(*DIGEST_SCHEMA.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DIGEST_SCHEMA)


def digest_stats(spark: SparkSession, path: str) -> DataFrame:
    """Stored documents and bytes, one row; no row if the table does not exist."""
    schema = T.StructType(
        [
            T.StructField("document_count", T.LongType()),
            T.StructField("store_size_bytes", T.LongType()),
        ]
    )
    try:
        files = spark.read.schema(DIGEST_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    per_file = files.groupBy("_metadata.file_path", "_metadata.file_size").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("document_count"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("store_size_bytes"),
    ).to(schema)


#: What an index does with an action for a fingerprint it knows: note a new time, count, keep the
#: longest time and the latest sighting.  Register it under ``script_id``, or send it inline.
MERGE_SCRIPT = (
    "def d = ctx._source; "
    "if (d.timestamps == null) { d.timestamps = [] } "
    "if (d.timestamps.indexOf(params.timestamp) < 0) { d.timestamps.add(params.timestamp) } "
    "d.execution_count = d.execution_count == null ? 1 : d.execution_count + 1; "
    "if (d.max_query_time == null || d.max_query_time < params.query_time) "
    "{ d.max_query_time = params.query_time } "
    "d.last_seen = params.timestamp"
)
SCRIPT_LANG = "painless"


def to_upsert_actions(
    df: DataFrame,
    *,
    index_prefix: str = DEFAULT_INDEX_PREFIX,
    script_id: str = "merge-digest",
    inline: bool = False,
) -> DataFrame:
    """One JSON update action per fingerprinted record, as a ``value`` column.

    ``script`` names a stored merge script (its text is ``MERGE_SCRIPT``) or, with
    ``inline``, carries it, and holds its parameters; ``upsert`` is the document for a
    first sighting.  Write with ``df.write.text(path)``.
    """
    at = F.col("timestamp_raw")
    upsert = F.struct(
        "query",
        "normalized_query",
        "query_hash",
        at.alias("timestamp"),
        "user",
        "query_time",
        "lock_time",
        "rows_examined",
        "rows_sent",
        F.lit(1).cast("bigint").alias("execution_count"),
        F.array(at).alias("timestamps"),
        F.col("query_time").alias("max_query_time"),
        at.alias("last_seen"),
        "instance_id",
    )
    merge = [F.lit(script_id).alias("id")]
    if inline:
        merge = [F.lit(MERGE_SCRIPT).alias("source"), F.lit(SCRIPT_LANG).alias("lang")]
    action = F.struct(
        F.lit("update").alias("_op_type"),
        index_name(index_prefix).alias("_index"),
        F.col("query_hash").alias("_id"),
        F.struct(
            *merge, F.struct(at.alias("timestamp"), "query_time").alias("params")
        ).alias("script"),
        upsert.alias("upsert"),
        F.lit(3).alias("retry_on_conflict"),
    )
    return df.select(F.to_json(action, {"ignoreNullFields": "false"}).alias("value"))
