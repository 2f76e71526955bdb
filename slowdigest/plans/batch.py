"""The standard chain from log blocks to digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slowdigest.functions.normalize import generate_hash
from slowdigest.operators.blocks import compress_blocks, parse_blocks
from slowdigest.operators.digest import DEFAULT_INDEX_PREFIX
from slowdigest.operators.validate import with_reject_reason
from slowdigest.sources.digest_table import DigestTable
from slowdigest.sources.slowlog import read_slow_log

# Fixed value: the default of a run.
MIN_QUERY_TIME = 0.1


def slow_query_records(
    blocks: DataFrame,
    *,
    min_query_time: float = MIN_QUERY_TIME,
    profile: str = "modular",
    max_block_bytes: int | None = None,
    compat_rows: bool = False,
    drop_preamble: bool = False,
) -> DataFrame:
    """Parsed records with ``reject_reason``, ``rejected`` and ``query_hash``.

    The hash is computed for valid records only.  Blocks above
    ``max_block_bytes`` are shortened; without a bound none is, in either profile.
    """
    single = profile == "single_file"
    if max_block_bytes is not None:
        blocks = compress_blocks(blocks, max_block_bytes)
    parsed = parse_blocks(
        blocks, profile=profile, compat_rows=compat_rows, drop_preamble=drop_preamble
    )
    judged = with_reject_reason(parsed, min_query_time, profile)
    valid = F.col("reject_reason").isNull()
    return judged.withColumn(
        "query_hash", F.when(valid, generate_hash(F.col("query"), rehash=single))
    ).withColumn("rejected", ~valid)


def run_batch(
    spark: SparkSession,
    path: str | list[str],
    instance_id: str | Column,
    table_root: str,
    *,
    index_prefix: str = DEFAULT_INDEX_PREFIX,
    order: str = "time",
    profile: str = "modular",
    job: str = "slow-log",
    compact_every: int | None = 20,
    file_order: str = "name",
    **options,
) -> DigestTable:
    """Load all slow logs under ``path`` as the next version of a digest table.

    A batch load has no memory of files: loading the same ones again counts them
    again.  ``digest_stream`` with ``available_now`` takes only new files.  Every ``compact_every`` loads the table
    is compacted.  ``options`` go to ``slow_query_records``.
    """
    if compact_every is not None and compact_every <= 0:
        raise ValueError("compact_every must be positive")
    table = DigestTable(spark, table_root, order=order)
    blocks = read_slow_log(spark, path, instance_id, profile=profile, file_order=file_order)
    records = slow_query_records(blocks, profile=profile, **options)
    table.claim("run_batch")
    version = table.newest() + 1
    table.load(version, records, index_prefix=index_prefix, job=job)
    if compact_every is not None and (version + 1) % compact_every == 0:
        table.compact(version)
    return table
