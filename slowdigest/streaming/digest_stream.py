"""Continuous loading: every micro-batch becomes one version of a digest table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from slowdigest.operators.digest import DEFAULT_INDEX_PREFIX
from slowdigest.plans.batch import slow_query_records
from slowdigest.sources.digest_table import DigestTable

# Fixed value: a batch is flushed at the latest after this time.
FLUSH_AGE = "30 seconds"


def digest_stream(
    blocks: DataFrame,
    table_root: str,
    checkpoint: str,
    *,
    index_prefix: str = DEFAULT_INDEX_PREFIX,
    order: str = "time",
    compact_every: int = 20,
    available_now: bool = False,
    flush_age: str = FLUSH_AGE,
    job: str = "slow-log",
    **options,
) -> StreamingQuery:
    """Start loading a ``stream_slow_log`` source into a digest table.

    The size bound of a batch is set at the source, its age bound here.  The
    checkpoint reads each file once; a batch that is repeated after a failure
    overwrites its own version.  A table takes one stream only: a second one, or one
    after ``run_batch``, fails instead of overwriting loads.  ``options`` go to ``slow_query_records``.
    """
    if compact_every <= 0:
        raise ValueError("compact_every must be positive")

    def load(batch: DataFrame, batch_id: int) -> None:
        table = DigestTable(batch.sparkSession, table_root, order=order)
        # The query id lives in the checkpoint: a new or lost checkpoint is another writer.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.claim(f"stream {query}")
        records = slow_query_records(batch, **options)
        table.load(batch_id, records, index_prefix=index_prefix, job=job)
        if (batch_id + 1) % compact_every == 0:
            table.compact(batch_id)

    writer = (
        blocks.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .queryName(job)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=flush_age)
    return writer.start()
