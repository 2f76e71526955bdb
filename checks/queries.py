"""The registered queries: each runs one part of the library over whole tables.

Timestamps are returned without a zone and structs flattened, so that results
compare with plain SQL.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.render import INSTANCE, PREFIX, events, log_blocks, statement, table, write_logs
from checks.variants import BOUND, variant_blocks, write_variants
from slowdigest.functions import normalize as N
from slowdigest.operators import batches, chunks, series
from slowdigest.operators.blocks import compress_blocks, parse_blocks, split_blocks
from slowdigest.operators.digest import (
    digest,
    digest_documents,
    expire_digest,
    expired_digest,
    first_arrivals,
    merge_digest,
    occurrences,
    with_fingerprint,
)
from slowdigest.operators.validate import reject_summary, rejects, validate, with_reject_reason
from slowdigest.plans.batch import run_batch, slow_query_records
from slowdigest.sources.digest_table import DigestTable
from slowdigest.sources.slowlog import (
    digest_stats,
    read_digest,
    read_slow_log,
    stream_slow_log,
    to_upsert_actions,
    write_digest,
)
from slowdigest.sources.storage import forget_commit
from slowdigest.streaming.digest_stream import digest_stream

AS_OF = dt.datetime(2024, 1, 31)
EXPIRE_DAYS = 5
TREND_MINUTES = 10 * 24 * 60
PAGE = 4
COMPRESS_ABOVE = 400
TOTAL_BYTES = 10**14
ROTATED = ("c-oldest", "b-older", "a-newest")
SPARSE = 4_000_000_007


def scratch(spark: SparkSession) -> str:
    """A new folder: in the cluster's shared one if it names one, else local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/slowdigest-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="slowdigest-")


def _naive(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


# ---------------------------------------------------------------- inputs


def _text_blocks(spark: SparkSession, sf: str, profile: str = "modular") -> DataFrame:
    """Blocks cut from the rendered text of all events, without files."""
    text = log_blocks(events(spark, sf)).select(F.lit(INSTANCE).alias("instance_id"), "text")
    return split_blocks(text, "text", profile=profile)


def _written_logs(spark: SparkSession, sf: str, *, sort: bool = False) -> str:
    folder = f"{scratch(spark)}/logs"
    df = events(spark, sf)
    if sort:
        df = df.repartitionByRange(4, "event_id").sortWithinPartitions("event_id")
        write_logs(df, folder)
    else:
        write_logs(df, folder, 5)
    return folder


def _fingerprinted(spark: SparkSession, sf: str) -> DataFrame:
    return with_fingerprint(validate(parse_blocks(_text_blocks(spark, sf))))


def _batch_records(spark: SparkSession, sf: str) -> DataFrame:
    ok = F.col("event_id") % 10 != 0
    kinds = F.when(F.col("event_id") % 20 == 0, "TransportError").otherwise("ConnectionTimeout")
    return events(spark, sf).select(
        F.col("event_type").alias("job"),
        F.col("event_id").alias("batch_id"),
        F.col("user_id").alias("size"),
        F.col("value").alias("duration"),
        ok.alias("success"),
        F.when(~ok, kinds).alias("error_type"),
        "ts",
    )


def _chunk_records(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "P", "processing")
        .when(key % 2 == 0, "failed")
        .otherwise("pending")
    )
    seconds = F.make_dt_interval(secs=(key % 600).cast("decimal(18,6)"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("log_"), key.cast("string")).alias("chunk_id"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size_bytes"),
        status.alias("status"),
        (key % 5).cast("int").alias("attempt_count"),
        F.when(status == "failed", F.col("o_orderpriority")).alias("error"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        F.when(status.isin("completed", "failed"), F.col("o_orderdate") + seconds)
        .cast("timestamp")
        .alias("end_time"),
    )


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


# ---------------------------------------------------------------- output shapes


def _parsed_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "instance_id",
        "timestamp_raw",
        _naive("ts").alias("ts"),
        F.col("user.name").alias("user_name"),
        F.col("user.host").alias("user_host"),
        "query_time",
        "lock_time",
        "rows_examined",
        "rows_sent",
        "query",
        *more,
    )


def _digest_columns(df: DataFrame, *more: str | Column) -> DataFrame:
    return df.select(
        "index_name",
        "instance_id",
        "query_hash",
        "query",
        "normalized_query",
        _naive("timestamp").alias("first_seen"),
        F.col("user.name").alias("user_name"),
        F.col("user.host").alias("user_host"),
        "query_time",
        "lock_time",
        "rows_examined",
        "rows_sent",
        "execution_count",
        "max_query_time",
        _naive("last_seen").alias("last_seen"),
        *more,
    )


def _rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---------------------------------------------------------------- parsing and validation


def q_parse_blocks(spark, sf):
    return _parsed_columns(parse_blocks(_text_blocks(spark, sf)))


def q_read_slow_log(spark, sf):
    return _parsed_columns(parse_blocks(read_slow_log(spark, _written_logs(spark, sf), INSTANCE)))


def q_parse_compat_rows(spark, sf):
    return _parsed_columns(parse_blocks(_text_blocks(spark, sf), compat_rows=True))


def q_parse_single_file(spark, sf):
    blocks = _text_blocks(spark, sf, "single_file")
    return _parsed_columns(parse_blocks(blocks, profile="single_file"))


def q_valid_queries(spark, sf):
    return _parsed_columns(validate(parse_blocks(_text_blocks(spark, sf))))


def q_valid_single_file(spark, sf):
    blocks = _text_blocks(spark, sf, "single_file")
    parsed = parse_blocks(blocks, profile="single_file")
    return _parsed_columns(validate(parsed, profile="single_file"))


def q_rejects(spark, sf):
    return _parsed_columns(rejects(parse_blocks(_text_blocks(spark, sf))), "reject_reason")


def q_reject_summary(spark, sf):
    return reject_summary(with_reject_reason(parse_blocks(_text_blocks(spark, sf))))


# ---------------------------------------------------------------- blocks of every shape


def _variants(spark: SparkSession, sf: str, profile: str = "modular") -> DataFrame:
    return split_blocks(variant_blocks(events(spark, sf)), "text", profile=profile)


def _counts_as_text(df: DataFrame) -> DataFrame:
    """Unreadable counts are null; as text they compare alike whatever holds the numbers."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("rows_examined", "rows_sent")})


def q_parse_variants(spark, sf):
    return _counts_as_text(_parsed_columns(parse_blocks(_variants(spark, sf)), "event_id"))


def q_parse_variants_single(spark, sf):
    parsed = parse_blocks(_variants(spark, sf, "single_file"), profile="single_file")
    return _counts_as_text(_parsed_columns(parsed, "event_id"))


def _read_variants(spark, sf, profile):
    folder = f"{scratch(spark)}/logs"
    write_variants(events(spark, sf), folder, 5)
    blocks = read_slow_log(spark, folder, INSTANCE, profile=profile)
    return _counts_as_text(_parsed_columns(parse_blocks(blocks, profile=profile)))


def q_read_variants(spark, sf):
    return _read_variants(spark, sf, "modular")


def q_read_variants_single(spark, sf):
    return _read_variants(spark, sf, "single_file")


def q_variant_rejects(spark, sf):
    """Reasons of both profiles; blocks beyond the bound that cannot be shortened are among them."""
    found = [
        reject_summary(
            slow_query_records(_variants(spark, sf, profile), profile=profile, max_block_bytes=BOUND)
        ).select(F.lit(profile).alias("profile"), "reject_reason", "blocks")
        for profile in ("modular", "single_file")
    ]
    return found[0].unionByName(found[1])


def _variant_digest(spark, sf, profile):
    records = slow_query_records(_variants(spark, sf, profile), profile=profile)
    return _counts_as_text(_digest_columns(digest(_stored(spark, records.filter(~F.col("rejected"))))))


def q_variant_digest(spark, sf):
    return _variant_digest(spark, sf, "modular")


def q_variant_digest_single(spark, sf):
    return _variant_digest(spark, sf, "single_file")


# ---------------------------------------------------------------- normalisation


def _over_documents(step: Callable[[Column], Column]):
    def run(spark, sf):
        return _documents(spark, sf).select("doc_id", step(F.col("text")).alias("text"))

    return run


def q_normalize_in(spark, sf):
    """Text in an IN list: closed for even ids, cut off for odd ones."""
    end = F.when(F.col("doc_id") % 2 == 0, ") AND b = 2").otherwise("")
    sql = F.concat(
        F.lit("SELECT max(a), Min(b) FROM t WHERE a in  ("),
        F.col("text"),
        end,
    )
    return _documents(spark, sf).select("doc_id", N.fold_in_lists(sql).alias("text"))


def q_strip_meta(spark, sf):
    user = F.col("user_id").cast("string")
    sql = F.concat(
        F.lit("SET  timestamp = "),
        F.col("event_id").cast("string"),
        F.lit(" ; use shop_1; -- REMOTE_ADDR : 10.0.0."),
        user,
        F.lit(" -- url: /a/"),
        user,
        F.lit("?q=x -- note\nset timestamp=7;"),
        statement(),
    )
    return events(spark, sf).select("event_id", N.strip_meta(sql).alias("text"))


def q_last_statement(spark, sf):
    sql = F.concat(
        F.lit("use `shop`; SELECT 1; "),
        F.rtrim(statement(), F.lit(";")),
        F.when(F.col("user_id") % 2 == 0, "; COMMIT;\n ;").otherwise(" "),
    )
    return events(spark, sf).select("event_id", N.last_statement(sql).alias("text"))


def q_query_fingerprint(spark, sf):
    df = events(spark, sf).select("event_id", statement().alias("query"))
    return with_fingerprint(df).select("event_id", "normalized_query", "query_hash")


def q_query_fingerprint_rehash(spark, sf):
    df = events(spark, sf).select("event_id", statement().alias("query"))
    return with_fingerprint(df, rehash=True).select("event_id", "query_hash")


def q_compress_oversized(spark, sf):
    """Every document as a statement with literals, lists, CASE, ORDER BY and GROUP BY."""
    text = F.col("text")
    key = F.col("doc_id").cast("string")
    sql = F.concat(
        F.lit("# Query_time: 1.0  Lock_time: 0.0\nSELECT case when a then '"),
        text,
        F.lit("' end, 1, 2,3 , 4,5,6,"),
        key,
        F.lit(" FROM t WHERE a in (1, "),
        key,
        F.lit(") GROUP BY a,b,c,d,e,f,g ORDER BY a,b;\nINSERT INTO t VALUES ("),
        text,
        F.lit(");"),
    )
    df = _documents(spark, sf).select("doc_id", F.lit(False).alias("has_time"), sql.alias("block"))
    return compress_blocks(df, COMPRESS_ABOVE).select("doc_id", "oversize", "block")


# ---------------------------------------------------------------- digests


def q_digest(spark, sf):
    return _digest_columns(digest(_fingerprinted(spark, sf), index_prefix=PREFIX, passes=1))


def q_digest_stored(spark, sf):
    """Two passes over stored records: numbers first, then the bodies of the winners."""
    return _digest_columns(digest(_stored(spark, _fingerprinted(spark, sf)), index_prefix=PREFIX))


def q_digest_stored_arrival(spark, sf):
    logs = _written_logs(spark, sf, sort=True)
    parsed = parse_blocks(read_slow_log(spark, logs, INSTANCE))
    return _digest_columns(digest(_stored(spark, with_fingerprint(validate(parsed))), order="arrival"))


def q_digest_arrival(spark, sf):
    logs = _written_logs(spark, sf, sort=True)
    parsed = parse_blocks(read_slow_log(spark, logs, INSTANCE))
    return _digest_columns(digest(with_fingerprint(validate(parsed)), order="arrival", passes=1))


def q_digest_arrival_rotated(spark, sf):
    """Three files written one after the other, the oldest with the highest name."""
    root = f"{scratch(spark)}/logs"
    for n, name in enumerate(ROTATED):
        part = events(spark, sf).filter(F.col("event_id") % len(ROTATED) == n)
        write_logs(part.coalesce(1).sortWithinPartitions("event_id"), f"{root}/{name}")
    parsed = parse_blocks(read_slow_log(spark, root, INSTANCE, file_order="modified"))
    return _digest_columns(digest(with_fingerprint(validate(parsed)), order="arrival", passes=1))


def q_digest_single_file(spark, sf):
    records = slow_query_records(_text_blocks(spark, sf, "single_file"), profile="single_file")
    return _digest_columns(digest(records.filter(~F.col("rejected")), passes=1))


def q_merge_digest(spark, sf):
    """Two loads, by day of month, merged into the digest of both."""
    records = _fingerprinted(spark, sf)
    early = F.dayofmonth("ts") <= 15
    parts = (digest(records.filter(part), passes=1) for part in (early, ~early))
    return _digest_columns(merge_digest(*parts, passes=1))


def q_merge_digest_stored(spark, sf):
    """Two stored digests, merged in two passes."""
    records = _stored(spark, _fingerprinted(spark, sf))
    early = F.dayofmonth("ts") <= 15
    parts = (_stored(spark, digest(records.filter(part))) for part in (early, ~early))
    return _digest_columns(merge_digest(*parts))


def q_run_batch(spark, sf):
    """Two loads of log files into a digest table, then its merged digests."""
    root = scratch(spark)
    early = F.dayofmonth("ts") <= 15
    for name, part in (("a", early), ("b", ~early)):
        write_logs(events(spark, sf).filter(part), f"{root}/logs/{name}", 3)
        table = run_batch(spark, f"{root}/logs/{name}", INSTANCE, f"{root}/table")
    return _digest_columns(table.digests())


def q_occurrences(spark, sf):
    return occurrences(_fingerprinted(spark, sf)).select(
        "instance_id", "query_hash", _naive("ts").alias("ts")
    )


def _exploded_pages(documents: DataFrame) -> DataFrame:
    """One row per time."""
    return documents.select(
        "query_hash", "execution_count", "page", F.posexplode("timestamps").alias("pos", "ts")
    ).select("query_hash", "execution_count", "page", "pos", _naive("ts").alias("ts"))


def _stored(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Records written and read back: several rollups then share one parsing pass."""
    path = f"{scratch(spark)}/records"
    records.write.parquet(path)
    return spark.read.schema(records.schema).parquet(path)


def q_digest_documents(spark, sf):
    records = _stored(spark, _fingerprinted(spark, sf))
    return _exploded_pages(
        digest_documents(digest(records), occurrences(records), page_size=PAGE, every_page=("execution_count",))
    )


def q_digest_documents_arrival(spark, sf):
    logs = _written_logs(spark, sf, sort=True)
    records = _stored(
        spark, with_fingerprint(validate(parse_blocks(read_slow_log(spark, logs, INSTANCE))))
    )
    return _exploded_pages(
        digest_documents(
            digest(records, order="arrival"),
            first_arrivals(records),
            page_size=PAGE,
            order="arrival",
            every_page=("execution_count",),
        )
    )


def q_expire_digest(spark, sf):
    records = _fingerprinted(spark, sf)
    return _digest_columns(expire_digest(digest(records, passes=1), EXPIRE_DAYS, as_of=AS_OF))


def q_expired_digest(spark, sf):
    records = _fingerprinted(spark, sf)
    gone = expired_digest(digest(records, passes=1), EXPIRE_DAYS, as_of=AS_OF)
    return gone.agg(F.count(F.lit(1)).alias("expired"))


def _stored_digest(spark, sf) -> str:
    path = f"{scratch(spark)}/digest"
    write_digest(digest(_fingerprinted(spark, sf), passes=1), path)
    return path


def q_write_digest(spark, sf):
    return _digest_columns(read_digest(spark, _stored_digest(spark, sf)))


def q_digest_stats(spark, sf):
    return digest_stats(spark, _stored_digest(spark, sf)).select(
        "document_count", (F.col("store_size_bytes") > 0).alias("has_bytes")
    )


def q_upsert_actions(spark, sf):
    """The JSON actions, read back field by field."""
    actions = to_upsert_actions(_fingerprinted(spark, sf))
    shape = (
        "_op_type string, _index string, _id string, retry_on_conflict bigint, "
        "script struct<params: struct<timestamp: string, query_time: double>>, "
        "upsert struct<query: string, normalized_query: string, user: struct<name: string>, "
        "rows_examined: bigint, execution_count: bigint, timestamps: array<string>, "
        "last_seen: string>"
    )
    return actions.select(F.from_json("value", shape).alias("a")).select(
        F.col("a._op_type").alias("op_type"),
        F.col("a._index").alias("index_name"),
        F.col("a._id").alias("id"),
        F.col("a.script.params.timestamp").alias("param_timestamp"),
        F.col("a.script.params.query_time").alias("param_query_time"),
        F.col("a.upsert.query").alias("query"),
        F.col("a.upsert.normalized_query").alias("normalized_query"),
        F.col("a.upsert.user.name").alias("user_name"),
        F.col("a.upsert.rows_examined").alias("rows_examined"),
        F.col("a.upsert.execution_count").alias("execution_count"),
        F.col("a.upsert.timestamps")[0].alias("timestamps"),
        F.col("a.upsert.last_seen").alias("last_seen"),
        F.col("a.retry_on_conflict").alias("retries"),
    )


def q_upsert_fields(spark, sf):
    """Every field of the actions with their script inline."""
    actions = to_upsert_actions(_fingerprinted(spark, sf), inline=True)
    shape = (
        "_op_type string, _index string, _id string, retry_on_conflict bigint, script struct<source: string,"
        " lang: string, params: struct<timestamp: string, query_time: double>>, upsert struct<query: string,"
        " normalized_query: string, query_hash: string, timestamp: string, user: struct<name: string,"
        " host: string>, query_time: double, lock_time: double, rows_examined: bigint, rows_sent: bigint,"
        " execution_count: bigint, timestamps: array<string>, max_query_time: double, last_seen: string,"
        " instance_id: string>"
    )
    a = actions.select(F.from_json("value", shape).alias("a"))
    return a.select(
        F.col("a._op_type").alias("op_type"),
        F.col("a._index").alias("index_name"),
        F.col("a._id").alias("id"),
        F.col("a.retry_on_conflict").alias("retries"),
        (F.length("a.script.source") > 0).alias("has_source"),
        F.col("a.script.lang").alias("lang"),
        F.col("a.script.params.timestamp").alias("param_timestamp"),
        F.col("a.script.params.query_time").alias("param_query_time"),
        F.array_join("a.upsert.timestamps", ",").alias("timestamps"),
        F.col("a.upsert.user.name").alias("user_name"),
        F.col("a.upsert.user.host").alias("user_host"),
        F.col("a.upsert.timestamp").alias("first_seen"),
        *(
            F.col(f"a.upsert.{c}")
            for c in (
                "query",
                "normalized_query",
                "query_hash",
                "query_time",
                "lock_time",
                "rows_examined",
                "rows_sent",
                "execution_count",
                "max_query_time",
                "last_seen",
                "instance_id",
            )
        ),
    )


def q_upsert_applied(spark, sf):
    """What an index holds after all actions in order of time, by one aggregate over their JSON."""
    shape = (
        "_index string, _id string, script struct<params: struct<timestamp: string, query_time: double>>,"
        " upsert struct<query: string, normalized_query: string, user: struct<name: string>,"
        " query_time: double, rows_examined: bigint, execution_count: bigint, timestamps: array<string>>"
    )
    actions = to_upsert_actions(_fingerprinted(spark, sf)).select(F.from_json("value", shape).alias("a"))
    a = actions.select("a._index", "a._id", "a.upsert", "a.script.params.timestamp", "a.script.params.query_time")
    # The first action stores its document; each later one adds what the script does.
    done = a.groupBy("_index", "_id").agg(
        F.min_by("upsert", "timestamp").alias("first"),
        (F.count(F.lit(1)) - 1).alias("later"),
        F.count_distinct("timestamp").alias("n_timestamps"),
        F.max("query_time").alias("max_query_time"),
        F.max("timestamp").alias("last_seen"),
    )
    return done.select(
        F.col("_index").alias("index_name"),
        F.col("_id").alias("id"),
        "first.query",
        "first.normalized_query",
        F.col("first.user.name").alias("user_name"),
        "first.query_time",
        "first.rows_examined",
        (F.col("first.execution_count") + F.col("later")).alias("execution_count"),
        "n_timestamps",
        "max_query_time",
        "last_seen",
    )


def q_load_rejects(spark, sf):
    """Rejected blocks per reason as two loads have counted them, and what their BATCH rows say."""
    root = scratch(spark)
    table = DigestTable(spark, f"{root}/table")
    records = _loads(spark, sf)
    for version in range(2):
        table.load(version, records.filter(F.col("event_id") % 2 == version), index_prefix=PREFIX)
    sizes = table.batches().select(F.lit("valid").alias("reject_reason"), F.col("size").alias("blocks"))
    valid = sizes.groupBy("reject_reason").agg(F.sum("blocks").alias("blocks"))
    return table.rejects().unionByName(valid)


def q_stream_digest(spark, sf):
    """Five files in five micro-batches with compactions in between."""
    logs = _written_logs(spark, sf)
    root = scratch(spark)
    source = stream_slow_log(spark, logs, INSTANCE, max_files_per_trigger=1)
    digest_stream(
        source, f"{root}/table", f"{root}/checkpoint", compact_every=2, available_now=True
    ).awaitTermination()
    return _digest_columns(DigestTable(spark, f"{root}/table").digests())


# ---------------------------------------------------------------- a table over many loads


def _loads(spark: SparkSession, sf: str) -> DataFrame:
    """Judged records with ``event_id``, written once; a load takes some of them."""
    text = log_blocks(events(spark, sf)).select(F.lit(INSTANCE).alias("instance_id"), "event_id", "text")
    return _stored(spark, slow_query_records(split_blocks(text, "text")))


def _loaded(spark: SparkSession, parts: list[DataFrame]) -> DigestTable:
    table = DigestTable(spark, f"{scratch(spark)}/table")
    for version, part in enumerate(parts):
        table.write(version, part, index_prefix=PREFIX)
    return table


def _expired_table(spark, sf):
    records = _loads(spark, sf)
    early = F.dayofmonth("ts") <= 15
    table = _loaded(spark, [records.filter(early), records.filter(~early)])
    return records, table, table.expire(EXPIRE_DAYS, as_of=AS_OF)


def q_expire_table(spark, sf):
    """Two loads, retention, and a load in which some of the removed fingerprints come back."""
    records, table, _ = _expired_table(spark, sf)
    back = (F.col("event_id") % 7 == 0) & (F.dayofmonth("ts") <= 15)
    table.write(2, records.filter(back), index_prefix=PREFIX)
    return _digest_columns(table.digests())


def q_expire_table_counts(spark, sf):
    _, table, gone = _expired_table(spark, sf)
    left = table.records().agg(F.count(F.lit(1)).alias("records_left"))
    return left.select(
        F.lit(gone.digests).cast("bigint").alias("digests"),
        F.lit(gone.occurrences).cast("bigint").alias("occurrences"),
        F.lit(gone.records).cast("bigint").alias("records"),
        "records_left",
    )


def q_table_occurrences(spark, sf):
    """Nine loads, the first eight of them folded into one run."""
    records = _loads(spark, sf)
    table = _loaded(spark, [records.filter(F.col("event_id") % 9 == n) for n in range(9)])
    table.compact(8)
    return table.occurrences().select("instance_id", "query_hash", _naive("ts").alias("ts"))


def q_two_writers(spark, sf):
    """Two writers claim one table at once; the one that gets it loads, the other is refused."""
    table = DigestTable(spark, f"{scratch(spark)}/table")

    def claimed(writer: str) -> bool:
        try:
            table.claim(writer)
        except RuntimeError:
            return False
        return True

    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(claimed, ("a", "b")))
    if sum(won) == 1:
        table.write(0, _loads(spark, sf), index_prefix=PREFIX)
    return _digest_columns(table.digests(), F.lit(won.count(False)).cast("bigint").alias("refused"))


def q_stream_replay(spark, sf):
    """The last batch of a stream loses its commit and runs again."""
    logs = _written_logs(spark, sf)
    root = scratch(spark)

    def drain():
        source = stream_slow_log(spark, logs, INSTANCE, max_files_per_trigger=2)
        digest_stream(
            source, f"{root}/table", f"{root}/checkpoint", compact_every=2, available_now=True
        ).awaitTermination()

    drain()
    table = DigestTable(spark, f"{root}/table")
    forget_commit(spark, f"{root}/checkpoint", table.newest())
    drain()
    return _digest_columns(table.digests())


# ---------------------------------------------------------------- run statistics


def q_run_summary(spark, sf):
    df = batches.run_summary(_batch_records(spark, sf))
    return _rounded(df, "total_duration", "average_batch_duration")


def q_batch_summary(spark, sf):
    return _rounded(
        batches.batch_summary(_batch_records(spark, sf)),
        "success_rate",
        "total_processing_time",
        "average_batch_size",
        "average_batch_time",
        "documents_per_second",
    )


def q_error_distribution(spark, sf):
    return batches.error_distribution(_batch_records(spark, sf))


def q_error_list(spark, sf):
    return batches.error_list(_batch_records(spark, sf), "ts")


def q_batch_running_totals(spark, sf):
    return batches.batch_running_totals(_batch_records(spark, sf)).select(
        "job", "batch_id", "success_count", "error_count"
    )


def q_batch_rolling_mean(spark, sf):
    df = batches.batch_rolling_mean(_batch_records(spark, sf))
    return _rounded(df.select("job", "batch_id", "rolling_mean"), "rolling_mean")


def _sparse_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batch numbers so far apart that every slot holds one row at most."""
    return _batch_records(spark, sf).withColumn("batch_id", F.col("batch_id") * SPARSE - 10**15)


def q_batch_running_totals_sparse(spark, sf):
    return batches.batch_running_totals(_sparse_batches(spark, sf)).select(
        "job", "batch_id", "success_count", "error_count"
    )


def q_batch_rolling_mean_sparse(spark, sf):
    df = batches.batch_rolling_mean(_sparse_batches(spark, sf))
    return _rounded(df.select("job", "batch_id", "rolling_mean"), "rolling_mean")


def q_batch_rolling_mean_short(spark, sf):
    df = batches.batch_rolling_mean(_batch_records(spark, sf), "size", size=5, full_only=False)
    return _rounded(df.select("job", "batch_id", "rolling_mean"), "rolling_mean")


def q_chunk_status(spark, sf):
    return chunks.status_counts(_chunk_records(spark, sf))


def q_failed_chunks(spark, sf):
    return chunks.failed_chunks(_chunk_records(spark, sf))


def q_retryable_chunks(spark, sf):
    return chunks.retryable_chunks(_chunk_records(spark, sf))


def q_chunk_progress(spark, sf):
    df = chunks.chunk_progress(_chunk_records(spark, sf))
    return _rounded(df, "average_chunk_seconds")


def q_chunk_duration(spark, sf):
    return chunks.with_duration(_chunk_records(spark, sf)).select("chunk_id", "duration_seconds")


def q_recent_rate(spark, sf):
    return _rounded(chunks.recent_rate(_chunk_records(spark, sf)), "bytes_per_second")


def q_run_rate(spark, sf):
    as_of = F.lit(dt.datetime(2002, 1, 1))
    return _rounded(chunks.run_rate(_chunk_records(spark, sf), as_of=as_of), "bytes_per_second")


def q_completion_estimate(spark, sf):
    df = chunks.completion_estimate(_chunk_records(spark, sf), TOTAL_BYTES, as_of=AS_OF)
    return df.select(
        "processed_bytes",
        "remaining_bytes",
        F.round("bytes_per_second", 4).alias("bytes_per_second"),
        _naive(F.date_trunc("second", "estimated_completion")).alias("estimated_completion"),
    )


def q_trailing_trend(spark, sf):
    df = series.trailing_trend(
        events(spark, sf), "event_type", "ts", "value", minutes=TREND_MINUTES, as_of=AS_OF
    )
    return _rounded(
        df, "duration_minutes", "growth", "growth_per_minute", "average", "peak", "current"
    )


def q_fingerprint_trend(spark, sf):
    """Query times per fingerprint over the last ten days of the log."""
    records = _fingerprinted(spark, sf).select("query_hash", "ts", "query_time", "seq")
    df = series.trailing_trend(
        records,
        "query_hash",
        "ts",
        "query_time",
        minutes=TREND_MINUTES,
        as_of=AS_OF,
        tie="seq",
    )
    return _rounded(
        df, "duration_minutes", "growth", "growth_per_minute", "average", "peak", "current"
    )


def q_series_growth(spark, sf):
    df = series.series_growth(events(spark, sf), "event_type", "ts", "value")
    return _rounded(df, "growth")


def q_threshold_status(spark, sf):
    return events(spark, sf).select(
        "event_id", series.threshold_status("value", 51.2, 76.8).alias("status")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_blocks": q_parse_blocks,
    "read_slow_log": q_read_slow_log,
    "parse_compat_rows": q_parse_compat_rows,
    "parse_single_file": q_parse_single_file,
    "valid_queries": q_valid_queries,
    "valid_single_file": q_valid_single_file,
    "rejects": q_rejects,
    "reject_summary": q_reject_summary,
    "parse_variants": q_parse_variants,
    "parse_variants_single": q_parse_variants_single,
    "read_variants": q_read_variants,
    "read_variants_single": q_read_variants_single,
    "variant_rejects": q_variant_rejects,
    "variant_digest": q_variant_digest,
    "variant_digest_single": q_variant_digest_single,
    "collapse_blanks": _over_documents(N.collapse_blanks),
    "normalize_numbers": _over_documents(N.mask_numbers),
    "normalize_strings": _over_documents(N.mask_strings),
    "normalize_in": q_normalize_in,
    "strip_meta": q_strip_meta,
    "last_statement": q_last_statement,
    "query_fingerprint": q_query_fingerprint,
    "query_fingerprint_rehash": q_query_fingerprint_rehash,
    "compress_oversized": q_compress_oversized,
    "digest": q_digest,
    "digest_arrival": q_digest_arrival,
    "digest_stored": q_digest_stored,
    "digest_stored_arrival": q_digest_stored_arrival,
    "digest_arrival_rotated": q_digest_arrival_rotated,
    "digest_single_file": q_digest_single_file,
    "merge_digest": q_merge_digest,
    "merge_digest_stored": q_merge_digest_stored,
    "run_batch": q_run_batch,
    "digest_occurrences": q_occurrences,
    "digest_documents": q_digest_documents,
    "digest_documents_arrival": q_digest_documents_arrival,
    "expire_digest": q_expire_digest,
    "expired_digest": q_expired_digest,
    "write_digest": q_write_digest,
    "digest_stats": q_digest_stats,
    "upsert_actions": q_upsert_actions,
    "upsert_fields": q_upsert_fields,
    "upsert_applied": q_upsert_applied,
    "load_rejects": q_load_rejects,
    "stream_digest": q_stream_digest,
    "expire_table": q_expire_table,
    "expire_table_counts": q_expire_table_counts,
    "table_occurrences": q_table_occurrences,
    "two_writers": q_two_writers,
    "stream_replay": q_stream_replay,
    "run_summary": q_run_summary,
    "batch_summary": q_batch_summary,
    "error_distribution": q_error_distribution,
    "error_list": q_error_list,
    "batch_running_totals": q_batch_running_totals,
    "batch_rolling_mean": q_batch_rolling_mean,
    "batch_running_totals_sparse": q_batch_running_totals_sparse,
    "batch_rolling_mean_sparse": q_batch_rolling_mean_sparse,
    "batch_rolling_mean_short": q_batch_rolling_mean_short,
    "chunk_status": q_chunk_status,
    "failed_chunks": q_failed_chunks,
    "retryable_chunks": q_retryable_chunks,
    "chunk_progress": q_chunk_progress,
    "chunk_duration": q_chunk_duration,
    "recent_rate": q_recent_rate,
    "run_rate": q_run_rate,
    "completion_estimate": q_completion_estimate,
    "trailing_trend": q_trailing_trend,
    "fingerprint_trend": q_fingerprint_trend,
    "series_growth": q_series_growth,
    "threshold_status": q_threshold_status,
}
