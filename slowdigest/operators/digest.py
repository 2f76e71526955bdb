"""Fingerprints, digests and occurrence times.

A digest is one row per fingerprint and instance.  Every aggregate in it merges
from partial results, so a fingerprint that owns a third of the log is reduced
inside each scan task before anything is shuffled.  The distinct occurrence times
cannot be reduced that way; they form a long table keyed by fingerprint *and*
time, which spreads a hot fingerprint over all tasks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slowdigest.functions.normalize import normalize_query
from slowdigest.schema import DIGEST_SCHEMA, DOCUMENT_SCHEMA, OCCURRENCE_SCHEMA

ORDERS = ("time", "arrival")
DEFAULT_INDEX_PREFIX = "mysql-slowlog"
KEYS = ("query_hash", "instance_id")
#: Bits of the set that tells candidates for a body; its words take 16 bytes each, 4 MB in all.
FILTER_BITS = 1 << 24
_BODY = ("timestamp", "user", "query_time", "lock_time", "rows_examined", "rows_sent", "query")


def check_order(order: str) -> None:
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, not {order!r}")


def index_name(prefix: str = DEFAULT_INDEX_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.lit("-"), F.coalesce(F.col("instance_id"), F.lit("")))


def with_fingerprint(df: DataFrame, *, rehash: bool = False) -> DataFrame:
    """Add ``normalized_query`` and ``query_hash``.

    The hash reads the projected text, so the regex chain runs once per row.
    ``rehash`` hashes the text normalised twice (``single_file`` profile).
    """
    text = F.col("normalized_query")
    return df.withColumn("normalized_query", normalize_query(F.col("query"))).withColumn(
        "query_hash", F.md5(normalize_query(text) if rehash else text)
    )


def _check_passes(passes: int, bits: int) -> None:
    if passes not in (1, 2):
        raise ValueError("passes must be 1 or 2")
    if bits < 64 or bits & (bits - 1):
        raise ValueError("filter_bits must be a power of two, 64 at least")


def _bit(key: Column, first: Column, bits: int) -> tuple[Column, Column]:
    """Where a key and a rank stand in a bit set: number of the 64-bit word, and place in it."""
    at = F.xxhash64(key, first).bitwiseAND(F.lit(bits - 1).cast("bigint"))
    return F.shiftright(at, 6), at.bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def _candidates(df: DataFrame, winners: DataFrame, first: Column, bits: int) -> DataFrame:
    """Rows of ``df`` that may give a body: those with the rank of their key's winner, and chance hits.

    The winners become a bit set of ``bits`` bits, of which at most ``bits / 64`` words of 16 bytes are broadcast
    however many keys there are.  Beyond as many keys as bits it keeps most rows, which costs time only.
    """
    word, place = _bit(F.col("_key"), F.col("_first"), bits)
    one = F.lit(1).cast("bigint")
    words = winners.groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", one, place)).alias("_bits")
    )
    word, place = _bit(F.col("_key"), first, bits)
    marked = df.withColumn("_at", word).withColumn("_place", place)
    return marked.join(F.broadcast(words), F.col("_at") == F.col("_word")).filter(
        F.bit_get("_bits", "_place") == 1
    )


def _rolled(
    df: DataFrame, keys: tuple[str, ...], totals: DataFrame, first: Column, body: Column, rank: Column, bits: int
) -> DataFrame:
    """``totals`` with the fields of ``body`` from each key's row of lowest ``rank``.

    ``totals`` has ``_key`` and ``_first``, the lowest ``first`` of the key; ``rank`` must start with it.  Only
    candidates are read for bodies, so no task sorts or sends bodies that cannot win.
    """
    # Behind a generator both uses ask for all columns, so one exchange serves the two.
    fields = F.struct(*(c for c in totals.columns if c != "_key"))
    totals = totals.select("_key", F.inline(F.array(fields)))
    found = (
        _candidates(df, totals, first, bits).groupBy("_key").agg(F.min_by(body, rank).alias("body"))
    )
    # A struct of the keys is never null, so keys with a null part join like others.
    return totals.join(found, "_key", "left").select("*", *(F.col(f"_key.{k}").alias(k) for k in keys))


def digest(
    df: DataFrame,
    *,
    index_prefix: str = DEFAULT_INDEX_PREFIX,
    order: str = "time",
    passes: int = 2,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Roll fingerprinted records up to ``DIGEST_SCHEMA``.

    With ``order="time"`` the body is the earliest record's and ``last_seen`` the
    latest time.  ``order="arrival"`` takes both by ``seq`` instead.

    Two passes: the first adds up numbers and times per fingerprint, which a hash
    aggregate does without sorting and which shuffles no text; the second fetches the
    bodies of the winners.  ``df`` is thus evaluated twice: give it stored records.
    ``passes=1`` takes the bodies along in one aggregate instead, which sorts the
    records in every task but reads them once: for small logs parsed on the fly.
    """
    check_order(order)
    _check_passes(passes, filter_bits)
    by_time = order == "time"
    body = F.struct(F.col("ts").alias("timestamp"), *_BODY[1:])
    rank = F.struct(F.col("ts").isNull(), "ts", "seq") if by_time else F.col("seq")
    if passes == 1:
        rolled = df.groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("execution_count"),
            F.max("query_time").alias("max_query_time"),
            (F.max("ts") if by_time else F.max_by("ts", "seq")).alias("last_seen"),
            F.min_by(body, rank).alias("body"),
        )
    else:
        keyed = df.withColumn("_key", F.struct(*KEYS))
        counts = (F.count(F.lit(1)).alias("execution_count"), F.max("query_time").alias("max_query_time"))
        if by_time:
            first = F.col("ts")
            totals = keyed.groupBy("_key").agg(
                *counts, F.max("ts").alias("last_seen"), F.min("ts").alias("_first")
            )
        else:
            # Rows of one split stand in order of a number; only splits are ranked by name.
            first = F.struct("seq.modified", "seq.file", "seq.start")
            per_split = keyed.groupBy("_key", first.alias("_split")).agg(
                *counts, F.max_by("ts", "seq.row").alias("ts")
            )
            totals = per_split.groupBy("_key").agg(
                F.sum("execution_count").alias("execution_count"),
                F.max("max_query_time").alias("max_query_time"),
                F.max_by("ts", "_split").alias("last_seen"),
                F.min("_split").alias("_first"),
            )
        rolled = _rolled(keyed, KEYS, totals, first, body, rank, filter_bits)
    # The normalised text follows from the body's query, so it is not shuffled.
    return rolled.select(
        index_name(index_prefix).alias("index_name"),
        *KEYS,
        "execution_count",
        "max_query_time",
        "last_seen",
        "body.*",
        normalize_query(F.col("body.query")).alias("normalized_query"),
    ).to(DIGEST_SCHEMA)


def merge_digests(
    df: DataFrame,
    *,
    generation: str,
    order: str = "time",
    passes: int = 2,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Re-aggregate digest rows; lower ``generation`` values arrived earlier.

    ``passes`` as in ``digest``: with two, bodies that do not win are neither sorted nor sent.
    """
    check_order(order)
    _check_passes(passes, filter_bits)
    by_time = order == "time"
    keys = (*KEYS, "index_name")
    keyed = df.withColumn("_key", F.struct(*keys))
    if by_time:
        first, last = F.col("timestamp"), F.max("last_seen")
        rank = F.struct(F.col("timestamp").isNull(), "timestamp", generation)
    else:
        first, last = F.col(generation), F.max_by("last_seen", generation)
        rank = F.col(generation)
    body = F.struct(*_BODY, "normalized_query")
    counts = (
        F.sum("execution_count").alias("execution_count"),
        F.max("max_query_time").alias("max_query_time"),
        last.alias("last_seen"),
    )
    if passes == 1:
        rolled = df.groupBy(*keys).agg(*counts, F.min_by(body, rank).alias("body"))
    else:
        totals = keyed.groupBy("_key").agg(*counts, F.min(first).alias("_first"))
        rolled = _rolled(keyed, keys, totals, first, body, rank, filter_bits)
    return rolled.select(
        "index_name", *KEYS, "execution_count", "max_query_time", "last_seen", "body.*"
    ).to(DIGEST_SCHEMA)


def merge_digest(
    state: DataFrame, new: DataFrame, *, order: str = "time", passes: int = 2
) -> DataFrame:
    """Upsert ``new`` digests into ``state``: insert unseen keys, merge the others."""
    both = state.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    return merge_digests(both, generation="_gen", order=order, passes=passes)


def occurrences(df: DataFrame) -> DataFrame:
    """Distinct times per fingerprint, one row each.

    Works on fingerprinted records and on earlier results (union, then distinct).
    """
    return (
        df.filter(F.col("ts").isNotNull())
        .select("instance_id", "query_hash", "ts")
        .distinct()
        .to(OCCURRENCE_SCHEMA)
    )


def first_arrivals(df: DataFrame) -> DataFrame:
    """``occurrences`` with the earliest ``seq`` of each time."""
    return (
        df.filter(F.col("ts").isNotNull())
        .groupBy("query_hash", "instance_id", "ts")
        .agg(F.min("seq").alias("seq"))
    )


def _positions(times: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """Times with their row number in a slot, and the size of each slot; both from one exchange.

    A slot is a minute, or an input split for ``order="arrival"``: no task ever sorts one
    fingerprint's whole list.
    """
    if order == "time":
        # As a struct it is never null, which leaves no filter in only one use of the exchange.
        slot, rank = F.struct(F.date_trunc("minute", F.col("ts"))), "ts"
    else:
        slot, rank = F.struct("seq.modified", "seq.file", "seq.start"), "seq"
    # A struct of the keys is never null, so keys with a null part join like others.
    slotted = times.select(F.struct(*KEYS).alias("_key"), slot.alias("_slot"), *dict.fromkeys([rank, "ts"]))
    inside = W.partitionBy("_key", "_slot").orderBy(rank)
    numbered = slotted.withColumn("_at", F.row_number().over(inside))
    # Both numbers are the size; asking for either column keeps the two uses of the exchange alike.
    size = F.greatest(F.max("_at"), F.count("ts"))
    return numbered, numbered.groupBy("_key", "_slot").agg(size.alias("_size"))


def _earlier(sizes: DataFrame) -> DataFrame:
    before = W.partitionBy("_key").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("_key", "_slot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))


def _check_pages(page_size: int, order: str) -> None:
    check_order(order)
    if page_size <= 0:
        raise ValueError("page_size must be positive")


def paged_timestamps(
    times: DataFrame, *, page_size: int = 10_000, order: str = "time"
) -> DataFrame:
    """Occurrence times as arrays, ``page_size`` per row and no longer.

    Pages 0, 1, 2… of a fingerprint in sequence are the full list, ascending by
    time, or by arrival for a ``first_arrivals`` input with ``order="arrival"``.
    Positions come from counts per slot plus a row number inside the slot.
    """
    _check_pages(page_size, order)
    numbered, sizes = _positions(times, order)
    placed = numbered.join(_earlier(sizes), ["_key", "_slot"]).withColumn(
        "_at", F.col("_before") + F.col("_at") - 1
    )
    return (
        placed.groupBy("_key", F.floor(F.col("_at") / page_size).alias("page"))
        .agg(_in_order(F.collect_list(F.struct("_at", "ts"))).alias("timestamps"))
        .select(*(F.col(f"_key.{k}").alias(k) for k in KEYS), "page", "timestamps")
    )


def _in_order(listed: Column) -> Column:
    return F.transform(F.array_sort(listed), lambda x: x["ts"])


def digest_documents(
    digests: DataFrame,
    times: DataFrame,
    *,
    page_size: int = 10_000,
    order: str = "time",
    every_page: tuple[str, ...] = (),
) -> DataFrame:
    """Digests with their occurrence times attached (``DOCUMENT_SCHEMA``).

    Most fingerprints give one row (page 0); one with more than ``page_size``
    times gives one row per page.  Page 0 holds the digest; later pages hold its key
    and their times only, so a long statement is not stored once a page.  Fields named in
    ``every_page`` stand on later pages too: they ride with every slot, so name short ones.

    Each input is read once: the digest rides with the first slot of its times to
    page 0.  Times without a digest give no row.
    """
    _check_pages(page_size, order)
    fields = [n for n in DIGEST_SCHEMA.names if n not in KEYS]
    if not set(every_page) <= set(fields):
        raise ValueError(f"every_page must name fields of a digest, not {every_page!r}")
    numbered, sizes = _positions(times, order)
    own = digests.select(F.struct(*KEYS).alias("_key"), F.struct(*fields).alias("_body"))
    # One row per slot of a digest, or one without a slot; the first carries the body.
    slots = own.join(_earlier(sizes), "_key", "left").withColumns(
        {
            "_body": F.when(F.coalesce("_before", F.lit(0)) == 0, F.col("_body")),
            **{f"_every_{n}": F.col("_body")[n] for n in every_page},
        }
    )
    placed = slots.join(numbered, ["_key", "_slot"], "left").withColumn(
        "_at", F.coalesce(F.col("_before") + F.col("_at") - 1, F.lit(0))
    )
    time = F.when(F.col("ts").isNotNull(), F.struct("_at", "ts"))
    carried = F.when(F.col("_at") == 0, F.col("_body"))
    pages = placed.groupBy("_key", F.floor(F.col("_at") / page_size).alias("page")).agg(
        F.any_value(carried, F.lit(True)).alias("_body"),
        *(F.any_value(f"_every_{n}", F.lit(True)).alias(f"_every_{n}") for n in every_page),
        _in_order(F.collect_list(time)).alias("timestamps"),
    )
    body = [F.col(f"_every_{n}" if n in every_page else f"_body.{n}").alias(n) for n in fields]
    return pages.select(
        *(F.col(f"_key.{k}").alias(k) for k in KEYS), *body, "page", "timestamps"
    ).to(DOCUMENT_SCHEMA)


def retention_cutoff(days: int, as_of: datetime | Column) -> Column:
    """The latest ``last_seen`` that is too old."""
    if days < 0:
        raise ValueError("days must not be negative")
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return now - F.make_interval(days=F.lit(days))


def _expired(days: int, as_of: datetime | Column) -> Column:
    return F.coalesce(F.col("last_seen") <= retention_cutoff(days, as_of), F.lit(False))


def expire_digest(
    df: DataFrame,
    days: int = 30,
    *,
    as_of: datetime | Column,
    observation: Observation | None = None,
) -> DataFrame:
    """Digests that stay: ``last_seen`` missing or later than ``as_of - days``.

    An ``observation`` receives ``kept`` and ``expired`` counts when the result
    is written, without a second pass.
    """
    gone = _expired(days, as_of)
    if observation is not None:
        df = df.observe(
            observation,
            F.count_if(~gone).alias("kept"),
            F.count_if(gone).alias("expired"),
        )
    return df.filter(~gone)


def expired_digest(df: DataFrame, days: int = 30, *, as_of: datetime | Column) -> DataFrame:
    """The digests that ``expire_digest`` removes."""
    return df.filter(_expired(days, as_of))
