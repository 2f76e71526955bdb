from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from slowdigest.operators.digest import (
    digest,
    digest_documents,
    expire_digest,
    expired_digest,
    first_arrivals,
    merge_digest,
    merge_digests,
    occurrences,
    paged_timestamps,
    with_fingerprint,
)
from slowdigest.schema import DIGEST_SCHEMA, DOCUMENT_SCHEMA, PARSED_SCHEMA

DAY = dt.datetime(2024, 1, 1)


def record(i, minute, query, query_time=1.0, file="f"):
    ts = None if minute is None else DAY + dt.timedelta(minutes=minute)
    raw = None if ts is None else ts.isoformat()
    return ("db", file, (None, file, 0, i), raw, ts, (f"u{i}", "h"), query_time, 0.5, i, i, query)


def records(spark, rows):
    return with_fingerprint(spark.createDataFrame(rows, PARSED_SCHEMA))


SMALL = [
    record(0, 30, "SELECT a FROM t WHERE x = 1", 2.0),
    record(1, 10, "SELECT a FROM t WHERE x = 2", 5.0),
    record(2, 30, "SELECT a FROM t WHERE x = 3", 1.0),
    record(3, 20, "SELECT b FROM t", 1.5),
]


def by_query(df):
    return {r.normalized_query: r for r in df.collect()}


def test_digest_by_time_and_by_arrival(spark):
    timed = by_query(digest(records(spark, SMALL)))
    a = timed["SELECT a FROM t WHERE x = ?"]
    assert (a.execution_count, a.max_query_time) == (3, 5.0)
    assert (a.query, a.user.name, a.rows_examined) == ("SELECT a FROM t WHERE x = 2", "u1", 1)
    assert (a.timestamp, a.last_seen) == (DAY + dt.timedelta(minutes=10), DAY + dt.timedelta(minutes=30))
    assert a.index_name == "mysql-slowlog-db"
    arrived = by_query(digest(records(spark, SMALL), order="arrival", index_prefix="p"))
    a = arrived["SELECT a FROM t WHERE x = ?"]
    assert (a.query, a.query_time, a.index_name) == ("SELECT a FROM t WHERE x = 1", 2.0, "p-db")
    assert a.last_seen == DAY + dt.timedelta(minutes=30)
    with pytest.raises(ValueError):
        digest(records(spark, SMALL), order="random")


@pytest.mark.parametrize("bits", [64, 1 << 16])
@pytest.mark.parametrize("order", ["time", "arrival"])
def test_two_passes_equal_one(spark, order, bits):
    """Ties, missing times, missing instances, rows of several files and splits, and a saturated filter."""
    rng = random.Random(bits)
    rows = []
    for i in range(300):
        minute = None if rng.random() < 0.2 else rng.randrange(12)
        row = list(record(i, minute, f"SELECT {rng.choice('abcdef')} FROM t", rng.random(), rng.choice("xyz")))
        row[0] = rng.choice(["db", "other", None])
        row[2] = (rng.choice([None, DAY]), rng.choice(["x", "y", None]), rng.choice([0, 64, None]), i)
        rows.append(tuple(row))
    df = records(spark, rows).repartition(5)
    one, two = digest(df, order=order, passes=1), digest(df, order=order, filter_bits=bits)
    assert sorted(map(repr, two.collect())) == sorted(map(repr, one.collect())) and one.count() > 10
    parts = [digest(df.filter(F.col("seq.row") % 3 == n), order=order, passes=1).withColumn("g", F.lit(n)) for n in range(3)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    one = merge_digests(whole, generation="g", order=order, passes=1).collect()
    two = merge_digests(whole, generation="g", order=order, filter_bits=bits).collect()
    assert sorted(map(repr, two)) == sorted(map(repr, one))


def test_digest_refuses_odd_settings(spark):
    df = records(spark, SMALL)
    for wrong in ({"passes": 3}, {"filter_bits": 100}, {"filter_bits": 32}):
        with pytest.raises(ValueError):
            digest(df, **wrong)
    assert digest(df.limit(0)).collect() == []


def test_digest_schema(spark):
    df = digest(records(spark, SMALL))
    assert df.schema.simpleString() == DIGEST_SCHEMA.simpleString()
    docs = digest_documents(df, occurrences(records(spark, SMALL)))
    assert docs.schema.simpleString() == DOCUMENT_SCHEMA.simpleString()


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_merge_equals_one_digest(spark, order):
    rng = random.Random(5)
    rows = [
        record(i, rng.randrange(500), f"SELECT {rng.choice('abc')} FROM t WHERE x = {i}", rng.random())
        for i in range(60)
    ]
    whole = digest(records(spark, rows), order=order)
    merged = None
    for start in range(0, 60, 20):
        part = digest(records(spark, rows[start : start + 20]), order=order)
        merged = part if merged is None else merge_digest(merged, part, order=order)
    assert sorted(merged.collect()) == sorted(whole.collect())


def test_merge_inserts_and_keeps_unseen_keys(spark):
    df = records(spark, SMALL)
    a, b = df.filter("query like '%x =%'"), df.filter("query not like '%x =%'")
    assert sorted(merge_digest(digest(a), digest(b)).collect()) == sorted(digest(df).collect())


def test_records_without_time(spark):
    """They can be valid in the single_file profile: counted, but with no occurrence time."""
    df = records(spark, [record(0, None, "SELECT 1"), record(1, 5, "SELECT 2"), record(2, None, "SELECT x")])
    rows = by_query(digest(df))
    assert rows["SELECT ?"].execution_count == 2
    assert rows["SELECT ?"].last_seen == DAY + dt.timedelta(minutes=5)
    assert occurrences(df).count() == 1
    docs = {r.normalized_query: r for r in digest_documents(digest(df), occurrences(df)).collect()}
    assert docs["SELECT x"].timestamps == [] and docs["SELECT x"].page == 0


def test_occurrences_are_distinct(spark):
    assert occurrences(records(spark, SMALL)).count() == 3


@pytest.mark.parametrize("page_size", [1, 3, 7, 1000])
def test_pages_hold_every_time_once_and_in_order(spark, page_size):
    rng = random.Random(page_size)
    rows = [record(i, rng.randrange(40) / 3, "SELECT hot") for i in range(120)]
    rows += [record(i, i, f"SELECT c{i} FROM t") for i in range(5)]
    df = records(spark, rows)
    for order, times in (("time", occurrences(df)), ("arrival", first_arrivals(df))):
        pages = paged_timestamps(times, page_size=page_size, order=order).collect()
        assert all(0 < len(p.timestamps) <= page_size for p in pages)
        for key in {p.query_hash for p in pages}:
            mine = sorted((p for p in pages if p.query_hash == key), key=lambda p: p.page)
            assert [p.page for p in mine] == list(range(len(mine)))
            got = [t for p in mine for t in p.timestamps]
            seen = [r.ts for r in df.filter(F.col("query_hash") == key).sort("seq").collect()]
            assert got == (sorted(set(seen)) if order == "time" else list(dict.fromkeys(seen)))


def test_documents_hold_the_digest_on_page_0(spark):
    df = records(spark, [record(i, i, "SELECT hot") for i in range(10)] + [record(99, 3, "SELECT y")])
    docs = digest_documents(digest(df), occurrences(df), page_size=4).collect()
    key = next(d.query_hash for d in docs if d.normalized_query == "SELECT hot")
    hot = sorted((d for d in docs if d.query_hash == key), key=lambda d: d.page)
    assert [len(d.timestamps) for d in hot] == [4, 4, 2]
    assert [d.execution_count for d in hot] == [10, None, None]
    assert [d.query for d in hot] == ["SELECT hot", None, None]
    assert len(docs) == 4


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_named_fields_stand_on_every_page(spark, order):
    rows = [list(record(i, i * 7 % 10, "SELECT hot")) for i in range(10)] + [list(record(90, None, "SELECT none"))]
    rows += [list(record(20 + i, i, f"SELECT {'ab'[i % 2]}")) for i in range(12)]
    for i, row in enumerate(rows):
        row[0] = "db" if i % 3 else None
    df = records(spark, [tuple(r) for r in rows])
    times = occurrences(df) if order == "time" else first_arrivals(df)
    known = digest(df, order=order)
    docs = digest_documents(
        known, times, page_size=2, order=order, every_page=("execution_count", "max_query_time")
    ).collect()
    whole = {(r.instance_id, r.query_hash): (r.execution_count, r.max_query_time) for r in known.collect()}
    assert {(d.instance_id, d.query_hash) for d in docs} == set(whole) and max(d.page for d in docs) > 1
    assert all((d.execution_count, d.max_query_time) == whole[d.instance_id, d.query_hash] for d in docs)
    assert all((d.query is None) == (d.page > 0) for d in docs)
    with pytest.raises(ValueError):
        digest_documents(known, times, every_page=("page",))


@pytest.mark.parametrize("name", ["digest_documents", "digest_documents_arrival"])
def test_document_queries_count_on_every_page(spark, name):
    from checks.queries import QUERIES

    rows = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    counts = {}
    for r in rows:
        counts.setdefault(r.query_hash, set()).add(r.execution_count)
    assert max(r.page for r in rows) > 0
    assert all(len(c) == 1 and 0 not in c for c in counts.values())


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_documents_of_odd_keys(spark, order):
    """Keys without an instance, digests without times, and times without a digest."""
    rows = [list(record(i, i % 7 if i % 5 else None, f"SELECT {'abc'[i % 3]}")) for i in range(60)]
    for i, row in enumerate(rows):
        row[0] = "db" if i % 2 else None
    df = records(spark, [tuple(r) for r in rows] + [record(90, None, "SELECT none")])
    times = occurrences(df) if order == "time" else first_arrivals(df)
    known = digest(df, order=order).filter("normalized_query <> 'SELECT b'")
    docs = digest_documents(known, times, page_size=2, order=order).collect()
    bodies = {(d.instance_id, d.normalized_query): d.execution_count for d in docs if d.page == 0}
    assert bodies == {(r.instance_id, r.normalized_query): r.execution_count for r in known.collect()}
    assert bodies["db", "SELECT none"] == 1 and (None, "SELECT a") in bodies
    assert {d.page for d in docs} > {0} and all(len(d.timestamps) <= 2 for d in docs)
    assert [d.timestamps for d in docs if d.normalized_query == "SELECT none"] == [[]]


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_documents_read_each_input_once(spark, tmp_path, order):
    df = records(spark, SMALL)
    times = occurrences(df) if order == "time" else first_arrivals(df)
    digest(df).write.parquet(f"{tmp_path}/d")
    times.write.parquet(f"{tmp_path}/t")
    docs = digest_documents(
        spark.read.parquet(f"{tmp_path}/d"), spark.read.parquet(f"{tmp_path}/t"), page_size=3, order=order
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = docs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("FileScan parquet") == 2
    # A reused exchange is printed with its input.
    reused = text.count("ReusedExchange")
    assert reused == 1 and text.count("Exchange hashpartitioning") - reused <= 5


def test_retention(spark):
    df = digest(records(spark, SMALL)).withColumn(
        "last_seen", F.when(F.col("normalized_query") != "SELECT b FROM t", F.col("last_seen"))
    )
    edge = DAY + dt.timedelta(days=3, minutes=30)
    seen = Observation()
    kept = expire_digest(df, 3, as_of=edge, observation=seen).collect()
    assert [r.normalized_query for r in kept] == ["SELECT b FROM t"]
    assert seen.get == {"kept": 1, "expired": 1}
    assert expired_digest(df, 3, as_of=edge).count() == 1
    just_before = edge - dt.timedelta(microseconds=1)
    assert expired_digest(df, 3, as_of=just_before).count() == 0
    with pytest.raises(ValueError):
        expire_digest(df, -1, as_of=edge)


def test_one_fingerprint_with_most_rows(spark):
    """A hot fingerprint is reduced in the scan tasks: few rows reach the shuffle."""
    rows = spark.range(60_000).select(
        F.lit("db").alias("instance_id"),
        F.lit("f").alias("source_file"),
        F.struct(F.lit(None).cast("timestamp").alias("modified"), F.lit("f").alias("file"), F.lit(0).cast("bigint").alias("start"), F.col("id").alias("row")).alias("seq"),
        F.lit("x").alias("timestamp_raw"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"),
        F.struct(F.lit("u").alias("name"), F.lit("h").alias("host")).alias("user"),
        F.lit(1.0).alias("query_time"),
        F.lit(0.0).alias("lock_time"),
        F.col("id").alias("rows_examined"),
        F.col("id").alias("rows_sent"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("SELECT hot WHERE x = "), F.col("id")))
        .otherwise(F.concat(F.lit("SELECT c FROM t"), F.col("id") % 50))
        .alias("query"),
    )
    out = by_query(digest(with_fingerprint(rows)))
    assert out["SELECT hot WHERE x = ?"].execution_count == 20_000
    assert sum(r.execution_count for r in out.values()) == 60_000
    assert len(out) == 51
