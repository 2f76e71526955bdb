from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from slowdigest.operators import batches, chunks, running, series
from slowdigest.schema import BATCH_SCHEMA, CHUNK_SCHEMA

NOW = dt.datetime(2024, 1, 1, 12)


def batch_rows(n=200, seed=1):
    """One job holds most rows; ids have gaps; one job has no name."""
    rng = random.Random(seed)
    rows, at = [], 0
    for _ in range(n):
        at += rng.choice([1, 1, 1, 40])
        ok = rng.random() < 0.8
        job = rng.choice(["hot", "hot", "hot", "b", None])
        error = None if ok else rng.choice(["A", "B"])
        rows.append((job, at, rng.randrange(1, 100), float(rng.randrange(1, 50)), ok, error))
    return rows


def by_job(rows):
    jobs = {}
    for row in rows:
        jobs.setdefault(row[0], []).append(row)
    return jobs


@pytest.mark.parametrize("slot_rows", [11, 64, 100_000])
def test_running_totals(spark, slot_rows):
    rows = batch_rows()
    df = batches.batch_running_totals(spark.createDataFrame(rows, BATCH_SCHEMA), slot_rows=slot_rows)
    want = {}
    for job, mine in by_job(rows).items():
        good = bad = 0
        for row in mine:
            good += row[2] if row[4] else 0
            bad += 0 if row[4] else row[2]
            want[job, row[1]] = (good, bad)
    got = {(r.job, r.batch_id): (r.success_count, r.error_count) for r in df.collect()}
    assert got == want


@pytest.mark.parametrize("slot_rows, fan", [(1, 3), (4, 1 << 8), (65_536, 1 << 21)])
def test_running_totals_of_sparse_numbers(spark, monkeypatch, slot_rows, fan):
    """Numbers over the whole range of longs, in slots of their own."""
    monkeypatch.setattr(running, "FAN", fan)
    rng = random.Random(fan)
    at = sorted({rng.randrange(-(2**63), 2**63) for _ in range(150)} | {-(2**63), 2**63 - 1, -1, 0, 1})
    rows = [("hot" if n % 3 else None, k, n + 1, 1.0, n % 4 > 0, None) for n, k in enumerate(at)]
    df = spark.createDataFrame(rows, BATCH_SCHEMA).repartition(5)
    got = batches.batch_running_totals(df, slot_rows=slot_rows).collect()
    sums, want = {}, {}
    for job, k, size, _, ok, _ in rows:
        good, bad = sums.get(job, (0, 0))
        sums[job] = want[job, k] = (good + size, bad) if ok else (good, bad + size)
    assert {(r.job, r.batch_id): (r.success_count, r.error_count) for r in got} == want


def test_no_window_is_keyed_by_the_job_over_all_slots(spark):
    """Totals of slots are added up per group of slots; only totals of the widest groups meet per job."""
    text = batches.batch_running_totals(spark.createDataFrame([], BATCH_SCHEMA).union(
        spark.createDataFrame(batch_rows(), BATCH_SCHEMA)
    ))._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", text)
    assert len(windows) == 4
    assert sum("_above" in w or "_slot" in w for w in windows) == 3


@pytest.mark.parametrize("slot_rows", [10, 16, 100_000])
@pytest.mark.parametrize("size, full_only", [(10, True), (5, False), (1, True)])
def test_rolling_mean(spark, slot_rows, size, full_only):
    rows = batch_rows(seed=size)
    df = batches.batch_rolling_mean(
        spark.createDataFrame(rows, BATCH_SCHEMA),
        size=size,
        full_only=full_only,
        slot_rows=slot_rows,
    )
    want = {}
    for job, mine in by_job(rows).items():
        for i, row in enumerate(mine):
            last = [r[3] for r in mine[max(0, i + 1 - size) : i + 1]]
            full = len(last) == size
            want[job, row[1]] = sum(last) / len(last) if full or not full_only else None
    got = {(r.job, r.batch_id): r.rolling_mean for r in df.collect()}
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value))


def test_window_sizes_are_checked(spark):
    df = spark.createDataFrame([], BATCH_SCHEMA)
    with pytest.raises(ValueError):
        batches.batch_rolling_mean(df, size=0)
    with pytest.raises(ValueError):
        batches.batch_running_totals(df, slot_rows=0)


def test_batch_summaries(spark):
    rows = [
        ("j", 0, 100, 2.0, True, None),
        ("j", 1, 50, 2.0, False, "TransportError"),
        ("j", 2, 50, 0.0, True, None),
        ("idle", 0, 0, 0.0, True, None),
    ]
    df = spark.createDataFrame(rows, BATCH_SCHEMA)
    s = {r.job: r for r in batches.batch_summary(df).collect()}
    assert (s["j"].total_documents, s["j"].successful_documents, s["j"].failed_documents) == (200, 150, 50)
    assert (s["j"].success_rate, s["j"].documents_per_second) == (75.0, 50.0)
    assert (s["idle"].success_rate, s["idle"].documents_per_second) == (0.0, 0.0)
    r = {r.job: r for r in batches.run_summary(df).collect()}["j"]
    assert (r.processed_queries, r.indexed_documents, r.error_count) == (200, 150, 50)
    assert (r.batches_processed, r.total_duration) == (3, 4.0)
    assert batches.run_summary(df.limit(0)).count() == 0
    errors = batches.error_distribution(df).collect()
    assert [(e.job, e.error_type, e.occurrences) for e in errors] == [("j", "TransportError", 1)]


def chunk(name, size, status, attempts=1, start=0, end=None, error=None):
    at = NOW + dt.timedelta(seconds=start)
    done = None if end is None else NOW + dt.timedelta(seconds=end)
    return (name, size, status, attempts, error, at, done)


CHUNKS = [
    chunk("a", 100, "completed", start=0, end=10),
    chunk("b", 300, "completed", start=10, end=20),
    chunk("c", 50, "completed", start=20, end=20),
    chunk("d", 70, "failed", 2, start=5, end=9, error="x"),
    chunk("e", 80, "failed", 3, start=5, end=9, error="y"),
    chunk("f", 400, "processing", start=30),
    chunk("g", 1000, "pending"),
]


def test_chunk_reports(spark):
    df = spark.createDataFrame(CHUNKS, CHUNK_SCHEMA)
    assert chunks.status_counts(df).first().asDict() == {
        "pending": 1,
        "processing": 1,
        "completed": 3,
        "failed": 2,
    }
    assert {r.chunk_id: (r.attempt_count, r.error) for r in chunks.failed_chunks(df).collect()} == {
        "d": (2, "x"),
        "e": (3, "y"),
    }
    assert [r[0] for r in chunks.retryable_chunks(df).collect()] == ["d"]
    p = chunks.chunk_progress(df).first()
    assert (p.total_chunks, p.processed_bytes, p.total_bytes) == (7, 450, 2000)
    assert (p.progress_percentage, p.chunk_percentage) == (22.5, 42.86)
    assert p.average_chunk_seconds == pytest.approx(20 / 3)
    assert chunks.chunk_progress(df, 900).first().progress_percentage == 50.0
    assert chunks.recent_rate(df).first()[0] == 20.0
    assert chunks.recent_rate(df, last=1).first()[0] == 30.0
    assert chunks.run_rate(df, as_of=NOW + dt.timedelta(seconds=45)).first()[0] == 10.0
    spans = {r.chunk_id: r.duration_seconds for r in chunks.with_duration(df).collect()}
    assert spans["b"] == 10.0 and spans["f"] is None


def test_chunk_reports_on_nothing(spark):
    df = spark.createDataFrame([], CHUNK_SCHEMA)
    assert chunks.recent_rate(df).first()[0] == 0.0
    assert chunks.run_rate(df, as_of=NOW).first()[0] == 0.0
    p = chunks.chunk_progress(df).first()
    assert (p.total_chunks, p.progress_percentage, p.average_chunk_seconds) == (0, 0.0, 0.0)
    assert chunks.completion_estimate(df, 10, as_of=NOW).first().estimated_completion is None


def test_completion_estimate(spark):
    df = spark.createDataFrame(CHUNKS, CHUNK_SCHEMA)
    row = chunks.completion_estimate(df, 1450, as_of=NOW).first()
    assert (row.processed_bytes, row.remaining_bytes, row.bytes_per_second) == (450, 1000, 20.0)
    assert row.estimated_completion == NOW + dt.timedelta(seconds=50)
    assert chunks.completion_estimate(df, 450, as_of=NOW).first().estimated_completion == NOW


POINTS = [("k", NOW - dt.timedelta(minutes=m), float(v)) for m, v in ((9, 5), (5, 2), (4, 8), (1, 6))]


def test_trailing_trend(spark):
    rows = POINTS + [("single", NOW, 1.0)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, value double")
    out = series.trailing_trend(df, "key", "ts", "value", as_of=NOW).collect()
    assert [r.key for r in out] == ["k"]
    r = out[0]
    # The point exactly five minutes old counts; the older one does not.
    assert (r.duration_minutes, r.growth, r.growth_per_minute) == (4.0, 4.0, 1.0)
    assert (r.average, r.peak, r.current) == (pytest.approx(16 / 3), 8.0, 6.0)
    growth = series.series_growth(df, "key", "ts", "value").collect()
    assert {r.key: r.growth for r in growth} == {"k": 1.0, "single": 0.0}


def test_threshold_status(spark):
    df = spark.createDataFrame([(511.9,), (512.0,), (768.0,)], "v double")
    got = [r[0] for r in df.select(series.threshold_status("v", 512, 768)).collect()]
    assert got == ["normal", "warning", "critical"]


def test_error_list(spark):
    df = spark.createDataFrame(
        [("a", NOW), (None, NOW), ("b", None)], "error_type string, ts timestamp"
    )
    rows = batches.error_list(df, "ts").collect()
    assert [(r.timestamp, r.error) for r in rows] == [(NOW, "a")]
    assert df.filter(F.col("error_type").isNull()).count() == 1
