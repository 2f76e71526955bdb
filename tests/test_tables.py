from __future__ import annotations

import datetime as dt
import json
import os
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from checks.render import events, write_logs
from slowdigest.operators.batches import run_summary
from slowdigest.operators.blocks import parse_blocks
from slowdigest.operators.digest import digest, occurrences, with_fingerprint
from slowdigest.operators.validate import validate
from slowdigest.plans.batch import run_batch, slow_query_records
from slowdigest.sources import digest_table
from slowdigest.sources.digest_table import DigestTable, Expired
from slowdigest.schema import DIGEST_SCHEMA
from slowdigest.sources.slowlog import (
    MERGE_SCRIPT,
    WriteCounts,
    digest_stats,
    read_digest,
    read_slow_log,
    stream_slow_log,
    to_upsert_actions,
    write_digest,
)
from slowdigest.sources.storage import Run, committed_versions, cover, create_once
from slowdigest.streaming.digest_stream import digest_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    """Rendered events in five slow-log files and one file of another name."""
    folder = str(tmp_path_factory.mktemp("logs"))
    write_logs(events(spark, SF), f"{folder}/a", 5)
    (tmp_path_factory.mktemp("x") / "y").write_text("")
    with open(f"{folder}/a/error.log", "w") as f:
        f.write("# Time: 2024-01-01T00:00:00Z\nSELECT 1;\n")
    return f"{folder}/a"


def records(spark, path, **options):
    return with_fingerprint(validate(parse_blocks(read_slow_log(spark, path, "db-1", **options))))


@pytest.fixture(scope="module")
def expected(spark, logs):
    return sorted(digest(records(spark, logs)).collect())


def test_only_slow_logs_are_read(spark, logs):
    blocks = read_slow_log(spark, logs, "db-1")
    assert blocks.count() == events(spark, SF).count()
    assert read_slow_log(spark, logs, "db-1", name_glob="error*").count() == 1


def test_instance_from_the_path(spark, logs):
    folder = F.regexp_extract("_metadata.file_path", "/([^/]+)/[^/]+$", 1)
    found = read_slow_log(spark, logs, folder).select("instance_id").distinct().collect()
    assert [r[0] for r in found] == ["a"]


@pytest.mark.parametrize("split", ["1000", "7001", "100000000"])
def test_splits_do_not_change_the_digest(spark, logs, expected, split):
    """Blocks that cross a split border are read once and whole."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert sorted(digest(records(spark, logs)).collect()) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_file_edges(spark, tmp_path):
    first = "# Time: 2024-01-01T00:00:00Z\n# User@Host: a[a] @ h []\n# Query_time: 1 Lock_time: 0\nSELECT 1;\n"
    (tmp_path / "slowquery-1.log").write_text(first + first.replace("SELECT", "SELECT  2,"))
    (tmp_path / "slowquery-2.log").write_text("mysqld, Version: 8.0.28 started with:\n" + first)
    (tmp_path / "slowquery-3.log").write_text("")
    (tmp_path / "slowquery-4.log").write_text("\n\n  " + first + "  \n")
    parsed = parse_blocks(read_slow_log(spark, str(tmp_path), "db"))
    assert sorted(r.query for r in validate(parsed).collect()) == sorted(
        ["SELECT 1;"] * 3 + ["SELECT  2, 1;"]
    )
    assert parsed.filter("timestamp_raw is null").count() == 1


def test_write_and_read_back(spark, logs, expected, tmp_path):
    path = str(tmp_path / "digest")
    bad = digest(records(spark, logs)).limit(2).withColumn("query_hash", F.lit(None).cast("string"))
    counts = write_digest(digest(records(spark, logs)).unionByName(bad), path)
    assert (counts.ok, counts.failed) == (len(expected), 2)
    assert sorted(read_digest(spark, path).collect()) == expected
    stats = digest_stats(spark, path).first()
    files = [f for f in (tmp_path / "digest").rglob("*.parquet")]
    assert stats.document_count == len(expected)
    assert stats.store_size_bytes == sum(f.stat().st_size for f in files)


def test_missing_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert read_digest(spark, path).count() == 0
    assert digest_stats(spark, path).count() == 0
    with pytest.raises(AnalysisException):
        read_slow_log(spark, path, "db")


def test_empty_inputs(spark, tmp_path):
    (tmp_path / "slowquery.log").write_text("")
    table = run_batch(spark, str(tmp_path), "db", str(tmp_path / "table"))
    assert table.digests().count() == 0 and table.documents().count() == 0
    assert [b.size for b in table.batches().collect()] == [0]
    for i, df in enumerate((table.digests(), spark.createDataFrame([], DIGEST_SCHEMA))):
        path = str(tmp_path / f"digest-{i}")
        assert write_digest(df, path) == WriteCounts(0, 0)
        assert read_digest(spark, path).count() == 0
        assert digest_stats(spark, path).first().document_count == 0


def test_upsert_actions(spark, logs):
    action = json.loads(to_upsert_actions(records(spark, logs), script_id="s").first().value)
    assert action["_op_type"] == "update" and action["retry_on_conflict"] == 3
    assert action["_id"] == action["upsert"]["query_hash"]
    assert action["script"]["id"] == "s"
    assert action["script"]["params"]["timestamp"] == action["upsert"]["timestamp"]
    assert action["upsert"]["timestamps"] == [action["upsert"]["last_seen"]]
    assert action["upsert"]["execution_count"] == 1


def test_run_batch_versions(spark, logs, expected, tmp_path):
    root = str(tmp_path / "table")
    table = run_batch(spark, logs, "db-1", root)
    assert sorted(table.digests().collect()) == expected
    rejected = table.records().filter("rejected").groupBy("reject_reason").count().collect()
    assert {r[0] for r in rejected} <= {"not_select", "below_min_time"}
    table = run_batch(spark, logs, "db-1", root)
    assert table.versions() == [0, 1]
    twice = {r.query_hash: r.execution_count for r in table.digests().collect()}
    assert twice == {r.query_hash: 2 * r.execution_count for r in expected}
    assert sorted(table.occurrences().collect()) == sorted(occurrences(records(spark, logs)).collect())


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_documents_of_a_table(spark, tmp_path, order):
    """The second load has the earlier times and the lower file name."""
    block = (
        "# Time: 2024-01-0{0}T00:00:0{1}Z\n# User@Host: a[a] @ h []\n"
        "# Query_time: 1.0  Lock_time: 0.0 Rows_sent: 1  Rows_examined: 1\nSELECT {1};\n"
    )
    for name, day in (("b", 2), ("a", 1)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "slowquery.log").write_text("".join(block.format(day, s) for s in (3, 1, 2, 1)))
        table = run_batch(spark, str(folder), "db", str(tmp_path / "table"), order=order)
    pages = sorted(table.documents(page_size=4).collect(), key=lambda r: r.page)
    assert [len(p.timestamps) for p in pages] == [4, 2]
    got = [(t.day, t.second) for p in pages for t in p.timestamps]
    arrived = [(2, 3), (2, 1), (2, 2), (1, 3), (1, 1), (1, 2)]
    assert got == (arrived if order == "arrival" else sorted(arrived))
    first, last = pages[0].timestamp, pages[0].last_seen
    assert pages[0].execution_count == 8
    if order == "arrival":
        assert (first.day, first.second, last.day, last.second) == (2, 3, 1, 1)
    else:
        assert (first.day, first.second, last.day, last.second) == (1, 1, 2, 3)


def test_inline_script_says_what_the_stored_one_does(spark, logs):
    action = json.loads(to_upsert_actions(records(spark, logs), inline=True).first().value)
    assert action["script"]["source"] == MERGE_SCRIPT and action["script"]["lang"] == "painless"
    assert "id" not in action["script"]
    assert set(action["script"]["params"]) == {"timestamp", "query_time"}


def test_a_load_counts_while_it_writes(spark, logs, tmp_path):
    table = run_batch(spark, logs, "db-1", str(tmp_path / "t"))
    run_batch(spark, logs, "db-1", str(tmp_path / "t"))
    by_reason = table.records().groupBy("reject_reason").count().collect()
    want = {r.reject_reason: r["count"] for r in by_reason}
    valid = want.pop(None)
    assert {r.reject_reason: r.blocks for r in table.rejects().collect()} == want and want
    assert sum(b.size for b in table.batches().collect()) == valid


def test_rotated_files_arrive_by_their_time(spark, tmp_path):
    block = (
        "# Time: 2024-01-01T00:00:0{0}Z\n# User@Host: a{0}[a{0}] @ h []\n"
        "# Query_time: 1.0  Lock_time: 0.0 Rows_sent: 1  Rows_examined: 1\nSELECT 1;\n"
    )
    logs = tmp_path / "logs"
    logs.mkdir()
    for n, name in enumerate(("slowquery.log.2", "slowquery.log.1", "slowquery.log")):
        (logs / name).write_text(block.format(n))
        os.utime(logs / name, (1_700_000_000 + n, 1_700_000_000 + n))
    first = {}
    for how in ("name", "modified"):
        table = run_batch(spark, str(logs), "db", str(tmp_path / how), order="arrival", file_order=how)
        row = table.digests().first()
        first[how] = (row.user.name, row.last_seen.second)
        listed = [t.second for d in table.documents().collect() for t in d.timestamps]
        assert listed == ([0, 1, 2] if how == "modified" else [2, 1, 0])
    assert first == {"modified": ("a0", 2), "name": ("a2", 0)}
    with pytest.raises(ValueError):
        read_slow_log(spark, str(logs), "db", file_order="size")


def test_failed_loads_are_noted(spark, logs, tmp_path):
    table = DigestTable(spark, str(tmp_path / "table"))
    records = slow_query_records(read_slow_log(spark, logs, "db-1"))
    broken = records.withColumn("query_time", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception):
        table.load(0, broken, index_prefix="p")
    assert table.versions() == [] and table.digests().count() == 0
    table.load(0, records, index_prefix="p", job="again")
    notes = {r.job: (r.success, r.error_type is None) for r in table.batches().collect()}
    assert notes == {"slow-log": (False, False), "again": (True, True)}


def test_compaction_keeps_the_result(spark, logs, tmp_path):
    root = str(tmp_path / "table")
    table = DigestTable(spark, root)
    parts = slow_query_records(read_slow_log(spark, logs, "db-1")).withColumn(
        "_part", F.second("ts") % 6
    )
    for v in range(6):
        table.write(v, parts.filter(F.col("_part") == v).drop("_part"), index_prefix="p")
    before = sorted(table.digests().collect())
    table.compact(1)
    table.compact(3)
    table.compact(3)
    table.compact(5)
    assert committed_versions(spark, f"{root}/base") == [3, 5]
    assert table.versions() == [4, 5]
    assert sorted(table.digests().collect()) == before
    shutil.rmtree(f"{root}/base/v=5")
    assert sorted(table.digests().collect()) == before
    shutil.rmtree(f"{root}/delta/v=4")
    with pytest.raises(RuntimeError):
        table.digests()


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_stream_equals_batch_and_replay_does_not_count_twice(spark, logs, expected, tmp_path, order):
    root, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def drain(**options):
        source = stream_slow_log(spark, logs, "db-1", max_files_per_trigger=1)
        digest_stream(
            source, root, checkpoint, order=order, compact_every=2, available_now=True, **options
        ).awaitTermination()

    drain()
    table = DigestTable(spark, root, order=order)
    first = sorted(table.digests().collect())
    if order == "time":
        assert first == [r for r in sorted(expected)]
    summary = run_summary(table.batches()).first()
    assert (summary.job, summary.batches_processed, summary.error_count) == ("slow-log", 5, 0)
    assert summary.indexed_documents == sum(r.execution_count for r in expected)
    # Nothing new: the checkpoint knows every file.
    drain()
    assert sorted(table.digests().collect()) == first
    # Lose the commit of the last batch: it runs again and overwrites its version.
    (tmp_path / "checkpoint" / "commits" / "4").unlink()
    (tmp_path / "checkpoint" / "commits" / ".4.crc").unlink(missing_ok=True)
    drain()
    assert sorted(table.digests().collect()) == first


def test_stream_options(spark, logs, tmp_path):
    source = stream_slow_log(spark, logs, "db-1", max_bytes_per_trigger="1k")
    with pytest.raises(ValueError):
        digest_stream(source, str(tmp_path), str(tmp_path / "c"), compact_every=0)


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_large_loads_take_two_passes(spark, logs, tmp_path, order):
    """The bound is one of cost: both ways give the same table."""
    found = []
    for bound in (0, 1 << 60):
        table = DigestTable(spark, str(tmp_path / str(bound)), order=order, two_pass_bytes=bound)
        for v in range(3):
            part = slow_query_records(read_slow_log(spark, logs, "db-1")).filter(F.second("ts") % 3 == v)
            table.write(v, part, index_prefix="p")
        table.compact(1)
        found.append(sorted(table.digests().collect()))
    assert found[0] == found[1] and found[0]


def test_cover_takes_the_widest_and_latest():
    runs = [Run(0, 0, 0), Run(0, 1, 0), Run(0, 1, 1), Run(2, 2, 0), Run(2, 2, 1), Run(1, 1, 3), Run(3, 3, 0)]
    assert [r.name for r in cover(runs)] == ["r=0-1-1", "r=2-2-1", "v=3"]
    assert cover([]) == []


def test_folds_are_few_and_keep_every_row(spark, logs, tmp_path, monkeypatch):
    monkeypatch.setattr(digest_table, "FAN", 2)
    root = str(tmp_path / "t")
    table = DigestTable(spark, root)
    records = slow_query_records(read_slow_log(spark, logs, "db-1")).withColumn("_part", F.second("ts") % 6)
    records.write.parquet(str(tmp_path / "r"))
    records = spark.read.parquet(str(tmp_path / "r"))

    def load(v):
        table.write(v, records.filter(F.col("_part") == v).drop("_part"), index_prefix="p")

    def state():
        return sorted(table.occurrences().collect()), sorted(map(repr, table.records().drop("v").collect()))

    for v in range(6):
        load(v)
        for part in ("occurrences", "records"):
            table.fold(part, v)
    whole = state()
    assert whole[0] == sorted(occurrences(records.filter("not rejected")).collect())
    assert len(whole[1]) == records.count()
    assert [r.name for r in table.runs("occurrences")] == ["r=0-3-0", "r=4-5-0"]
    # A fold that is repeated, and a load that runs again after it was folded, change nothing.
    load(4)
    table.fold("occurrences", 5)
    table.fold("records", 5)
    assert state() == whole
    assert len(list((tmp_path / "t" / "occurrences").iterdir())) <= 3
    assert sorted({r.v for r in table.records().select("v").collect()}) == list(range(6))


def test_retention_in_a_table(spark, tmp_path, monkeypatch):
    block = (
        "# Time: 2024-01-{0:02d}T00:00:00Z\n# User@Host: a[a] @ h []\n"
        "# Query_time: {2}  Lock_time: 0.0 Rows_sent: 1  Rows_examined: 1\nSELECT {1};\n"
    )

    def load(name, *rows):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "slowquery.log").write_text("".join(block.format(*r) for r in rows))
        return run_batch(spark, str(folder), "db", str(tmp_path / "t"))

    load("a", (1, "x", 9.0), (2, "x", 1.0), (3, "y", 1.0), (2, "late", 0.01), (20, "quick", 0.01))
    table = load("b", (4, "x", 1.0), (9, "y", 1.0))
    assert table.expire(5, as_of=dt.datetime(2024, 1, 8)) == Expired(0, 0, 1)
    assert table.expire(5, as_of=dt.datetime(2024, 1, 9)) == Expired(1, 3, 3)
    assert {r.normalized_query for r in table.digests().collect()} == {"SELECT y"}
    assert table.occurrences().count() == 2
    assert sorted(r.query for r in table.records().collect()) == ["SELECT quick;", "SELECT y;", "SELECT y;"]
    # Compacting the same version again does not bring anything back.
    table.compact(1)
    assert table.digests().count() == 1
    table = load("c", (10, "x", 2.0))
    back = {r.normalized_query: r for r in table.digests().collect()}
    assert (back["SELECT x"].execution_count, back["SELECT x"].max_query_time) == (1, 2.0)
    assert back["SELECT y"].execution_count == 2
    # A call that is interrupted is finished by the next one, with the keys it had stored.
    monkeypatch.setattr(DigestTable, "_expire_part", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.expire(1, as_of=dt.datetime(2024, 1, 10))
    monkeypatch.undo()
    assert table.expire(30, as_of=dt.datetime(2024, 1, 10)) == Expired(1, 2, 2)
    assert {r.normalized_query for r in table.digests().collect()} == {"SELECT x"}
    with pytest.raises(ValueError):
        table.expire(-1, as_of=dt.datetime(2024, 1, 10))
    assert DigestTable(spark, str(tmp_path / "none")).expire(as_of=dt.datetime(2024, 1, 1)) == Expired(0, 0, 0)


def test_one_of_many_creates(spark, tmp_path):
    def create(n):
        path = str(tmp_path / "x" / "one")
        return create_once(spark, path, lambda p: spark.range(n, n + 1).coalesce(1).write.parquet(p))

    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(create, range(6)))
    assert sum(made) == 1
    assert spark.read.parquet(str(tmp_path / "x" / "one" / "part-*")).first()[0] == made.index(True)
    assert [p.name for p in (tmp_path / "x").iterdir()] == ["one"]


def test_run_batch_compacts(spark, logs, tmp_path):
    for _ in range(2):
        table = run_batch(spark, logs, "db-1", str(tmp_path / "t"), compact_every=2)
    assert committed_versions(spark, f"{tmp_path}/t/base") == [1]
    with pytest.raises(ValueError):
        run_batch(spark, logs, "db-1", str(tmp_path / "t"), compact_every=0)
    assert table.newest() == 1


def test_second_writer_is_refused(spark, logs, tmp_path):
    root = str(tmp_path / "t")
    source = lambda: stream_slow_log(spark, logs, "db-1")
    digest_stream(source(), root, str(tmp_path / "c"), available_now=True).awaitTermination()
    before = DigestTable(spark, root).digests().count()
    with pytest.raises(Exception, match="is written by"):
        digest_stream(source(), root, str(tmp_path / "new"), available_now=True).awaitTermination()
    with pytest.raises(RuntimeError, match="is written by"):
        run_batch(spark, logs, "db-1", root)
    assert DigestTable(spark, root).digests().count() == before > 0
