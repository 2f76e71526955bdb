"""Blocks of every shape, read from files and from a column."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.render import INSTANCE, events, table
from checks.variants import GRAMMARS, variant_blocks, write_variants
from slowdigest.operators.blocks import parse_blocks, split_blocks
from slowdigest.plans.batch import slow_query_records
from slowdigest.sources.slowlog import read_slow_log

SF = "/root/testdata/sf0.001"
FIELDS = ("timestamp_raw", "ts", "user", "query_time", "lock_time", "rows_examined", "rows_sent", "query")


def rows(df):
    return sorted(map(repr, df.select(*FIELDS).collect()))


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("variants") / "logs")
    write_variants(events(spark, SF), folder, 3)
    return folder


@pytest.mark.parametrize("profile", ["modular", "single_file"])
@pytest.mark.parametrize("size", [333, 4_000, 1 << 27])
def test_files_and_columns_give_the_same_blocks(spark, logs, profile, size):
    text = variant_blocks(events(spark, SF))
    whole = parse_blocks(split_blocks(text, "text", profile=profile), profile=profile)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = read_slow_log(spark, logs, INSTANCE, profile=profile)
        assert read.rdd.getNumPartitions() > (20 if size < 5_000 else 0)
        assert rows(parse_blocks(read, profile=profile)) == rows(whole)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("head", ["/usr/sbin/mysqld, Version\nTcp", "AND b = 2;", "# User@Host: a[a] @ h []\nSELECT 1;", "\n\nSELECT 1;"])
def test_text_in_front_of_a_files_first_marker(spark, tmp_path, head):
    block = "\n# Time: {}\n# User@Host: a[a] @ h []\nSELECT 2;"
    text = head + "".join(block.format(t) for t in ("15/03/2024 10:00", "2024-03-15T10:00:00Z", "soon")) + "\n"
    (tmp_path / "slowquery.log").write_text(text)
    whole = parse_blocks(split_blocks(spark.createDataFrame([(text,)], "value string")))
    for size in (16, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            read = parse_blocks(read_slow_log(spark, str(tmp_path), INSTANCE))
            assert rows(read) == rows(whole) and read.count() == 4
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_every_reason_occurs(spark):
    text = split_blocks(variant_blocks(events(spark, SF)), "text")
    found = slow_query_records(text, max_block_bytes=1000).select("reject_reason").distinct().collect()
    assert {r.reject_reason for r in found} == {
        None, "oversized", "empty_query", "no_timestamp", "below_min_time", "no_user", "not_select", "bad_timestamp",
    }


def test_unreadable_and_missing_counts_differ(spark):
    text = variant_blocks(events(spark, SF))
    by_name = {g.name: i for i, g in enumerate(GRAMMARS)}
    parsed = parse_blocks(split_blocks(text, "text"))
    kind = F.col("event_id") % len(GRAMMARS)
    beyond = parsed.filter(kind == by_name["a count beyond longs"])
    assert beyond.count() > 0 and beyond.filter("rows_sent is not null or rows_examined is null").count() == 0
    missing = parsed.filter(kind == by_name["no numbers"])
    assert missing.count() > 0 and missing.filter("rows_sent <> 0 or rows_examined <> 0").count() == 0


def test_tasks_do_not_grow_with_the_table(spark, tmp_path):
    """The text of a few bytes of events is long: rows, not bytes of files, bound what a task renders and parses."""
    cores = spark.sparkContext.defaultParallelism
    for copies in (2, 8):
        folder = tmp_path / str(copies)
        spark.range(copies * cores * 100).withColumnRenamed("id", "event_id").coalesce(1).write.parquet(
            f"{folder}/events.parquet"
        )
        df = table(spark, str(folder), "events", rows_per_task=100)
        rows = df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert sum(rows) == copies * cores * 100
        assert max(rows) <= 150
    assert df.select("event_id").distinct().count() == copies * cores * 100
