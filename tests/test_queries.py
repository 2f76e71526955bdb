"""Every registered query against its SQL, and the plans of the main ones."""

from __future__ import annotations

import re
from types import SimpleNamespace

import pytest

from __spark_entry__ import entry, queries
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES, _batch_records, _text_blocks, scratch
from slowdigest.operators.batches import batch_running_totals
from slowdigest.operators.blocks import parse_blocks
from slowdigest.operators.digest import digest, merge_digest, occurrences, with_fingerprint
from slowdigest.operators.series import trailing_trend
from slowdigest.operators.validate import validate

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ours = queries()[name](spark, SF).toPandas()
    assert difference(ours, con.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_scratch_uses_the_shared_folder(tmp_path):
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs://x/y/"}[key])
    assert scratch(SimpleNamespace(conf=conf)).startswith("hdfs://x/y/slowdigest-")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_digest_plan_has_one_shuffle_and_one_normalisation_per_row(spark):
    df = digest(with_fingerprint(validate(parse_blocks(_text_blocks(spark, SF)))), passes=1)
    text = plan(df)
    assert len(re.findall("Exchange hashpartitioning", text)) == 1
    assert "partial_min_by" in text and "CartesianProduct" not in text
    # The chain runs once below the shuffle (hash) and once above it (one row per digest).
    assert text.count("GROUP BY|ORDER BY") == 2


def _below_first_exchange(text):
    """For each exchange whose input is a scan: the operators between the two."""
    lines = [(len(re.match(r"[\s:+\-|*()\d]*", line)[0]), line) for line in text.splitlines()]
    found = []
    for n, (depth, line) in enumerate(lines):
        if "Exchange" not in line:
            continue
        below = []
        for deeper, inner in lines[n + 1 :]:
            if deeper <= depth:
                break
            below.append(inner)
        if below and not any("Exchange" in b for b in below):
            found.append(" ".join(below))
    return found


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_stored_records_are_not_sorted_for_a_digest(spark, tmp_path, order):
    """Numbers come from a hash aggregate without text; only bodies that may win are sorted and sent."""
    with_fingerprint(validate(parse_blocks(_text_blocks(spark, SF)))).write.parquet(f"{tmp_path}/r")
    df = digest(spark.read.parquet(f"{tmp_path}/r"), order=order)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    first = _below_first_exchange(text)
    assert first and not any("Sort" in below for below in first)
    assert all("HashAggregate" in below and "query#" not in below for below in first)
    # Bodies are read behind the filter of the winners, which is broadcast whatever the number of keys.
    assert re.search(r"BroadcastHashJoin \[_at#\w+\], \[_word#\w+\], Inner", text)


def test_merge_of_stored_digests_is_not_sorted(spark, tmp_path):
    digest(with_fingerprint(validate(parse_blocks(_text_blocks(spark, SF)))), passes=1).write.parquet(f"{tmp_path}/d")
    stored = spark.read.parquet(f"{tmp_path}/d")
    first = _below_first_exchange(plan(merge_digest(stored, stored)))
    assert first and not any("Sort" in below for below in first)


def test_occurrence_plan_hashes_by_time_and_parses_once(spark):
    text = plan(occurrences(with_fingerprint(validate(parse_blocks(_text_blocks(spark, SF))))))
    assert len(re.findall("Exchange hashpartitioning", text)) == 1
    assert re.search(r"Exchange hashpartitioning\([^)]*ts#", text)
    assert text.count("# Query_time: (") == 1 and text.count("GROUP BY|ORDER BY") == 1


def test_generated_code_can_be_compiled(spark):
    """Above 8,000 bytes of a method the JVM interprets it for good."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = digest(with_fingerprint(validate(parse_blocks(_text_blocks(spark, SF)))), passes=1)
        stages = df._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and 0 < max(sizes) < 8000


def test_running_totals_do_not_gather_a_job(spark):
    """Rows are spread by job and slot, slot totals by job and group; only totals of groups are ordered per job."""
    df = batch_running_totals(_batch_records(spark, SF))
    text = plan(df)
    spread = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert sum("_slot" in s for s in spread) >= 2
    by_job_alone = [s for s in spread if not re.search("_slot|_above", s)]
    assert len(set(by_job_alone)) == 1 and len(by_job_alone) == 1, spread
    assert "CartesianProduct" not in text and "SinglePartition" not in text


def test_trend_bound_reaches_the_scan(spark):
    from checks.queries import AS_OF
    from checks.render import events

    text = plan(trailing_trend(events(spark, SF), "event_type", "ts", "value", as_of=AS_OF))
    assert "GreaterThanOrEqual(ts" in text
    assert "SortAggregate" not in text
    assert re.search(r"ReadSchema: struct<ts:\w+,event_type:string,value:double>", text)
