from __future__ import annotations

import datetime as dt
import random
import re

import pytest

from slowdigest.operators import blocks as B
from slowdigest.operators.blocks import compress_blocks, parse_blocks, split_blocks
from slowdigest.operators.validate import reject_summary, validate, with_reject_reason
from slowdigest.schema import PARSED_SCHEMA

SAMPLE_1 = """
# Time: 2021-06-30T22:15:40.003000Z
# User@Host: night_etl[night_etl] @ localhost []
# Query_time: 41.750000  Lock_time: 0.020000 Rows_sent: 12  Rows_examined: 880
SET timestamp=1625091340;
SELECT /*+ NO_CACHE */ sensor, COUNT(DISTINCT probe) FROM readings
  WHERE taken BETWEEN 3 AND 71 OR unit <> 'kPa'
  GROUP BY sensor;
"""
SAMPLE_2 = """
# Time: 2021-06-30T22:16:02Z
# User@Host: audit[audit] @  [172.16.4.4]  Id:    31
# Query_time: 0.3  Lock_time: 0.000000 Rows_sent: 0  Rows_examined: 5 Errno: 0
WITH late AS (SELECT id FROM tickets WHERE state IN ('new','held'))
SELECT 'late', id FROM late UNION ALL SELECT 'lost', 0;
"""
HEAD = "# Time: 2024-01-01T00:00:00Z\n# User@Host: {} \n# Query_time: 1.0  Lock_time: 0.5\n"


def parse(spark, text, profile="modular", **options):
    df = spark.createDataFrame([(text,)], "value string")
    rows = parse_blocks(split_blocks(df, profile=profile), profile=profile, **options).collect()
    return sorted(rows, key=lambda r: r.seq.row)


def only(spark, text, **options):
    rows = parse(spark, text, **options)
    assert len(rows) == 1
    return rows[0]


def user(spark, line):
    row = only(spark, HEAD.format(line) + "SELECT 1;")
    return row.user.name, row.user.host


def test_sample_blocks(spark):
    a, b = parse(spark, SAMPLE_1 + "\n" + SAMPLE_2)
    assert a.timestamp_raw == "2021-06-30T22:15:40.003000Z"
    assert a.ts == dt.datetime(2021, 6, 30, 22, 15, 40, 3000)
    assert (a.user.name, a.user.host) == ("night_etl", "localhost")
    assert (a.query_time, a.lock_time) == (41.75, 0.02)
    assert (a.rows_examined, a.rows_sent) == (880, 12)
    assert a.query == (
        "SELECT /*+ NO_CACHE */ sensor, COUNT(DISTINCT probe) FROM readings"
        " WHERE taken BETWEEN 3 AND 71 OR unit <> 'kPa' GROUP BY sensor;"
    )
    assert (b.user.name, b.user.host) == ("audit", "[172.16.4.4]")
    assert (b.query_time, b.lock_time, b.rows_examined, b.rows_sent) == (0.3, 0.0, 5, 0)
    assert b.query == (
        "WITH late AS (SELECT id FROM tickets WHERE state IN ('new','held'))"
        " SELECT 'late', id FROM late UNION ALL SELECT 'lost', 0;"
    )


def test_schema(spark):
    df = parse_blocks(split_blocks(spark.createDataFrame([(SAMPLE_1,)], "value string")))
    assert df.schema.simpleString() == PARSED_SCHEMA.simpleString()
    assert df.columns == PARSED_SCHEMA.names


def test_compat_rows_reads_only_the_reversed_order(spark):
    row = only(spark, SAMPLE_1, compat_rows=True)
    assert (row.rows_examined, row.rows_sent) == (0, 0)
    text = HEAD.format("a[a] @ h") + "# Rows_examined: 7  Rows_sent: 3\nSELECT 1;"
    row = only(spark, text, compat_rows=True)
    assert (row.rows_examined, row.rows_sent) == (7, 3)
    same_line = text.replace("\n# Rows_examined", " Rows_examined")
    row = only(spark, same_line, compat_rows=True)
    assert (row.rows_examined, row.rows_sent) == (0, 0)


@pytest.mark.parametrize(
    "line, expected",
    [
        ("rd[rd] @ localhost []", ("rd", "localhost")),
        ("rd[rd] @  [10.0.0.1]", ("rd", "[10.0.0.1]")),
        ("rd @ web-1.example.com", ("rd", "web-1.example.com")),
        ("rd[x y][z] @ h", ("rd", "h")),
        ("rd[a-b]@h", ("rd", "h")),
        ("한글[x] @ h", ("한글", "h")),
        ("a-b[a-b] @ h", (None, None)),
        ("[] @ h", (None, None)),
    ],
)
def test_user_shapes(spark, line, expected):
    assert user(spark, line) == expected


def test_last_header_line_wins_and_texts_join(spark):
    text = (
        HEAD.format("a[a] @ h1")
        + "SELECT 1;\n# User@Host: b[b] @ h2\n# User@Host: broken\n"
        + "# Query_time: 3.5  Lock_time: 0.25 Rows_sent: 4  Rows_examined: 9\n"
        + "SET timestamp=5;\nSELECT 2;"
    )
    row = only(spark, text)
    assert (row.user.name, row.user.host) == ("b", "h2")
    assert (row.query_time, row.lock_time, row.rows_sent, row.rows_examined) == (3.5, 0.25, 4, 9)
    assert row.query == "SELECT 1; SELECT 2;"


def test_user_line_is_not_read_for_times(spark):
    text = "# Time: 2024-01-01T00:00:00Z\n# User@Host: a[a] @ h Query_time: 5 Lock_time: 1\nSELECT 1"
    row = only(spark, text)
    assert (row.user.name, row.query_time) == ("a", 0.0)


def test_line_ends_indents_and_blank_lines(spark):
    text = (
        "\r\n   # Time: 2024-01-01T00:00:00Z \r\n\t# User@Host: a[a] @ h []\r\n"
        "  # Query_time: 1.0  Lock_time: 0.5 Rows_sent: 1  Rows_examined: 2\r\n"
        "  SET timestamp=1;\r\n\r\n  SELECT  a \r\n　 FROM t \r\n # a remark\r\n"
    )
    row = only(spark, text)
    assert row.timestamp_raw == "2024-01-01T00:00:00Z"
    assert (row.user.name, row.user.host, row.query_time, row.rows_examined) == ("a", "h", 1.0, 2)
    assert row.query == "SELECT  a FROM t"


def test_text_before_the_first_marker_has_no_time(spark):
    first, second = parse(spark, "SELECT 0;\n" + SAMPLE_1)
    assert first.timestamp_raw is None and first.query == "SELECT 0;"
    assert second.timestamp_raw is not None
    assert parse(spark, "") == [] and parse(spark, " \n\n") == []


SERVER = (
    "/usr/sbin/mysqld, Version: 8.0.28 (Source). started with:\n"
    "Tcp port: 3306  Unix socket: /tmp/mysql.sock\n"
    "Time                 Id Command    Argument\n"
)


def test_server_lines(spark):
    text = SAMPLE_1.strip() + "\n" + SERVER
    assert only(spark, text, drop_preamble=True).query.endswith("GROUP BY sensor;")
    assert "Tcp port" in only(spark, text).query
    assert parse(spark, SERVER, drop_preamble=True)[0].query == ""


def test_statements_with_server_words_stay(spark):
    statement = "SELECT * FROM log\nWHERE msg = 'started with: x' AND p = 'Tcp port: 5';"
    row = only(spark, SAMPLE_1.split("SELECT")[0].strip() + "\n" + statement)
    assert row.query == statement.replace("\n", " ")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2024-03-15T10:00:01.5+09:00", dt.datetime(2024, 3, 15, 1, 0, 1, 500000)),
        ("2024-03-15", dt.datetime(2024, 3, 15)),
        ("240315  9:05:07", dt.datetime(2024, 3, 15, 9, 5, 7)),
        ("240315 19:05:07", dt.datetime(2024, 3, 15, 19, 5, 7)),
        ("1710496801123", dt.datetime(2024, 3, 15, 10, 0, 1, 123000)),
        ("99999999999999999999", None),
        ("yesterday", None),
        ("2024-13-45T00:00:00Z", None),
    ],
)
def test_timestamps(spark, raw, expected):
    row = only(spark, SAMPLE_1.replace("2021-06-30T22:15:40.003000Z", raw))
    assert row.timestamp_raw == raw and row.ts == expected


def test_single_file_profile(spark):
    text = (
        "# Time: 2024-01-01T00:00:00Z\n# User@Host: a[a] @ h []\n"
        "  # Query_time: 9.0  Lock_time: 0.5\n# Query_time: 2.0  Lock_time: 0.25 Rows_sent: 3\n"
        "# Rows_examined: 7  Rows_sent: 3\nSET timestamp=5;\nSELECT 1;\n  # Time: 2025-01-01\nFROM t"
    )
    row = only(spark, text, profile="single_file")
    assert (row.query_time, row.lock_time, row.rows_examined, row.rows_sent) == (2.0, 0.25, 7, 3)
    assert row.query == "SET timestamp=5; SELECT 1; FROM t"
    late = text.replace("# Query_time: 2.0", "  # Query_time: 2.0").replace("  # Query_time: 9", "# Query_time: 9")
    row = only(spark, late, profile="single_file")
    assert (row.query_time, row.lock_time) == (9.0, 0.25)
    loose = SAMPLE_1.replace("night_etl[night_etl]", "night_etl")
    assert only(spark, loose, profile="single_file").user.name is None
    assert only(spark, loose).user.name == "night_etl"


VARIANTS = [
    SAMPLE_1,
    SAMPLE_2,
    SAMPLE_1.replace("[]", "[10.0.0.1]  Id:   12"),
    SAMPLE_1.replace("\nSET", "\nuse db1;\nSET"),
    SAMPLE_1.replace("\nSET", "\nuse db1; # x\nSET"),
    SAMPLE_1.replace("kPa'", "a\tb\t#'"),
    SAMPLE_1.replace("sensor, ", "sensor\n  # inner remark\n, "),
    SAMPLE_1.replace("sensor, ", "sensor  \n\n\t , "),
    SAMPLE_1.replace("2021-06-30T22:15:40.003000Z", "240315 10:00:01"),
    SAMPLE_1.replace("\nSET timestamp=1625091340;", ""),
    SAMPLE_1.replace("41.750000", "41."),
    SAMPLE_1.replace("Rows_sent: 12 ", "Rows_sent: 99999999999999999999 "),
    SAMPLE_1.replace("localhost", "höst-1.x"),
    SAMPLE_1.replace("SELECT", "SELECT 'started with:'\nFROM a;\nSELECT"),
    SAMPLE_1.replace("'kPa'", "'SET timestamp=5'"),
    SAMPLE_1.strip().split("\nSET")[0],
    SAMPLE_1.replace("localhost []", " [10.0.0.1]"),
    SAMPLE_1.replace("localhost []", "[::1]  Id: 7"),
    SAMPLE_1.replace("[night_etl]", "[night-etl]"),
    SAMPLE_1.replace("[night_etl]", ""),
    SAMPLE_1.replace("[night_etl] @", "@"),
    SAMPLE_1.replace("880", "880 Thread_id: 5 Schema: a#b Rows_sent: 3"),
    SAMPLE_1.replace("880", "880  Start: 2021-06-30T22:15:40Z  User@Host: x"),
    SAMPLE_1.replace("880", "880 Query_time: 7 Lock_time: 8 "),
]


@pytest.mark.parametrize("profile", ["modular", "single_file"])
@pytest.mark.parametrize("compat", [False, True])
def test_common_head_agrees_with_the_line_rules(spark, monkeypatch, profile, compat):
    """The one-pass reading of ordinary blocks must not differ from the general one."""
    df = spark.createDataFrame(list(enumerate(VARIANTS)), "i int, value string").repartition(1)

    def run():
        parsed = parse_blocks(split_blocks(df, profile=profile), profile=profile, compat_rows=compat)
        return sorted(parsed.drop("seq").collect(), key=lambda r: r.i)

    quick = run()
    monkeypatch.setattr(B, "_common_head", lambda single: r"\A(a)(a)(a)(a)(a)(a)(a)(a)(a)\z(?!)")
    assert quick == run()
    assert len(quick) == len(VARIANTS)


LINES = [
    "# User@Host: u1[u1] @ h1 []",
    "# User@Host: u2 @  [10.0.0.1]  Id: 7",
    "  # User@Host: u-3[u-3] @ h3",
    "# Query_time: 1.250000  Lock_time: 0.000100 Rows_sent: 3  Rows_examined: 40",
    "# Query_time: 7  Lock_time: 1.",
    "\t# Query_time: 8.5  Lock_time: 2.5 Rows_sent: 9",
    "# Rows_examined: 11  Rows_sent: 12",
    "# Thread_id: 5  Schema: x",
    "SET timestamp=5;",
    " SET timestamp=6;",
    "use shop;",
    "SELECT a \t, '#x'",
    "  FROM t -- b",
    "Tcp port: 1",
    "",
    " \u3000 ",
]


@pytest.mark.parametrize("profile", ["modular", "single_file"])
def test_random_blocks_agree_with_the_line_rules(spark, monkeypatch, profile):
    rng = random.Random(profile)
    ordinary = [LINES[0], LINES[3]]
    texts = [
        "\n".join(
            ["# Time: 2024-01-01T00:00:00Z"]
            + (ordinary if i % 2 else [])
            + rng.choices(LINES, k=rng.randrange(7))
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string").repartition(1)

    def run():
        parsed = parse_blocks(split_blocks(df, profile=profile), profile=profile, drop_preamble=True)
        return sorted(parsed.drop("seq").collect(), key=lambda r: r.i)

    quick = run()
    monkeypatch.setattr(B, "_common_head", lambda single: r"\A(a)(a)(a)(a)(a)(a)(a)(a)(a)\z(?!)")
    assert quick == run()
    for row, text in zip(quick, texts):
        lines = [line.strip() for line in text.split("\n")[1:]]
        drop = ("#", "Tcp port") if profile == "single_file" else ("#", "Tcp port", "SET timestamp=")
        assert row.query == " ".join(x for x in lines if x and not x.startswith(drop))
        times = [x for x in lines if x.startswith("# Query_time")]
        if profile == "modular":
            want = float(re.search(r"[\d.]+", times[-1])[0]) if times else 0.0
            assert row.query_time == want
            users = [x for x in lines if x.startswith(("# User@Host: u1", "# User@Host: u2"))]
            assert row.user.name == (users[-1][13:15] if users else None)


def test_reject_reasons_in_order(spark):
    good = SAMPLE_1.strip()
    cases = {
        None: good,
        "empty_query": good.split("\nSET")[0],
        "no_timestamp": good.replace("# Time: 2021-06-30T22:15:40.003000Z\n", ""),
        "below_min_time": good.replace("41.750000", "0.099999"),
        "no_user": good.replace("night_etl[", "night-etl["),
        "not_select": good.replace("SELECT", "DELETE"),
        "bad_timestamp": good.replace("2021-06-30T", "T"),
    }
    df = spark.createDataFrame(list(cases.items()), "want string, value string")
    judged = with_reject_reason(parse_blocks(split_blocks(df)))
    for row in judged.collect():
        assert row.reject_reason == row.want
    counts = {r.reject_reason: r.blocks for r in reject_summary(judged).collect()}
    assert counts == {k: 1 for k in cases if k}


def test_validation_bounds(spark):
    edge = SAMPLE_1.replace("41.750000", "0.100000")
    df = spark.createDataFrame([(edge,)], "value string")
    parsed = parse_blocks(split_blocks(df))
    assert validate(parsed).count() == 1
    assert validate(parsed, 0.2).count() == 0
    lower = SAMPLE_1.replace("SELECT", "insert into x select")
    assert validate(parse_blocks(split_blocks(spark.createDataFrame([(lower,)], "value string")))).count() == 1
    with pytest.raises(ValueError):
        validate(parsed, 0)
    with pytest.raises(ValueError):
        validate(parsed, profile="other")


def test_single_file_accepts_blocks_without_time_or_user(spark):
    text = "# Query_time: 1.0  Lock_time: 0.0\nSELECT 1;"
    df = spark.createDataFrame([(text,)], "value string")
    parsed = parse_blocks(split_blocks(df, profile="single_file"), profile="single_file")
    assert validate(parsed, profile="single_file").count() == 1
    assert validate(parsed).count() == 0


def compress(spark, statement, limit=200):
    text = SAMPLE_1.split("SET")[0].lstrip() + statement
    df = spark.createDataFrame([(text,)], "value string")
    blocks = compress_blocks(split_blocks(df), limit)
    return blocks.first().oversize, parse_blocks(blocks).first()


@pytest.mark.parametrize(
    "statement, expected",
    [
        ("SELECT a FROM t WHERE b in (" + "1, " * 99 + "1)", "SELECT a FROM t WHERE b IN (...)"),
        ("INSERT\nINTO t   values (" + "x" * 300 + ")", "INSERT INTO t VALUES (...)"),
        ("SELECT case  when a then b " + "c " * 99 + "end d", "SELECT CASE ... END d"),
        ("SELECT '" + "y" * 300 + "' z", "SELECT '...' z"),
        ("SELECT 1, 2 ,3," + "44, " * 99 + "5 FROM t", "SELECT ... FROM t"),
        ("SELECT a order by b,c,d,e," + "f" * 200 + ",,g", "SELECT a ORDER BY ...g"),
        ("SELECT a group by b,c,d,e," + "f" * 200 + ",g", "SELECT a GROUP BY ...g"),
    ],
)
def test_compression_steps(spark, statement, expected):
    oversize, row = compress(spark, statement)
    assert oversize == "compressed" and row.query == expected
    assert row.user.name == "night_etl" and row.query_time == 41.75


def test_compression_limits(spark):
    assert compress(spark, "SELECT 1", 10_000)[0] is None
    oversize, row = compress(spark, "SELECT " + "ab " * 200)
    assert oversize == "dropped" and row.query == ""
    # Five commas are taken and the rest stays, which is too much here.
    assert compress(spark, "SELECT a ORDER BY " + ",".join("abcdefghij" for _ in range(60)))[0] == "dropped"
    assert compress(spark, "", 10)[0] == "dropped"
    df = spark.createDataFrame([("# Query_time: 1\nSELECT (" + "1, " * 99 + ")",)], "value string")
    row = compress_blocks(split_blocks(df), 50).first()
    assert row.oversize == "compressed" and row.block.strip().startswith("# Query_time: 1\nSELECT (...")


def test_long_number_list_does_not_exhaust_the_stack(spark):
    oversize, row = compress(spark, "SELECT a FROM t WHERE b = 1 OR c = " + "123, " * 200_000 + "9")
    assert oversize == "compressed" and row.query == "SELECT a FROM t WHERE b = 1 OR c = ..."
