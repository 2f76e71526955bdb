from __future__ import annotations

import hashlib
import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slowdigest.functions import normalize as N

EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"

GOLDEN = [
    # Digits that belong to a name stay, and so does a sign in front of a number.
    ("SELECT v2, 14, 'x14', 15b FROM t9 WHERE k=-3", "SELECT v2, ?, ?, 15b FROM t9 WHERE k=-?", None),
    # IN needs no word boundary in front of it.
    ("SELECT a FROM t WHERE d NOT IN ('p', 'q') OR begin(7) = 1", "SELECT a FROM t WHERE d NOT IN (...) OR begIN (...) = ?", None),
    # The statements of the two sample blocks.
    (
        "SELECT /*+ NO_CACHE */ sensor, COUNT(DISTINCT probe) FROM readings"
        " WHERE taken BETWEEN 3 AND 71 OR unit <> 'kPa' GROUP BY sensor;",
        "SELECT /*+ NO_CACHE */ sensor, COUNT(DISTINCT probe) FROM readings"
        " WHERE taken BETWEEN ? AND ? OR unit <> ? GROUP BY sensor",
        None,
    ),
    (
        "WITH late AS (SELECT id FROM tickets WHERE state IN ('new','held'))"
        " SELECT 'late', id FROM late UNION ALL SELECT 'lost', 0;",
        "WITH late AS (SELECT id FROM tickets WHERE state IN (...))"
        " SELECT ?, id FROM late UNION ALL SELECT ?, ?",
        None,
    ),
    (
        "SELECT 3.14, t1.a FROM t1 WHERE d='2024-03-15' AND x IN (1,2, 3)",
        "SELECT ?.?, t1.a FROM t1 WHERE d=? AND x IN (...)",
        None,
    ),
    (
        "select min(a) from t join (select max(b) from u) z",
        "select mIN (...) from t joIN (...) from u) z",
        None,
    ),
    ("SELECT a FROM t WHERE id IN (1,2,3", "SELECT a FROM t WHERE id IN (...)", None),
    (
        "SET timestamp=1; -- REMOTE_ADDR: 1.2.3.4 -- URL: /a/b?x=1 SELECT * FROM t WHERE a='it''s'",
        "SELECT * FROM t WHERE a=??",
        None,
    ),
    ("SELECT 1; COMMIT;", "SELECT ?", None),
    ("SELECT 'a;b' FROM t", "b' FROM t", None),
    (
        "SELECT 한글123, 5 FROM 표 WHERE a='값 7'",
        "SELECT 한글123, ? FROM 표 WHERE a=?",
        None,
    ),
    ("SELECT　a, \x1c b\tFROM t", "SELECT a, b FROM t", None),
    ("SELECT ٣٤ FROM t", "SELECT ? FROM t", None),
    ("SELECT 1e5, 0x1F, t1 FROM t LIMIT 10", "SELECT 1e5, 0x1F, t1 FROM t LIMIT ?", None),
    ("SELECT 'open FROM t", "SELECT 'open FROM t", None),
    ("SELECT a FROM t WHERE b IN () AND c in(2)", "SELECT a FROM t WHERE b IN () AND c IN (...)", None),
    ("COMMIT", "", EMPTY_MD5),
    ("", "", EMPTY_MD5),
    (None, "", EMPTY_MD5),
]


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "q string").select(make(F.col("q"))).first()[0]


def many(spark, texts, make):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, q string")
    return [r[0] for r in rows.repartition(1).sort("i").select(make(F.col("q"))).collect()]


def test_golden(spark):
    texts = [g[0] for g in GOLDEN]
    assert many(spark, texts, N.normalize_query) == [g[1] for g in GOLDEN]
    hashes = many(spark, texts, N.generate_hash)
    for (_, text, known), got in zip(GOLDEN, hashes):
        assert got == hashlib.md5(text.encode()).hexdigest()
        assert known in (None, got)


def test_rehash_normalises_twice(spark):
    text = "SELECT 'a' '5' FROM t WHERE x = \"'\" AND y = \"'\""
    once = one(spark, text, N.normalize_query)
    twice = one(spark, once, N.normalize_query)
    assert one(spark, text, lambda c: N.generate_hash(c, rehash=True)) == (
        hashlib.md5(twice.encode()).hexdigest()
    )


@pytest.mark.parametrize(
    "step, text, expected",
    [
        (N.strip_set_timestamp, "a set  TIMESTAMP = 5 ; b SET timestamp=6;c", "a b c"),
        (N.strip_use, "USE shop_1 ;  SELECT 1", "SELECT 1"),
        (N.strip_use, "SELECT 1; use shop;", "SELECT 1; use shop;"),
        (N.strip_use, "use `shop`; SELECT 1", "use `shop`; SELECT 1"),
        (N.strip_request_comments, "-- url: /x?a=1 SELECT 1", " SELECT 1"),
        (N.strip_request_comments, "-- Host : h\n -- note", "\n -- note"),
        (N.strip_request_comments, "-- URL: a preselected b", "selected b"),
        (N.strip_request_comments, "-- URL: a; SELECT 1", "-- URL: a; SELECT 1"),
        (N.strip_request_comments, "x -- REMOTE_ADDR: 10.0.0.1  ", "x   "),
        (N.last_statement, "SELECT 1; ;", "SELECT 1"),
        (N.last_statement, "select 1;\n update t set a=1 ;COMMIT", "update t set a=1"),
        (N.last_statement, "begin; commit", ""),
        (N.last_statement, "a  group  by b", ""),
        (N.mask_strings, "a \"it's\" b 'x\"y'", "a ? b ?"),
    ],
)
def test_steps(spark, step, text, expected):
    assert one(spark, text, step) == expected


ALPHABET = "aZ_09 1;'\"(),.-\t\n 　\x1c٣²é한́iInN"


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(ALPHABET, max_size=30), min_size=20, max_size=20))
def test_single_steps_against_python(spark, texts):
    """Blanks, digits and word characters mean the same as in Python's Unicode regexes."""
    assert many(spark, texts, N.collapse_blanks) == [re.sub(r"\s+", " ", t) for t in texts]
    assert many(spark, texts, N.mask_numbers) == [re.sub(r"\b\d+\b", "?", t) for t in texts]


@pytest.mark.parametrize(
    "text",
    [
        "SELECT a FROM t WHERE a IN (" + ",".join(map(str, range(300_000))),
        "SELECT '" + "x" * 2_000_000 + "' FROM t",
        "SELECT " + " " * 2_000_000 + "a",
        "-- URL: " + " " * 1_000_000 + "; select 1",
        "-- URL: " + "a b " * 500_000 + "select 1",
        "select " + "1" * 1_000_000,
        "select 1;" * 200_000,
    ],
    ids=["open-list", "literal", "blanks", "comment-blanks", "comment", "digits", "statements"],
)
def test_long_statements_stay_linear(spark, text):
    started = time.monotonic()
    assert one(spark, text, lambda c: F.length(N.normalize_query(c))) is not None
    assert time.monotonic() - started < 20
