"""Log blocks of every shape that the line rules tell apart, and what each must come out as.

A block grammar is a template of the block's text beside templates of its expected fields.  Text is rendered
by Spark; the expected fields become SQL, so that no text is parsed on that side.  ``event_id % len(GRAMMARS)``
picks the grammar of an event.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.render import INSTANCE

_ZULU, _OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+09:00'"


# What a placeholder of a template stands for in SQL.
_SQL = {
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'",
    "east": "strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+09:00'",
    "older": "strftime(ts, '%y%m%d %H:%M:%S')",
    "millis": "epoch_us(ts) // 1000",
    "unix": "epoch_us(ts) // 1000000",
    "user": "user_id",
    "host": "user_id % 5",
    "seconds": "value",
    "sent": "event_id % 100",
    "examined": "event_id * 10",
    "key": "event_id",
}


def _columns() -> dict[str, Column]:
    """What renders a placeholder in Spark."""
    at, key, user = F.col("ts").cast("timestamp"), F.col("event_id"), F.col("user_id")
    return {
        "iso": F.date_format("ts", _ZULU),
        "east": F.date_format(F.col("ts") + F.make_dt_interval(hours=F.lit(9)), _OFFSET),
        "older": F.date_format("ts", "yyMMdd HH:mm:ss"),
        "millis": F.unix_millis(at).cast("string"),
        "unix": F.unix_seconds(at).cast("string"),
        "user": user.cast("string"),
        "host": (user % 5).cast("string"),
        "seconds": F.format_string("%.6f", "value"),
        "sent": (key % 100).cast("string"),
        "examined": (key * 10).cast("string"),
        "key": key.cast("string"),
    }


def _pieces(template: str) -> list[tuple[str, bool]]:
    """Text and placeholders of a template, in order."""
    return [(x, n % 2 == 1) for n, x in enumerate(re.split(r"\{(\w+)\}", template)) if x]


def as_column(template: str) -> Column:
    known = _columns()
    return F.concat(*(known[x] if named else F.lit(x) for x, named in _pieces(template)))


def as_sql(template: str | None) -> str:
    if template is None:
        return "CAST(NULL AS VARCHAR)"
    parts = [
        f"({_SQL[x]})" if named else "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
        for x, named in _pieces(template)
    ]
    return " || ".join(["''", *parts])


TIME = "# Time: {iso}\n"
USER = "# User@Host: u{user}[u{user}] @ h{host} []\n"
STATS = "# Query_time: {seconds}  Lock_time: 0.000123 Rows_sent: {sent}  Rows_examined: {examined}\n"
SET = "SET timestamp={unix};\n"
STATEMENT = "SELECT v FROM t{user} WHERE k = {key};"
MASKED = "SELECT v FROM t{user} WHERE k = ?"
BANNER = "/usr/sbin/mysqld, Version: 8.0.28 (Source). started with:\nTcp port: 3306  Unix socket: /s.sock\n"


@dataclass(frozen=True)
class Grammar:
    """Templates of text and fields; ``single`` overrides fields in the single_file profile."""

    name: str
    text: str
    time: str | None = "{iso}"
    ts: str = "ts"
    user: str | None = "u{user}"
    host: str | None = "h{host}"
    seconds: str = "value"
    lock: str = "CAST(0.000123 AS DOUBLE)"
    sent: str = "CAST(event_id % 100 AS BIGINT)"
    examined: str = "CAST(event_id * 10 AS BIGINT)"
    query: str = STATEMENT
    masked: str = MASKED
    #: Whether the statement has SELECT; whether the block is beyond the bound and cannot be shortened.
    select: bool = True
    oversized: bool = False
    #: Fields of the single_file profile where they differ; row counts there are 0 unless given.
    single: tuple[tuple[str, str | None], ...] = ()


_ZERO = "CAST(0 AS BIGINT)"
_NO_DOUBLE = "CAST(0 AS DOUBLE)"
_NOBODY = (("user", None), ("host", None))
_UNKNOWN = "CAST(NULL AS TIMESTAMP)"

GRAMMARS = (
    Grammar("ordinary", TIME + USER + STATS + SET + STATEMENT),
    Grammar(
        "address only",
        TIME + "# User@Host: u{user}[u{user}] @  [10.0.0.{host}]\n" + STATS + SET + STATEMENT,
        host="[10.0.0.{host}]",
        single=_NOBODY,
    ),
    Grammar(
        "address only and id",
        TIME + "# User@Host: u{user}[u{user}] @  [10.0.0.{host}]  Id:    4{host}\n" + STATS + SET + STATEMENT,
        host="[10.0.0.{host}]",
        single=_NOBODY,
    ),
    Grammar(
        "host, address and id",
        TIME + "# User@Host: u{user}[u{user}] @ db-{host}.example [10.0.0.9]  Id: {key}\n" + STATS + SET + STATEMENT,
        host="db-{host}.example",
    ),
    Grammar(
        "more fields behind the rows",
        TIME + USER + STATS.rstrip("\n") + " Thread_id: {key} Errno: 0 Bytes_sent: 77\n" + SET + STATEMENT,
    ),
    Grammar(
        "several statements",
        TIME + USER + STATS + SET + "SELECT 7;\n" + STATEMENT,
        query="SELECT 7; " + STATEMENT,
    ),
    Grammar(
        "carriage returns",
        (TIME + USER + STATS + SET + "SELECT v\n\n FROM t{user}\n  WHERE k = {key};\n").replace("\n", "\r\n"),
    ),
    Grammar(
        "indents and remarks",
        TIME + "\t" + USER + "  # administrator: none\n " + STATS + "  " + SET
        + "\tSELECT v\n # inner\n　 FROM t{user}\n\n  WHERE k = {key};",
    ),
    Grammar(
        "the last header counts",
        TIME + "# User@Host: z[z] @ z []\n# Query_time: 900  Lock_time: 9.5\n" + USER + STATS + SET + STATEMENT,
    ),
    Grammar(
        "rows on a line of their own",
        TIME + USER + "# Query_time: {seconds}  Lock_time: 0.000123\n# Rows_examined: {examined}  Rows_sent: {sent}\n"
        + SET + STATEMENT,
        single=(("sent", "CAST(event_id % 100 AS BIGINT)"), ("examined", "CAST(event_id * 10 AS BIGINT)")),
    ),
    Grammar(
        "a count beyond longs",
        TIME + USER + STATS.replace("{sent}", "9{key}9999999999999999999") + SET + STATEMENT,
        sent="CAST(NULL AS BIGINT)",
    ),
    Grammar(
        "day first", "# Time: 15/03/2024 10:{host}\n" + USER + STATS + STATEMENT,
        time="15/03/2024 10:{host}", ts=_UNKNOWN,
    ),
    Grammar(
        "time in words", "# Time: Friday, at noon\n" + STATEMENT,
        time="Friday, at noon", ts=_UNKNOWN, user=None, host=None, seconds=_NO_DOUBLE, lock=_NO_DOUBLE,
        sent=_ZERO, examined=_ZERO,
    ),
    Grammar(
        "older time", "# Time: {older}\n" + USER + STATS + SET + STATEMENT,
        time="{older}", ts="date_trunc('second', ts)",
    ),
    Grammar(
        "milliseconds, no blank", "# Time:{millis}\n" + USER + STATS + SET + STATEMENT,
        time="{millis}", ts="date_trunc('milliseconds', ts)",
    ),
    Grammar(
        "too many digits", "# Time: 99{millis}000\n" + USER + STATS + SET + STATEMENT,
        time="99{millis}000", ts=_UNKNOWN,
    ),
    Grammar("another zone", "# Time: {east}\n" + USER + STATS + SET + STATEMENT, time="{east}"),
    Grammar("no time", "# Time:\n" + USER + STATS + SET + STATEMENT, time=None, ts=_UNKNOWN),
    Grammar("no user", TIME + STATS + SET + STATEMENT, user=None, host=None),
    Grammar(
        "unreadable user", TIME + "# User@Host: u-{user}[u-{user}] @ h{host} []\n" + STATS + SET + STATEMENT,
        user=None, host=None,
    ),
    Grammar(
        "user without brackets", TIME + "# User@Host: u{user} @ h{host}\n" + STATS + SET + STATEMENT, single=_NOBODY
    ),
    Grammar(
        "no numbers", TIME + USER + SET + STATEMENT,
        seconds=_NO_DOUBLE, lock=_NO_DOUBLE, sent=_ZERO, examined=_ZERO,
    ),
    Grammar("no statement", TIME + USER + STATS, query="", masked="", select=False),
    Grammar("other statement", TIME + USER + STATS + "DELETE FROM t{user} WHERE k = {key};",
            query="DELETE FROM t{user} WHERE k = {key};", masked="DELETE FROM t{user} WHERE k = ?", select=False),
    Grammar(
        "select in lower case", TIME + USER + STATS + "insert into b select v from t{user}",
        query="insert into b select v from t{user}", masked="insert into b select v from t{user}",
    ),
    Grammar(
        "marker inside a statement", TIME + USER + STATS + "SELECT '# Time: {key}', v\nFROM t{user};",
        query="SELECT '# Time: {key}', v FROM t{user};", masked="SELECT ?, v FROM t{user}",
    ),
    Grammar(
        "server lines behind it", TIME + USER + STATS + SET + STATEMENT + "\n" + BANNER,
        # The part behind the semicolon has no word of a statement, so the mask is that of the one before.
        query=STATEMENT + " " + BANNER.strip().replace("\n", " "),
    ),
    Grammar(
        "far too long", TIME + USER + STATS + "SELECT " + "ab " * 400 + "FROM t{user}",
        query="SELECT " + "ab " * 400 + "FROM t{user}", masked="SELECT " + "ab " * 400 + "FROM t{user}", oversized=True,
    ),
)
#: Bytes above which blocks are shortened where the queries ask for it; only the last grammar is longer.
BOUND = 1000


def variant_blocks(events: DataFrame) -> DataFrame:
    """(instance_id, event_id, text): the block of each event, by its grammar."""
    made = F.lit(None)
    for i, g in enumerate(GRAMMARS):
        made = F.when(F.col("event_id") % len(GRAMMARS) == i, as_column(g.text)).otherwise(made)
    return events.select(F.lit(INSTANCE).alias("instance_id"), "event_id", made.alias("text"))


def write_variants(events: DataFrame, path: str, files: int) -> None:
    """The blocks as slow-log files."""
    lines = variant_blocks(events).repartition(files, "event_id").select("text")
    lines.write.option("mapreduce.output.basename", "slowquery").text(path)


def _lines(query: str, text: str) -> str:
    """The single_file profile keeps SET lines in the statement."""
    return ("SET timestamp={unix}; " + query).rstrip() if SET.strip() in text else query


def _case(pick) -> str:
    whens = " ".join(f"WHEN {i} THEN {pick(g)}" for i, g in enumerate(GRAMMARS))
    return f"CASE event_id % {len(GRAMMARS)} {whens} END"


def _field(name: str, single: bool):
    def pick(g: Grammar) -> str:
        own = dict(g.single)
        if single and name in own:
            value = own[name]
        elif single and name in ("sent", "examined"):
            value = _ZERO
        elif single and name == "query":
            value = _lines(g.query, g.text)
        else:
            value = getattr(g, name)
        return as_sql(value) if name in ("time", "user", "host", "query", "masked") else value

    return _case(pick)


def expected(single: bool = False) -> str:
    """CTE ``seen``: one row per block with its fields, reject reason and fingerprint text."""
    profile = {
        n: _field(n, single)
        for n in ("time", "ts", "user", "host", "seconds", "lock", "sent", "examined", "query", "masked")
    }
    select = _case(lambda g: str(g.select).lower())
    oversized = _case(lambda g: str(g.oversized).lower())
    modular = "" if single else """
      WHEN timestamp_raw IS NULL THEN 'no_timestamp' WHEN query_time < 0.1 THEN 'below_min_time'
      WHEN user_name IS NULL THEN 'no_user'"""
    late = "WHEN query_time < 0.1 THEN 'below_min_time'" if single else ""
    return f"""fields AS (
      SELECT event_id, '{INSTANCE}' AS instance_id, {profile["time"]} AS timestamp_raw, {profile["ts"]} AS ts,
        {profile["user"]} AS user_name, {profile["host"]} AS user_host, {profile["seconds"]} AS query_time,
        {profile["lock"]} AS lock_time, {profile["examined"]} AS rows_examined, {profile["sent"]} AS rows_sent,
        {profile["query"]} AS query, {profile["masked"]} AS normalized_query, {select} AS has_select,
        {oversized} AS oversized
      FROM events),
    judged AS (
      SELECT *, CASE WHEN query = '' THEN 'empty_query' {modular}
        WHEN NOT has_select THEN 'not_select' {late}
        WHEN timestamp_raw IS NOT NULL AND ts IS NULL THEN 'bad_timestamp' END AS reason FROM fields),
    seen AS (
      SELECT * EXCLUDE (reason), reason AS reject_reason,
        CASE WHEN oversized THEN 'oversized' ELSE reason END AS bounded_reason FROM judged)"""


def expected_fields(single: bool = False, key: bool = True) -> str:
    return f"""WITH {expected(single)} SELECT {"event_id, " if key else ""}instance_id, timestamp_raw, ts, user_name,
      user_host, query_time, lock_time, CAST(rows_examined AS VARCHAR) AS rows_examined,
      CAST(rows_sent AS VARCHAR) AS rows_sent, query FROM seen"""


def expected_rejects() -> str:
    """Rejected blocks per profile and reason, with blocks beyond the bound dropped."""
    each = [
        f"""SELECT '{profile}' AS profile, bounded_reason AS reject_reason, count(*) AS blocks
          FROM (WITH {expected(profile == "single_file")} SELECT * FROM seen)
          WHERE bounded_reason IS NOT NULL GROUP BY ALL"""
        for profile in ("modular", "single_file")
    ]
    return " UNION ALL ".join(each)


def expected_digest(index: str, single: bool = False) -> str:
    return f"""WITH {expected(single)},
      ranked AS (
        SELECT *, md5(normalized_query) AS query_hash, count(*) OVER w AS execution_count,
          max(query_time) OVER w AS max_query_time, max(ts) OVER w AS last_seen,
          row_number() OVER (PARTITION BY normalized_query ORDER BY ts NULLS LAST, event_id) AS n
        FROM seen WHERE reject_reason IS NULL WINDOW w AS (PARTITION BY normalized_query))
      SELECT '{index}' AS index_name, instance_id, query_hash, query, normalized_query, ts AS first_seen, user_name,
        user_host, query_time, lock_time, CAST(rows_examined AS VARCHAR) AS rows_examined,
        CAST(rows_sent AS VARCHAR) AS rows_sent, execution_count, max_query_time, last_seen
      FROM ranked WHERE n = 1"""
