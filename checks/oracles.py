"""Expected results of the registered queries in DuckDB SQL.

The log queries never parse text here: they state what each event's block must
come out as.
"""

from __future__ import annotations

from checks.queries import (
    COMPRESS_ABOVE,
    EXPIRE_DAYS,
    PAGE,
    ROTATED,
    SPARSE,
    TOTAL_BYTES,
    TREND_MINUTES,
)
from checks.render import INSTANCE, PREFIX
from checks.variants import expected_digest, expected_fields, expected_rejects

# Blanks as an RE2 class body, for the steps that are compared on raw text.
_BLANK = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_WORD = r"\p{L}\p{N}_"

_EVENTS = f"""
ev AS (
  SELECT event_id, event_id % 4 AS kind, ts, user_id, event_type, value,
    '{INSTANCE}' AS instance_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS timestamp_raw,
    'u' || user_id AS user_name, 'h' || (user_id % 5) AS user_host,
    value AS query_time, CAST(0.000123 AS DOUBLE) AS lock_time,
    event_id * 10 AS rows_examined, event_id % 100 AS rows_sent,
    CASE event_id % 4
      WHEN 0 THEN 'SELECT user_id, value FROM ' || event_type || '_u' || user_id
        || ' WHERE user_id = ' || user_id || ' AND props = ''k' || event_id || ' it''''s'';'
      WHEN 1 THEN 'SELECT MIN(value), COUNT(*) FROM ' || event_type || '_log WHERE  event_id IN ('
        || event_id || ', ' || user_id || ', 7);'
      WHEN 2 THEN 'use shop; SELECT t.a FROM ' || event_type || ' t JOIN u' || user_id
        || ' u ON t.id = u.id WHERE t.name = "v' || event_id || '" LIMIT 10;'
      ELSE 'UPDATE ' || event_type || '_log SET value = ' || user_id || ' WHERE event_id = '
        || event_id || ';' END AS query,
    CASE event_id % 4
      WHEN 0 THEN 'SELECT user_id, value FROM ' || event_type || '_u' || user_id
        || ' WHERE user_id = ? AND props = ??'
      WHEN 1 THEN 'SELECT MIN (...), COUNT(*) FROM ' || event_type
        || '_log WHERE event_id IN (...)'
      WHEN 2 THEN 'SELECT t.a FROM ' || event_type || ' t JOIN u' || user_id
        || ' u ON t.id = u.id WHERE t.name = ? LIMIT ?'
      ELSE 'UPDATE ' || event_type || '_log SET value = ? WHERE event_id = ?' END
      AS normalized_query,
    CASE WHEN value < 0.1 THEN 'below_min_time' WHEN event_id % 4 = 3 THEN 'not_select' END
      AS reject_reason
  FROM events),
valid AS (SELECT *, md5(normalized_query) AS query_hash FROM ev WHERE reject_reason IS NULL)
"""
_PARSED = """instance_id, timestamp_raw, ts, user_name, user_host, query_time, lock_time,
  rows_examined, rows_sent, query"""
_PARSED_ZERO_ROWS = """instance_id, timestamp_raw, ts, user_name, user_host, query_time, lock_time,
  CAST(0 AS BIGINT) AS rows_examined, CAST(0 AS BIGINT) AS rows_sent, query"""
_SINGLE = _PARSED_ZERO_ROWS.replace(
    "sent, query", "sent, 'SET timestamp=' || epoch_us(ts) // 1000000 || '; ' || query AS query"
)


def _with_events(select: str) -> str:
    return f"WITH {_EVENTS} {select}"


def _digest(by: str = "ts", last: str = "max(ts)", source: str = "valid", body: str = "") -> str:
    """One digest per fingerprint; the row with the smallest ``by`` gives the body."""
    picks = ", ".join(
        f"arg_min({c}, {by}) AS {name}"
        for c, name in (
            (body or "query", "query"),
            ("ts", "first_seen"),
            ("user_name", "user_name"),
            ("user_host", "user_host"),
            ("query_time", "query_time"),
            ("lock_time", "lock_time"),
            ("rows_examined", "rows_examined"),
            ("rows_sent", "rows_sent"),
        )
    )
    return f"""SELECT '{PREFIX}-{INSTANCE}' AS index_name, instance_id, query_hash,
      normalized_query, {picks}, count(*) AS execution_count, max(query_time) AS max_query_time,
      {last} AS last_seen
    FROM {source} GROUP BY instance_id, query_hash, normalized_query"""


_CUTOFF = f"TIMESTAMP '2024-01-31' - to_days({EXPIRE_DAYS})"
_GONE = f"""gone AS (SELECT query_hash FROM valid GROUP BY query_hash HAVING max(ts) <= {_CUTOFF})"""

_DIGEST = _with_events(_digest())
_DIGEST_ARRIVAL = _with_events(_digest("event_id", "arg_max(ts, event_id)"))
_ROTATED_AT = f"(event_id % {len(ROTATED)} * 1000000000000 + event_id)"
_DIGEST_ROTATED = _with_events(_digest(_ROTATED_AT, f"arg_max(ts, {_ROTATED_AT})"))
_DIGEST_SINGLE = f"""WITH {_EVENTS},
  single AS (SELECT * REPLACE (
      CAST(0 AS BIGINT) AS rows_examined, CAST(0 AS BIGINT) AS rows_sent,
      'SET timestamp=' || epoch_us(ts) // 1000000 || '; ' || query AS query) FROM valid)
  {_digest(source="single")}"""

_PAGES = """SELECT query_hash, count(*) OVER (PARTITION BY query_hash) AS execution_count,
    (row_number() OVER (PARTITION BY query_hash ORDER BY {order}) - 1) // {page} AS page,
    CAST((row_number() OVER (PARTITION BY query_hash ORDER BY {order}) - 1) % {page} AS INTEGER)
      AS pos, ts
  FROM valid"""

_BATCHES = """b AS (
  SELECT event_type AS job, event_id AS batch_id, user_id AS size, value AS duration,
    event_id % 10 <> 0 AS success,
    CASE WHEN event_id % 20 = 0 THEN 'TransportError'
         WHEN event_id % 10 = 0 THEN 'ConnectionTimeout' END AS error_type, ts
  FROM events)"""

_CHUNKS = """c AS (
  SELECT *, CASE WHEN status IN ('completed', 'failed')
      THEN start_time + to_seconds(o_orderkey % 600) END AS end_time,
    CASE WHEN status IN ('completed', 'failed') THEN CAST(o_orderkey % 600 AS DOUBLE) END AS secs
  FROM (SELECT o_orderkey, 'log_' || o_orderkey AS chunk_id,
      CAST(round(o_totalprice * 100) AS BIGINT) AS size_bytes,
      CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'processing'
        WHEN o_orderkey % 2 = 0 THEN 'failed' ELSE 'pending' END AS status,
      CAST(o_orderkey % 5 AS INTEGER) AS attempt_count, o_orderpriority,
      o_orderdate AS start_time
    FROM orders)),
recent AS (SELECT size_bytes, secs FROM c WHERE status = 'completed' AND secs <> 0
  ORDER BY end_time DESC, chunk_id DESC LIMIT 100),
rate AS (SELECT sum(size_bytes) / sum(secs) AS bps FROM recent)"""


def _trend(key: str, value: str, source: str) -> str:
    return f"""SELECT {key}, round(mins, 4) AS duration_minutes, round(growth, 4) AS growth,
      round(growth / mins, 4) AS growth_per_minute, round(average, 4) AS average,
      round(peak, 4) AS peak, round(cur, 4) AS "current"
    FROM (SELECT {key}, (epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000.0 AS mins,
        arg_max({value}, ts) - arg_min({value}, ts) AS growth, avg({value}) AS average,
        max({value}) AS peak, arg_max({value}, ts) AS cur
      FROM {source}
      WHERE ts >= TIMESTAMP '2024-01-31' - to_minutes({TREND_MINUTES}) GROUP BY {key})
    WHERE mins > 0"""


def _steps(text: str, *steps: tuple[str, str]) -> str:
    for pattern, replacement in steps:
        pattern = pattern.replace("'", "''")
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


_NUMBER_STEP = (rf"(^|[^{_WORD}])\p{{Nd}}+($|[^{_WORD}])", r"\1?\2")
_IN_STEPS = (
    (rf"(?i)IN[{_BLANK}]*\([^)]*\z", "IN (...)"),
    (rf"(?i)IN[{_BLANK}]*\([^)]+\)", "IN (...)"),
)
_SHORT = _steps(
    "body",
    (rf"[{_BLANK}]+", " "),
    (rf"(?i)IN[{_BLANK}]*\([^)]+\)", "IN (...)"),
    (rf"(?i)VALUES[{_BLANK}]*\([^)]+\)", "VALUES (...)"),
    (rf"(?i)CASE[{_BLANK}]+WHEN.+?END", "CASE ... END"),
    (r"'[^']{100,}'", "''...''"),
    (rf"\p{{Nd}}+(?:[{_BLANK}]*,[{_BLANK}]*\p{{Nd}}+){{5,}}", "..."),
    (r"(?i)ORDER BY.*?(?:,.*?){5,}", "ORDER BY ..."),
    (r"(?i)GROUP BY.*?(?:,.*?){5,}", "GROUP BY ..."),
)

ORACLES: dict[str, str] = {
    "parse_blocks": _with_events(f"SELECT {_PARSED} FROM ev"),
    "read_slow_log": _with_events(f"SELECT {_PARSED} FROM ev"),
    "parse_compat_rows": _with_events(f"SELECT {_PARSED_ZERO_ROWS} FROM ev"),
    "parse_single_file": _with_events(f"SELECT {_SINGLE} FROM ev"),
    "valid_queries": _with_events(f"SELECT {_PARSED} FROM valid"),
    "valid_single_file": _with_events(
        f"SELECT {_SINGLE} FROM ev WHERE value >= 0.1 AND kind <> 3"
    ),
    "rejects": _with_events(
        f"SELECT {_PARSED}, reject_reason FROM ev WHERE reject_reason IS NOT NULL"
    ),
    "reject_summary": _with_events(
        "SELECT reject_reason, count(*) AS blocks FROM ev"
        " WHERE reject_reason IS NOT NULL GROUP BY reject_reason"
    ),
    "parse_variants": expected_fields(),
    "parse_variants_single": expected_fields(single=True),
    "read_variants": expected_fields(key=False),
    "read_variants_single": expected_fields(single=True, key=False),
    "variant_rejects": expected_rejects(),
    "variant_digest": expected_digest(f"{PREFIX}-{INSTANCE}"),
    "variant_digest_single": expected_digest(f"{PREFIX}-{INSTANCE}", single=True),
    "collapse_blanks": f"SELECT doc_id, {_steps('text', (f'[{_BLANK}]+', ' '))} AS text"
    " FROM documents",
    # A match takes the character behind a number too, so a second pass finds its neighbours.
    "normalize_numbers": f"SELECT doc_id, {_steps('text', _NUMBER_STEP, _NUMBER_STEP)} AS text"
    " FROM documents",
    "normalize_strings": "SELECT doc_id, "
    + _steps("text", (r""""[^"]*"|'[^']*'""", "?"))
    + " AS text FROM documents",
    "normalize_in": "SELECT doc_id, "
    + _steps("sql", *_IN_STEPS)
    + """ AS text FROM (SELECT doc_id, 'SELECT max(a), Min(b) FROM t WHERE a in  ('
        || text || CASE WHEN doc_id % 2 = 0 THEN ') AND b = 2' ELSE '' END AS sql FROM documents)""",
    "strip_meta": _with_events(
        """SELECT event_id, '  -- note' || chr(10) || CASE kind
          WHEN 1 THEN replace(replace(query, ' FROM', chr(10) || 'FROM'), ' WHERE ',
            chr(10) || '  WHERE ')
          WHEN 2 THEN replace(replace(replace(query, 'use shop; ', 'use shop;' || chr(10)),
            ' JOIN', chr(10) || chr(9) || 'JOIN'), ' WHERE', chr(10) || 'WHERE')
          ELSE query END AS text FROM ev"""
    ),
    "last_statement": _with_events(
        """SELECT event_id, rtrim(CASE kind
          WHEN 1 THEN replace(replace(query, ' FROM', chr(10) || 'FROM'), ' WHERE ',
            chr(10) || '  WHERE ')
          WHEN 2 THEN replace(replace(replace(query, 'use shop; ', ''),
            ' JOIN', chr(10) || chr(9) || 'JOIN'), ' WHERE', chr(10) || 'WHERE')
          ELSE query END, ';') AS text FROM ev"""
    ),
    "query_fingerprint": _with_events(
        "SELECT event_id, normalized_query, md5(normalized_query) AS query_hash FROM ev"
    ),
    "query_fingerprint_rehash": _with_events(
        "SELECT event_id, md5(normalized_query) AS query_hash FROM ev"
    ),
    # Lines that start with # are header lines; the others are the statement.
    "compress_oversized": f"""WITH s AS (SELECT doc_id,
          '# Query_time: 1.0  Lock_time: 0.0' || chr(10) || 'SELECT case when a then ''' || text
          || ''' end, 1, 2,3 , 4,5,6,' || doc_id || ' FROM t WHERE a in (1, ' || doc_id
          || ') GROUP BY a,b,c,d,e,f,g ORDER BY a,b;' || chr(10) || 'INSERT INTO t VALUES (' || text || ');' AS whole
        FROM documents),
      l AS (SELECT *, string_split(whole, chr(10)) AS ls FROM s),
      p AS (SELECT *,
          array_to_string(list_filter(ls, lambda x: NOT starts_with(x, '#')), ' ') AS body,
          array_to_string(list_transform(list_filter(ls, lambda x: starts_with(x, '#')),
            lambda x: chr(10) || x), '') AS head FROM l),
      r AS (SELECT *, strlen(whole) > {COMPRESS_ABOVE} AS big, {_SHORT} AS short FROM p)
      SELECT doc_id,
        CASE WHEN NOT big THEN NULL WHEN strlen(short) <= strlen(body) * 0.5 THEN 'compressed'
          ELSE 'dropped' END AS oversize,
        CASE WHEN NOT big THEN whole
          WHEN strlen(short) <= strlen(body) * 0.5 THEN head || chr(10) || short
          ELSE head END AS block
      FROM r""",
    "digest": _DIGEST,
    "digest_arrival": _DIGEST_ARRIVAL,
    "digest_stored": _DIGEST,
    "digest_stored_arrival": _DIGEST_ARRIVAL,
    "digest_arrival_rotated": _DIGEST_ROTATED,
    "digest_single_file": _DIGEST_SINGLE,
    "merge_digest": _DIGEST,
    "merge_digest_stored": _DIGEST,
    "run_batch": _DIGEST,
    "digest_occurrences": _with_events("SELECT DISTINCT instance_id, query_hash, ts FROM valid"),
    "digest_documents": _with_events(_PAGES.format(order="ts", page=PAGE)),
    "digest_documents_arrival": _with_events(_PAGES.format(order="event_id", page=PAGE)),
    "expire_digest": _with_events(
        f"SELECT * FROM ({_digest()})"
        f" WHERE last_seen > TIMESTAMP '2024-01-31' - to_days({EXPIRE_DAYS})"
    ),
    "expired_digest": _with_events(
        f"SELECT count(*) AS expired FROM ({_digest()})"
        f" WHERE last_seen <= TIMESTAMP '2024-01-31' - to_days({EXPIRE_DAYS})"
    ),
    "write_digest": _DIGEST,
    "digest_stats": _with_events(
        "SELECT count(DISTINCT query_hash) AS document_count, true AS has_bytes FROM valid"
    ),
    "upsert_actions": _with_events(
        f"""SELECT 'update' AS op_type, '{PREFIX}-{INSTANCE}' AS index_name, query_hash AS id,
          timestamp_raw AS param_timestamp, query_time AS param_query_time, query,
          normalized_query, user_name, rows_examined, CAST(1 AS BIGINT) AS execution_count,
          timestamp_raw AS timestamps, timestamp_raw AS last_seen, CAST(3 AS BIGINT) AS retries
        FROM valid"""
    ),
    "upsert_fields": _with_events(
        f"""SELECT 'update' AS op_type, '{PREFIX}-{INSTANCE}' AS index_name, query_hash AS id,
          CAST(3 AS BIGINT) AS retries, true AS has_source, 'painless' AS lang, timestamp_raw AS param_timestamp,
          query_time AS param_query_time, timestamp_raw AS timestamps, user_name, user_host,
          timestamp_raw AS first_seen, query, normalized_query, query_hash, query_time, lock_time, rows_examined,
          rows_sent, CAST(1 AS BIGINT) AS execution_count, query_time AS max_query_time,
          timestamp_raw AS last_seen, instance_id FROM valid"""
    ),
    "upsert_applied": _with_events(
        f"""SELECT '{PREFIX}-{INSTANCE}' AS index_name, query_hash AS id, arg_min(query, ts) AS query,
          any_value(normalized_query) AS normalized_query, arg_min(user_name, ts) AS user_name,
          arg_min(query_time, ts) AS query_time, arg_min(rows_examined, ts) AS rows_examined,
          count(*) AS execution_count, count(DISTINCT timestamp_raw) AS n_timestamps,
          max(query_time) AS max_query_time, max(timestamp_raw) AS last_seen
        FROM valid GROUP BY query_hash"""
    ),
    "load_rejects": _with_events(
        "SELECT coalesce(reject_reason, 'valid') AS reject_reason, count(*) AS blocks FROM ev GROUP BY 1"
    ),
    "stream_digest": _DIGEST,
    "expire_table": f"""WITH {_EVENTS}, {_GONE},
      held AS (SELECT * FROM valid WHERE query_hash NOT IN (SELECT query_hash FROM gone)
        UNION ALL SELECT * FROM valid WHERE event_id % 7 = 0 AND day(ts) <= 15)
      {_digest(source="held")}""",
    "expire_table_counts": f"""WITH {_EVENTS}, {_GONE},
      old AS (SELECT * FROM valid WHERE query_hash IN (SELECT query_hash FROM gone)),
      refused AS (SELECT * FROM ev WHERE reject_reason IS NOT NULL AND ts <= {_CUTOFF})
      SELECT (SELECT count(*) FROM gone) AS digests,
        (SELECT count(*) FROM (SELECT DISTINCT query_hash, ts FROM old)) AS occurrences,
        (SELECT count(*) FROM old) + (SELECT count(*) FROM refused) AS records,
        (SELECT count(*) FROM ev) - (SELECT count(*) FROM old) - (SELECT count(*) FROM refused)
          AS records_left""",
    "table_occurrences": _with_events("SELECT DISTINCT instance_id, query_hash, ts FROM valid"),
    "two_writers": _with_events(f"SELECT *, CAST(1 AS BIGINT) AS refused FROM ({_digest()})"),
    "stream_replay": _DIGEST,
    "run_summary": f"""WITH {_BATCHES} SELECT job, CAST(sum(size) AS BIGINT) AS processed_queries,
        CAST(sum(CASE WHEN success THEN size ELSE 0 END) AS BIGINT) AS indexed_documents,
        CAST(sum(CASE WHEN success THEN 0 ELSE size END) AS BIGINT) AS error_count,
        round(sum(duration), 4) AS total_duration, count(*) AS batches_processed,
        round(avg(duration), 4) AS average_batch_duration FROM b GROUP BY job""",
    "batch_summary": f"""WITH {_BATCHES} SELECT job, CAST(sum(size) AS BIGINT) AS total_documents,
        CAST(sum(CASE WHEN success THEN size ELSE 0 END) AS BIGINT) AS successful_documents,
        CAST(sum(CASE WHEN success THEN 0 ELSE size END) AS BIGINT) AS failed_documents,
        round(sum(CASE WHEN success THEN size ELSE 0 END) * 100.0 / sum(size), 4) AS success_rate,
        count(*) AS total_batches, round(sum(duration), 4) AS total_processing_time,
        round(avg(size), 4) AS average_batch_size, round(avg(duration), 4) AS average_batch_time,
        round(sum(size) / sum(duration), 4) AS documents_per_second FROM b GROUP BY job""",
    "error_distribution": f"""WITH {_BATCHES} SELECT job, error_type, count(*) AS occurrences
        FROM b WHERE error_type IS NOT NULL GROUP BY job, error_type""",
    "error_list": f"""WITH {_BATCHES} SELECT ts AS "timestamp", error_type AS error
        FROM b WHERE error_type IS NOT NULL""",
    "batch_running_totals": f"""WITH {_BATCHES} SELECT job, batch_id,
        CAST(sum(CASE WHEN success THEN size ELSE 0 END) OVER w AS BIGINT) AS success_count,
        CAST(sum(CASE WHEN success THEN 0 ELSE size END) OVER w AS BIGINT) AS error_count
      FROM b WINDOW w AS (PARTITION BY job ORDER BY batch_id)""",
    "batch_rolling_mean": f"""WITH {_BATCHES} SELECT job, batch_id,
        CASE WHEN row_number() OVER w >= 10 THEN round(avg(duration) OVER l, 4) END AS rolling_mean
      FROM b WINDOW w AS (PARTITION BY job ORDER BY batch_id),
        l AS (PARTITION BY job ORDER BY batch_id ROWS 9 PRECEDING)""",
    "batch_running_totals_sparse": f"""WITH {_BATCHES} SELECT job,
        batch_id * {SPARSE} - 1000000000000000 AS batch_id,
        CAST(sum(CASE WHEN success THEN size ELSE 0 END) OVER w AS BIGINT) AS success_count,
        CAST(sum(CASE WHEN success THEN 0 ELSE size END) OVER w AS BIGINT) AS error_count
      FROM b WINDOW w AS (PARTITION BY job ORDER BY batch_id)""",
    "batch_rolling_mean_sparse": f"""WITH {_BATCHES} SELECT job,
        batch_id * {SPARSE} - 1000000000000000 AS batch_id,
        CASE WHEN row_number() OVER w >= 10 THEN round(avg(duration) OVER l, 4) END AS rolling_mean
      FROM b WINDOW w AS (PARTITION BY job ORDER BY batch_id),
        l AS (PARTITION BY job ORDER BY batch_id ROWS 9 PRECEDING)""",
    "batch_rolling_mean_short": f"""WITH {_BATCHES} SELECT job, batch_id,
        round(avg(size) OVER l, 4) AS rolling_mean
      FROM b WINDOW l AS (PARTITION BY job ORDER BY batch_id ROWS 4 PRECEDING)""",
    "chunk_status": f"""WITH {_CHUNKS} SELECT
        count(*) FILTER (status = 'pending') AS pending,
        count(*) FILTER (status = 'processing') AS processing,
        count(*) FILTER (status = 'completed') AS completed,
        count(*) FILTER (status = 'failed') AS failed FROM c""",
    "failed_chunks": f"""WITH {_CHUNKS} SELECT chunk_id, attempt_count, o_orderpriority AS error
      FROM c WHERE status = 'failed'""",
    "retryable_chunks": f"""WITH {_CHUNKS} SELECT chunk_id FROM c
      WHERE status = 'failed' AND attempt_count < 3""",
    "chunk_progress": f"""WITH {_CHUNKS} SELECT count(*) AS total_chunks,
        count(*) FILTER (status = 'completed') AS completed_chunks,
        count(*) FILTER (status = 'failed') AS failed_chunks,
        count(*) FILTER (status = 'processing') AS processing_chunks,
        CAST(sum(size_bytes) FILTER (status = 'completed') AS BIGINT) AS processed_bytes,
        CAST(sum(size_bytes) AS BIGINT) AS total_bytes,
        round(sum(size_bytes) FILTER (status = 'completed') / sum(size_bytes) * 100, 2)
          AS progress_percentage,
        round(count(*) FILTER (status = 'completed') / count(*) * 100, 2) AS chunk_percentage,
        round(avg(secs) FILTER (status = 'completed'), 4) AS average_chunk_seconds FROM c""",
    "chunk_duration": f"WITH {_CHUNKS} SELECT chunk_id, secs AS duration_seconds FROM c",
    "recent_rate": f"WITH {_CHUNKS} SELECT round(bps, 4) AS bytes_per_second FROM rate",
    "run_rate": f"""WITH {_CHUNKS} SELECT round(sum(size_bytes) FILTER (status = 'completed')
        / (epoch(TIMESTAMP '2002-01-01') - epoch(min(start_time))), 4) AS bytes_per_second FROM c""",
    "completion_estimate": f"""WITH {_CHUNKS},
      done AS (SELECT CAST(sum(size_bytes) AS BIGINT) AS n FROM c WHERE status = 'completed')
      SELECT n AS processed_bytes, {TOTAL_BYTES} - n AS remaining_bytes,
        round(bps, 4) AS bytes_per_second,
        date_trunc('second', TIMESTAMP '2024-01-31'
          + to_microseconds(CAST(round(({TOTAL_BYTES} - n) / bps * 1000000) AS BIGINT)))
          AS estimated_completion
      FROM done, rate""",
    "trailing_trend": _trend("event_type", "value", "events"),
    "fingerprint_trend": _with_events(_trend("query_hash", "query_time", "valid")),
    "series_growth": """SELECT event_type,
      round(arg_max(value, ts) - arg_min(value, ts), 4) AS growth FROM events GROUP BY event_type""",
    "threshold_status": """SELECT event_id, CASE WHEN value >= 76.8 THEN 'critical'
      WHEN value >= 51.2 THEN 'warning' ELSE 'normal' END AS status FROM events""",
}
