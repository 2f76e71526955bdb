"""From log text to one row per statement block, and from a block to its fields.

A *block* is the text after one ``# Time:`` marker up to the next; its first
line is the rest of the marker line.  All fields come from Column expressions on
the block, so scan, split and parse run in one stage without a shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowdigest.functions.compress import enough_saved, shorten
from slowdigest.functions.text import (
    BLANK,
    BLANK_IN_LINE,
    LINE_START,
    WORD,
    after_first_line,
    first_line,
    join_lines,
    like,
    replace,
)

PROFILES = ("modular", "single_file")

# Texts that mark the lines a server writes when it opens a log.
SERVER_LINE_MARKS = (
    r"Version: 8\.0\.28",
    r"started with:",
    r"Tcp port:",
    rf"Time[{BLANK_IN_LINE}]+Id Command[{BLANK_IN_LINE}]+Argument",
)
# A text without any of these has no such line.
_SERVER_LINE_HINTS = ("Version: 8.0.28", "started with:", "Tcp port:", "Id Command")

# What may follow a marker on its line: a blank, nothing, or a time without a blank before it
# (ISO, the older "yymmdd hh:mm:ss", epoch millis).
_MARKER_REST = (
    r"\A(?:[\s\x1c-\x1f]|\d{4}-\d{2}-\d{2}|\d{6} +\d{1,2}:\d{2}:\d{2}|\d{10,}(?:\s|\z))"
)

_HB = f"[{BLANK_IN_LINE}]"
_TIMES = rf"Query_time:{_HB}*([0-9]+\.?[0-9]*){_HB}+Lock_time:{_HB}*([0-9]+\.?[0-9]*)"
_TIMES_ANY = rf"Query_time:{_HB}*[0-9]+\.?[0-9]*{_HB}+Lock_time:{_HB}*[0-9]"
_ROWS = rf"Rows_examined:{_HB}*([0-9]+){_HB}+Rows_sent:{_HB}*([0-9]+)"
# Two shapes of a user line: "name[login] @ host" first, then any bracket groups and host.
_USER_PLAIN = rf"# User@Host: ([{WORD}]+){_HB}*(?:\[[{WORD}\-]+\])?{_HB}*@{_HB}*([{WORD}.\-]+)"
_USER_LOOSE = rf"# User@Host: ([{WORD}]+)(?:\[[^\]\n]+\])*{_HB}*@{_HB}*([^{BLANK}]+)"
_USER_STRICT = rf"# User@Host:{_HB}*([{WORD}]+)\[[{WORD}]+\]{_HB}*@{_HB}*([{WORD}.\-]+)"


def _common_head(single: bool) -> str:
    """The head that nearly every block has, for one anchored pass.

    Groups: time, name, host, bare address, query time, lock time, rows sent, rows examined,
    and a ``use`` line.  It admits only what the line rules would read the same way: in the
    modular profile also names without brackets and a bare address for a host.
    """
    number = r"[0-9]++(?:\.[0-9]*+)?"
    address = r"\[[0-9a-fA-F.:]*+\]"
    login = rf"\[[{WORD}]++\]" if single else rf"(?:\[[{WORD}\-]++\])?+"
    host = rf"([{WORD}.\-]++)(?:\x20*+{address})?+"
    # Group 4 is there in both profiles, so that the fields have the same numbers.
    host = rf"{host}((?!))?+" if single else rf"(?:{host}|\x20*+({address}))"
    skipped = r"(?:\nSET timestamp=[^\n]*+)?" if not single else ""
    return (
        r"\A\x20?([!-~]++(?:\x20++[!-~]++)?)\n"
        rf"# User@Host: ([{WORD}]++){login} @ {host}"
        r"\x20*+(?:Id:\x20*+[0-9]++)?\x20*+\n"
        rf"# Query_time: ({number})\x20++Lock_time: ({number})"
        r"\x20++Rows_sent: ([0-9]++)\x20++Rows_examined: ([0-9]++)"
        # Further fields, as servers write them on request.
        r"(?:\x20++[A-Za-z_]++:\x20*+[!-~]++)*+\x20*+(?=\n)"
        # A "use" line may stand in front of the skipped one and is kept.
        rf"((?:\nuse [^\n]*+)?){skipped}"
    )


def check_profile(profile: str) -> None:
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")


def split_blocks(
    df: DataFrame,
    text_col: str = "value",
    *,
    marker_consumed: bool = False,
    profile: str = "modular",
) -> DataFrame:
    """Cut ``text_col`` at ``# Time:`` lines into one row per block.

    Other columns are kept.  Adds ``block`` (see the module docstring) and
    ``has_time``: false for text in front of the first marker.  With
    ``marker_consumed`` the text was already cut at markers by the reader, and
    ``split_start`` says where its piece of the file begins.  Behind the start of a
    file every text follows a marker, whatever it looks like.  In a file's first piece
    one text may stand before any marker; it is told by its first character, because a
    marker is followed by a blank, by the line's end or by a time.
    """
    check_profile(profile)
    # Lines are stripped before the marker test, except in the single_file profile.
    indent = f"[{BLANK_IN_LINE}]*+" if profile == "modular" else ""
    text = F.col(text_col)
    pieces = F.split(text, rf"(?U)(?:\A|\n){indent}# Time:")
    if marker_consumed:
        # Only indented markers and one that starts a file are left to cut at.
        pieces = F.when(F.contains(text, F.lit("# Time:")), pieces).otherwise(F.array(text))
        leads = like(F.col("block"), _MARKER_REST)
        if "split_start" in df.columns:
            leads = (F.col("split_start") > 0) | leads
    else:
        leads = F.lit(False)
    others = [c for c in df.columns if c != text_col]
    cut = df.select(*others, F.posexplode(pieces).alias("pos", "block"))
    # A leading piece carries no marker line: a blank one is no block at all.
    filled = like(F.substring("block", 1, 64), f"[^{BLANK}]") | like(F.col("block"), f"[^{BLANK}]")
    return cut.filter((F.col("pos") > 0) | filled).select(
        *others, ((F.col("pos") > 0) | leads).alias("has_time"), "block"
    )


def compress_blocks(df: DataFrame, max_bytes: int) -> DataFrame:
    """Shorten the statement text of blocks above ``max_bytes`` UTF-8 bytes.

    Header lines stay.  Where shortening leaves more than half of the statement's
    bytes, the block text is dropped.  Adds ``oversize``: null, 'compressed' or
    'dropped'.
    """
    if max_bytes <= 0:
        raise ValueError("max_bytes must be positive")
    big = F.octet_length("block") > max_bytes
    # A leading newline lets every line be matched the same way.
    body = F.concat(
        F.when(F.col("has_time"), F.lit("")).otherwise(F.lit("\n")), F.col("block")
    )
    lines = F.when(F.col("has_time"), after_first_line(body)).otherwise(body)
    staged = (
        df.withColumn("_lines", F.when(big, lines))
        .withColumn("_text", F.regexp_replace("_lines", r"\n#[^\n]*+", ""))
        .withColumn("_text", F.regexp_replace(F.substr("_text", F.lit(2)), "\n", " "))
        .withColumn("_short", shorten(F.col("_text")))
    )
    fits = enough_saved(F.col("_short"), F.col("_text")) & (F.length("_text") > 0)
    head = F.concat(
        F.when(F.col("has_time"), F.substring_index("block", "\n", 1)).otherwise(F.lit("")),
        F.regexp_replace("_lines", r"\n(?!#)[^\n]*+", ""),
    )
    status = F.when(~big, F.lit(None)).when(fits, "compressed").otherwise("dropped")
    rebuilt = (
        F.when(F.col("oversize").isNull(), F.col("block"))
        .when(F.col("oversize") == "compressed", F.concat(head, F.lit("\n"), "_short"))
        .otherwise(head)
    )
    return (
        staged.withColumn("oversize", status)
        .withColumn("block", rebuilt)
        .drop("_lines", "_text", "_short")
    )


def _to_timestamp(raw: Column) -> Column:
    """ISO times; else the older form or epoch milliseconds; null for other text."""
    iso = F.substring(raw, 5, 1) == "-"
    older = F.try_to_timestamp(F.regexp_replace(raw, " +", " "), F.lit("yyMMdd H:mm:ss"))
    # Up to 15 digits, so that the conversion to microseconds cannot overflow.
    millis = F.when(F.regexp_like(raw, F.lit(r"\A[0-9]{10,15}\z")), raw.try_cast("bigint"))
    return F.when(iso, raw.try_cast("timestamp")).otherwise(
        F.coalesce(older, F.timestamp_millis(millis))
    )


def _last_line(head: Column, line: str, fields: str) -> Column:
    """``fields`` (group references) from the last line that matches; '' where none does."""
    return replace(head, rf"\A(?:.*(?:{line}))?.*+", fields, "s")


def _line(body: str, *, starts: str = "#", unless: tuple[str, ...] = (), indent: bool = True) -> str:
    """Regex for a whole header line that starts with ``starts`` and holds ``body``."""
    start = LINE_START if indent else r"\n"
    skips = "".join(rf"(?![^\n]*?{u})" for u in unless)
    return rf"{start}(?={starts}){skips}[^\n]*?{body}"


def _fields_by_rules(head: Column, single: bool, compat_rows: bool) -> Column:
    """Name, host, query time, lock time, rows sent and rows examined, tab-separated.

    ``head`` holds header lines only; of several lines with a field the last counts.
    """
    if single:
        users = _line(_USER_STRICT, starts="# User@Host:")
        user = _last_line(head, users, "$1\t$2")
        indented = _line(_TIMES, starts="# Query_time:")
        # A Query_time line without indent takes precedence over an indented one.
        flush_left = _line(_TIMES, starts="# Query_time:", indent=False)
        times = F.concat(
            replace(head, rf"\A(?:.*{flush_left}|.*{indented})?.*+", "$1$3\t", "s"),
            _last_line(head, indented, "$2"),
        )
        row_line = _line(_ROWS, starts="# Rows_examined:")
    else:
        # On one line the plain shape goes before the loose one.
        users = rf"{_line(_USER_PLAIN)}|{_line(_USER_LOOSE)}"
        user = _last_line(head, users, "$1$3\t$2$4")
        times = _last_line(head, _line(_TIMES, unless=("User@Host:",)), "$1\t$2")
        row_line = _line(_ROWS, unless=("User@Host:", _TIMES_ANY))
    if single or compat_rows:
        rows = _last_line(head, row_line, "$2\t$1")
    else:
        sent, examined = (
            _last_line(head, _line(rf"{name}:{_HB}*([0-9]+)", unless=("User@Host:",)), "$1")
            for name in ("Rows_sent", "Rows_examined")
        )
        rows = F.concat(sent, F.lit("\t"), examined)
    return F.concat(user, F.lit("\t"), times, F.lit("\t"), rows)


def parse_blocks(
    df: DataFrame,
    *,
    profile: str = "modular",
    compat_rows: bool = False,
    drop_preamble: bool = False,
) -> DataFrame:
    """Parse ``block`` rows into the columns of ``PARSED_SCHEMA``.

    Needs ``block`` and ``has_time``; ``instance_id``, ``source_file``,
    ``source_modified`` and ``split_start`` are used where present.  Further columns are kept at the end.

    ``compat_rows`` reads the row counts only where ``Rows_examined`` stands
    before ``Rows_sent`` on a line without ``Query_time``; the default reads each
    on its own.  A count beyond the range of longs is null, a missing one 0.  ``drop_preamble`` removes lines that a server writes on
    start; a statement line with the same words goes with them, so it is off unless asked for.
    """
    check_profile(profile)
    single = profile == "single_file"
    known = ("block", "has_time", "instance_id", "source_file", "source_modified", "split_start")
    others = [c for c in df.columns if c not in known]

    def given(name: str, kind: str) -> Column:
        return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)

    timed, block = F.col("has_time"), F.col("block")
    # Fields are cut out as one tab-separated text: name, host, query time, lock time,
    # rows sent, rows examined, and for the common head also time and statement.
    # The common head has its row counts on the Query_time line, where the
    # single_file profile and compat_rows do not look.
    counts = "0\t0" if single or compat_rows else "$7\t$8"
    common_fields = f"$2\t$3$4\t$5\t$6\t{counts}\t$1\t$9"
    base = df.select(
        given("instance_id", "string"),
        given("source_file", "string"),
        given("source_modified", "timestamp"),
        given("split_start", "bigint"),
        "has_time",
        "block",
        replace(F.when(timed, block), _common_head(single), common_fields).alias("_cut"),
        *others,
    )
    # The short way is right if the head was found and the statement has nothing in
    # it that the line rules could drop.  Every other block takes those rules.
    odd = ["#"] + ([] if single else ["SET timestamp="])
    odd += _SERVER_LINE_HINTS if drop_preamble else ()
    plain = ~reduce(or_, (F.contains("_cut", F.lit(text)) for text in odd))
    common = F.coalesce((F.col("_cut") != block) & plain, F.lit(False))
    rest = F.when(timed, after_first_line(block)).otherwise(F.concat(F.lit("\n"), block))
    if drop_preamble:
        rest = replace(rest, rf"\n[^\n]*?(?:{'|'.join(SERVER_LINE_MARKS)})[^\n]*+", "")
    base = base.withColumn("_common", common).withColumn("_lines", F.when(~common, rest))

    # Header lines only: the last-line-wins searches then skip the statement.
    head = replace(F.col("_lines"), rf"{LINE_START}(?!#)[^\n]*+", "")
    base = base.withColumn("_head", head)
    by_rules = _fields_by_rules(F.col("_head"), single, compat_rows)
    fields = F.split(F.when(F.col("_common"), F.col("_cut")).otherwise(by_rules), "\t", 8)

    dropped = "#" if single else "(?:#|SET timestamp=)"
    statement = F.when(F.col("_common"), F.element_at("_field", 8)).otherwise(
        replace(F.col("_lines"), rf"{LINE_START}{dropped}[^\n]*+", "")
    )
    at = F.when(F.col("_common"), F.element_at("_field", 7)).otherwise(
        F.when(timed, first_line(block))
    )

    def number(position: int, kind: str) -> Column:
        return F.coalesce(F.element_at("_field", position).try_cast(kind), F.lit(0).cast(kind))

    def counted(position: int) -> Column:
        # A line without the field gives 0; a count too large for a long gives null.
        text = F.element_at("_field", position)
        return F.when(text != "", text.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    parsed = F.struct(
        F.col("_at").alias("timestamp_raw"),
        _to_timestamp(F.col("_at")).alias("ts"),
        F.element_at("_field", 1).alias("_name"),
        F.element_at("_field", 2).alias("_host"),
        number(3, "double").alias("query_time"),
        number(4, "double").alias("lock_time"),
        counted(5).alias("rows_sent"),
        counted(6).alias("rows_examined"),
        join_lines(F.col("_statement")).alias("query"),
    )
    read = (
        base.withColumn("_field", fields)
        .withColumn("_statement", statement)
        .withColumn("_at", at)
    )

    def given_text(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    # A generator, unlike a projection, is not evaluated again for a filter on its
    # results: the fields are computed once per block whatever comes after.
    once = read.select(
        "instance_id",
        "source_file",
        "source_modified",
        "split_start",
        *others,
        F.inline(F.array(parsed)),
    )
    return once.select(
        "instance_id",
        "source_file",
        # The row number is taken after the split, so it orders blocks of one row too.
        F.struct(
            F.col("source_modified").alias("modified"),
            F.col("source_file").alias("file"),
            F.col("split_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
        given_text("timestamp_raw").alias("timestamp_raw"),
        "ts",
        F.struct(given_text("_name").alias("name"), given_text("_host").alias("host")).alias("user"),
        "query_time",
        "lock_time",
        "rows_examined",
        "rows_sent",
        "query",
        *others,
    )
