"""SQL normalisation as a chain of Column functions.

Every step is a built-in regex expression, so a scan that fingerprints
statements stays in one generated stage.  Patterns use possessive quantifiers
wherever nothing after them could need the characters back: the run time is then
linear in the statement length and the JVM stack stays flat on huge statements.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slowdigest.functions.text import BLANK, DIGIT, WORD, extract, replace

# A statement part counts as SQL when it contains one of these.
STATEMENT_KEYWORDS = (
    "SELECT",
    "INSERT",
    "UPDATE",
    "DELETE",
    "WHERE",
    "FROM",
    "JOIN",
    "GROUP BY",
    "ORDER BY",
    "HAVING",
    "LIMIT",
)
# Labels of the request comments that applications prepend.
REQUEST_LABELS = ("REMOTE_ADDR", "URL", "Host")

_B = f"[{BLANK}]"
# A pattern's first letter is a plain class and only the rest ignores case by flag:
# the search for a start then needs no case folding at every character.
_SET_TIMESTAMP = rf"[Ss\u017f](?i:ET){_B}++(?i:timestamp){_B}*+={_B}*+{DIGIT}++{_B}*+;?+{_B}*+"
_USE = rf"\Ause{_B}++[{WORD}]++{_B}*+;?+{_B}*+"
_REQUEST_COMMENT = (
    rf"--{_B}*+(?:{'|'.join(REQUEST_LABELS)}){_B}*+:"
    rf"(?:{_B}*+(?!--|SELECT)[^;{BLANK}])*+"
    rf"(?={_B}*+(?:--|SELECT|\z))"
)
_INITIALS = "".join(sorted({k[0] + k[0].lower() for k in STATEMENT_KEYWORDS}))
_KEYWORD = rf"(?=[{_INITIALS}\u017f\u0130\u0131])(?i:{'|'.join(STATEMENT_KEYWORDS)})"
_LAST_STATEMENT = rf"\A(?:.*;)?{_B}*+([^;]*?{_KEYWORD}(?:[^;]*[^;{BLANK}])?)"
# The test for a word character in front comes after the digit: it then runs at digits only.
_NUMBER = rf"{DIGIT}(?<![{WORD}]{DIGIT}){DIGIT}*+(?![{WORD}])"
_QUOTED = r""""[^"]*+"|'[^']*+'"""
# Both cases of I and N, with the dotted and dotless forms that fold to them.
_IN_LIST = rf"[Ii\u0130\u0131][Nn]{_B}*+\((?:[^)]++\)|[^)]*+\z)"


def strip_set_timestamp(c: Column) -> Column:
    """Remove every ``SET timestamp=n;``."""
    return replace(c, _SET_TIMESTAMP, "")


def strip_use(c: Column) -> Column:
    """Remove a leading ``use db;`` with a plain database name."""
    return replace(c, _USE, "", "i")


def strip_request_comments(c: Column) -> Column:
    """Remove ``-- URL: …`` style comments up to the next comment, SELECT or end."""
    return replace(c, _REQUEST_COMMENT, "", "i")


def strip_meta(c: Column) -> Column:
    """The three removals above, in order."""
    return strip_request_comments(strip_use(strip_set_timestamp(c)))


def last_statement(c: Column) -> Column:
    """Last ``;``-separated part that looks like SQL, stripped; '' if none does.

    The split ignores quoting: a ``;`` inside a literal cuts too.
    """
    return extract(c, _LAST_STATEMENT, 1, "s")


def collapse_blanks(c: Column) -> Column:
    return replace(c, f"{_B}++", " ")


def mask_numbers(c: Column) -> Column:
    """Whole digit runs become ``?``; digits inside identifiers stay."""
    return replace(c, _NUMBER, "?")


def mask_strings(c: Column) -> Column:
    """Quoted text becomes ``?``; an unbalanced quote stays."""
    return replace(c, _QUOTED, "?")


def fold_in_lists(c: Column) -> Column:
    """``IN`` lists become ``IN (...)``, an unclosed one up to the end.

    There is deliberately no word boundary before ``IN``: ``min(a)`` is folded
    too, and fingerprints depend on it.
    """
    return replace(c, _IN_LIST, "IN (...)")


def normalize_query(c: Column) -> Column:
    """Fingerprint text of a statement; '' for null or non-SQL text."""
    statement = last_statement(strip_meta(F.coalesce(c, F.lit(""))))
    return fold_in_lists(mask_strings(mask_numbers(collapse_blanks(statement))))


def generate_hash(c: Column, rehash: bool = False) -> Column:
    """Hex MD5 of the normalised statement.

    ``rehash`` normalises twice, as the ``single_file`` profile does.
    """
    text = normalize_query(c)
    return F.md5(normalize_query(text) if rehash else text)
