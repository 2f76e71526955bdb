"""Regex helpers and character classes shared by the parser and the normaliser.

All patterns run with Java's ``(?U)``, so that blanks and letters of every script
count.  ``BLANK`` adds the four separators that Unicode text handling strips too
but ``\\s`` leaves out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class bodies, to be put between [ and ].
BLANK = r"\s\x1c-\x1f"
BLANK_IN_LINE = r"\s\x1c-\x1f&&[^\n]"
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"

# Start of a line inside a text that begins with a newline.
LINE_START = rf"\n[{BLANK_IN_LINE}]*+"


def replace(c: Column, pattern: str, by: str, flags: str = "") -> Column:
    return F.regexp_replace(c, f"(?U{flags}){pattern}", by)


def extract(c: Column, pattern: str, group: int, flags: str = "") -> Column:
    return F.regexp_extract(c, f"(?U{flags}){pattern}", group)


def like(c: Column, pattern: str, flags: str = "") -> Column:
    return F.regexp_like(c, F.lit(f"(?U{flags}){pattern}"))


def strip(c: Column) -> Column:
    """Remove blanks at both ends; text of blanks only becomes ''."""
    return extract(c, rf"\A[{BLANK}]*+(.*[^{BLANK}])", 1, "s")


def join_lines(c: Column) -> Column:
    """Strip every line, drop blank lines and join the rest with one space.

    ``c`` is read more than once and should be a plain column.
    """
    # Blanks in front of a newline are rare; the pattern that takes them has to
    # look at every character, so it runs only where they occur.
    trailing = like(c, rf"\n(?<=[{BLANK_IN_LINE}]\n)")
    # The look-behind starts a match only where a run of blanks begins, which
    # keeps long runs linear.
    thorough = replace(c, rf"(?<![{BLANK}])[{BLANK_IN_LINE}]*+\n[{BLANK}]*+", " ")
    return strip(F.when(trailing, thorough).otherwise(replace(c, rf"\n[{BLANK}]*+", " ")))


def first_line(c: Column) -> Column:
    return strip(F.substring_index(c, "\n", 1))


def after_first_line(c: Column) -> Column:
    """Everything from the first newline on, newline included; '' if there is none."""
    return extract(c, r"\n.*", 0, "s")

