"""Shortening of oversized statements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slowdigest.functions.text import BLANK, DIGIT, replace

_B = f"[{BLANK}]"

# What is shortened and to what, in this order.  Words match in any case.
COMPRESSION_STEPS = (
    (f"{_B}++", " "),
    (rf"[Ii\u0130\u0131][Nn]{_B}*+\([^)]++\)", "IN (...)"),
    (rf"(?i:VALUES){_B}*+\([^)]++\)", "VALUES (...)"),
    (rf"(?i:CASE){_B}++(?i:WHEN).+?(?i:END)", "CASE ... END"),
    (r"'[^']{100,}+'", "'...'"),
    (rf"{DIGIT}(?<!{DIGIT}{{2}}){DIGIT}*+(?:{_B}*+,{_B}*+{DIGIT}++){{5,}}+", "..."),
    (r"(?i:ORDER BY)(?:[^,]*+,){5}+,*+", "ORDER BY ..."),
    (r"(?i:GROUP BY)(?:[^,]*+,){5}+,*+", "GROUP BY ..."),
)
# Fixed value: a shortened statement is kept when at most this share of its bytes is left.
MAX_SHARE = 0.5


def shorten(c: Column) -> Column:
    """All steps, whatever they save."""
    for pattern, replacement in COMPRESSION_STEPS:
        c = replace(c, pattern, replacement)
    return c


def enough_saved(shortened: Column, original: Column) -> Column:
    return F.octet_length(shortened) <= F.octet_length(original) * MAX_SHARE
