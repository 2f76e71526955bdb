"""URL filters: glob rules as one bit-parallel automaton (Shift-And over several 64-bit words).

A glob is matched against a whole canonical URL, ``.`` + host + path. In it ``*`` stands for any bytes
but ``/``, ``**`` for any bytes, ``?`` for one byte other than ``/``, and everything else for itself. Every glob owns
one bit per symbol and one for its start; all of them are packed side by side, and one shift with carry,
one mask per byte and one self-loop mask per byte advance all globs of all URLs of a batch at once.

The longest rule that matches decides; globs without a rule behind them give the default verdict.

Defined cases: null urls and urls without ``://`` have empty host and path and match only globs that
match ``.``; the table may be empty; urls may be of any length (memory follows the bytes of a batch).
Ties of equally long rules go to the longer host, then to ``block``. Repeated rows are judged alike.
Input columns stay; one that has the name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowdigest.llm.common import ascii_lower


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, from ``path`` on."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


class ShiftAnd:
    """The packed automaton of some globs."""

    def __init__(self, globs: list[str]):
        masks: list[tuple[int, set[int], set[int]]] = []  # bit, bytes it is entered by, bytes it stays on
        self.starts, self.ends = [], []
        any_byte, segment = set(range(256)), set(range(256)) - {ord("/")}
        bit = 0
        for glob in globs:
            self.starts.append(bit)
            state = [set(), set()]
            raw, at = glob.encode(), 0
            while at < len(raw):
                if raw[at] == ord("*"):
                    double = raw[at : at + 2] == b"**"
                    state[1] |= any_byte if double else segment
                    at += 2 if double else 1
                    continue
                masks.append((bit, *state))
                bit += 1
                state = [segment if raw[at] == ord("?") else {raw[at]}, set()]
                at += 1
            masks.append((bit, *state))
            self.ends.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.enter = np.zeros((256, self.words), dtype=np.uint64)
        self.stay = np.zeros((256, self.words), dtype=np.uint64)
        for place, entered, kept in masks:
            one = np.uint64(1 << (place % 64))
            for table, chars in ((self.enter, entered), (self.stay, kept)):
                if chars:
                    table[sorted(chars), place // 64] |= one
        self.first = np.zeros(self.words, dtype=np.uint64)
        for place in self.starts:
            self.first[place // 64] |= np.uint64(1 << (place % 64))

    def match(self, texts: list[bytes]) -> np.ndarray:
        """A row per text, a column per glob: does the glob match the whole text?"""
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        data = np.frombuffer(b"".join(texts[k] for k in order), dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        state = np.repeat(self.first[None, :], len(texts), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        longer = len(texts)
        for at in range(int(sizes[0]) if len(texts) else 0):
            longer = int(np.searchsorted(-sizes[:longer], -at, side="left"))
            now, byte = state[:longer], data[begins[:longer] + at]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:longer] = (moved & self.enter[byte]) | (now & self.stay[byte])
        out = np.empty((len(texts), len(self.ends)), dtype=bool)
        for k, place in enumerate(self.ends):
            out[order, k] = (state[:, place // 64] >> np.uint64(place % 64)) & one == one
        return out


def canonical(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host (lower case) and path; both empty for null or without ``://``."""
    u = F.col(url)
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumns({"host": ascii_lower(host), "path": path})


def filter_urls(
    df: DataFrame,
    rules: list[Rule],
    globs: list[tuple[str, str]] = (),
    default: str = "allow",
    url: str = "url",
) -> DataFrame:
    """Add host, path, rule (text of the deciding rule, or null) and verdict.

    ``globs`` are further (verdict, glob) pairs for urls that no rule fits; the first that matches decides.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block", r.text))
    patterns = [r.glob for r in ranked] + [g for _, g in globs]
    verdicts = np.array([r.verdict for r in ranked] + [v for v, _ in globs] + [default], dtype=object)
    names = np.array([r.text for r in ranked] + [None] * (len(globs) + 1), dtype=object)

    @F.pandas_udf("struct<rule string, verdict string>")
    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = ShiftAnd(patterns)
        for batch in parts:
            texts = [b"." + h.encode() + p.encode() for h, p in zip(batch["host"], batch["path"])]
            hit = automaton.match(texts)
            hit = np.concatenate([hit, np.ones((len(texts), 1), dtype=bool)], axis=1)
            first = hit.argmax(axis=1)
            yield pd.DataFrame({"rule": names[first], "verdict": verdicts[first]})

    out = canonical(df, url)
    out = out.withColumn("verdict", judge(F.struct("host", "path")))
    return out.withColumn("rule", F.col("verdict.rule")).withColumn("verdict", F.col("verdict.verdict"))
