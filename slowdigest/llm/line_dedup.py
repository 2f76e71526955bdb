"""Line dedup: winnowing over line hashes.

Lines with a word are hashed; every window of ``run`` consecutive ones gives its smallest hash as a
fingerprint, so any two equal runs of that length share one. Positions whose fingerprint occurs more
than once are joined, each window around them is compared by the hash of all its lines, and
windows that occurred earlier (by id, text hash, line) are repeated. Overlapping repeated windows extend to
maximal runs both ways, and their lines are deleted. Shorter runs with at least ``words`` words are windows too: every
later repeat of a passage of whole lines goes if it has ``run`` lines or ``words`` words, and the first
occurrence stays. Lines without a word neither count nor break a run and stay.

Column functions only. One narrow table of line hashes is staged; fingerprints and windows meet by
aggregates (one row per hash), so a line that a third of the documents hold yields no pairs. The text
is shuffled once, to meet the deletions.

Defined cases: null text has no lines and stays null; an empty text stays empty; an empty table gives an empty
result. Null ids rank first. Rows equal in id and text are one document: both are returned with the same deletions. Rows
equal in id only, or without one, are separate documents in the order of their text hashes. Very long texts are
one row with an array of their line hashes. Ids are whole numbers. Input columns of any name stay; one that
has the name of a result column is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowdigest.llm.common import NOT_GAP, fresh, staged

RUN = 3
#: Words that make a run of fewer lines long enough.
WORDS = 50
_OTHER_GAPS = r"[\x09\x0B\x0C\x0D]"


def _real(lines: Column) -> Column:
    return F.filter(lines, lambda x: x.rlike(NOT_GAP))


def line_hashes(text: Column) -> Column:
    return F.transform(_real(F.split(text, "\n")), lambda x: F.xxhash64(x))


def word_counts(text: Column) -> Column:
    """Words of each line with a word.

    Blanks only are split at: a pattern of more characters would be compiled for every line.
    """
    blanks = F.when(text.rlike(_OTHER_GAPS), F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)
    counts = F.transform(F.split(blanks, "\n"), lambda x: F.size(F.array_remove(F.split(x, " "), "")))
    return F.filter(counts, lambda n: n > 0)


def repeated_windows(docs: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """Starts and lines of the repeated windows: (k, th, start, size), for documents (k, th, hs, ws)."""
    n = F.size("hs")

    def windows_of(size: int) -> Column:
        at = F.sequence(F.lit(0), n - size)
        if size < run:
            total = lambda i: reduce(lambda a, b: a + b, (F.get("ws", i + d) for d in range(size)))
            at = F.filter(at, lambda i: total(i) >= words)
        found = F.transform(
            at,
            lambda i: F.struct(
                i.alias("s"),
                F.lit(size).alias("size"),
                F.array_min(F.slice("hs", i + 1, size)).alias("f"),
                F.xxhash64(F.slice("hs", i + 1, size)).alias("c"),
            ),
        )
        return F.when(n >= size, found).otherwise(F.array())

    around = F.concat(*(windows_of(size) for size in range(1 if words is not None else run, run + 1)))
    windows = docs.select("k", "th", F.explode(around).alias("w")).select("k", "th", "w.*")
    # A fingerprint stands for the windows that select it; those in it twice are worth a comparison.
    twice = windows.groupBy("f").agg(F.count("*").alias("n")).filter("n > 1").select("f")
    joined = windows.join(twice, "f")
    rank = F.struct("k", "th", "s")
    firsts = (
        joined.groupBy("c")
        .agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("c", "first")
    )
    return joined.join(firsts, "c").filter(rank > F.col("first")).select("k", "th", F.col("s").alias("start"), "size")


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", run: int = RUN, words: int | None = WORDS
) -> DataFrame:
    """``docs`` with repeated runs of at least ``run`` lines, or ``words`` words, deleted from the text.

    Adds n_lines (with a word), n_removed and n_runs.
    """
    k, th, found_k, found_th, starts = (fresh(docs, x) for x in ("k", "th", "found_k", "found_th", "starts"))
    keyed = docs.withColumns({k: F.col(doc_id), th: F.xxhash64(text)})
    narrow = staged(
        docs.filter(F.col(text).isNotNull())
        .select(
            F.col(doc_id).cast("long").alias("k"),
            F.xxhash64(text).alias("th"),
            line_hashes(F.col(text)).alias("hs"),
            *([] if words is None else [word_counts(F.col(text)).alias("ws")]),
        )
        .filter(F.size("hs") >= (run if words is None else 1))
        .dropDuplicates(["k", "th"])
    )
    found = (
        repeated_windows(narrow, run, words)
        .groupBy("k", "th")
        .agg(F.collect_set(F.struct("start", "size")).alias(starts))
        .select(F.col("k").alias(found_k), F.col("th").alias(found_th), starts)
    )
    out = keyed.join(found, F.col(k).eqNullSafe(F.col(found_k)) & (F.col(th) == F.col(found_th)), "left")
    lines, at = fresh(docs, "lines"), fresh(docs, "at")
    out = out.drop(k, th, found_k, found_th).withColumn(lines, F.split(text, "\n"))
    out = out.withColumn(
        at,
        F.filter(
            F.transform(lines, lambda x, i: F.when(x.rlike(NOT_GAP), i).otherwise(F.lit(-1))), lambda x: x >= 0
        ),
    )
    covered = F.flatten(F.transform(starts, lambda w: F.sequence(w["start"], w["start"] + w["size"] - 1)))
    out = out.withColumn(starts, F.array_sort(F.array_distinct(covered)))
    gone = F.col(starts)
    gap = lambda x, i: (i == 0) | (x - F.coalesce(F.get(F.col(starts), i - 1), x) > 1)
    place = F.transform(gone, lambda j: F.get(F.col(at), j))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), place)
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n")
    zero = F.lit(0).cast("long")
    return out.withColumns(
        {
            "n_lines": F.coalesce(F.size(at), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.size(gone), zero).cast("long"),
            "n_runs": F.coalesce(F.size(F.filter(starts, gap)), zero).cast("long"),
            text: F.when(F.col(starts).isNull(), F.col(text)).otherwise(rest),
        }
    ).drop(starts, lines, at)
