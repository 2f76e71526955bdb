"""Quality rules: hashed n-gram log-likelihood ratio of trusted target to raw corpus.

Words and word pairs of every document fall into hashed buckets. Two multinomials over the buckets are
counted: one over the trusted documents, one over the whole corpus. A document's score is the sum of
its n-grams' log ratios over the number of its n-grams; it passes from a threshold on. Weights are
integers (1/65536), so sums do not depend on their order and every run decides alike.

Column functions only. The corpus is read twice and never shuffled: counts are added up per task before
the exchange, and weights (one per bucket) travel as one literal.

Defined cases: null or blank text has no words and fails the base rules. Null ids, repeated rows and
ids are judged row by row, each by its own text. Without trusted documents all weights are 0, and
without labelled bad documents nothing falls below the threshold. Input columns stay; a column that has
the name of a result column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slowdigest.llm.common import NOT_GAP, fresh, quoted, trusted_sample, whole_text, words

BUCKETS = 1 << 14
SCALE = 1 << 16
MAX_LABELLED = 100_000
SYMBOLS = "#*$%&|<>"
KEEP_SHARE = 0.995


def with_base(df: DataFrame, text: str = "text", weights: list[int] | None = None) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (and score, given weights)."""
    w, g, s, p = (fresh(df, f"__{x}") for x in ("words", "grams", "sorted", "starts"))
    whole = whole_text(F.col(text))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(NOT_GAP))
    n = F.size(w)
    out = df.withColumn(w, words(F.col(text)))
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "n_dup_lines": _let(lines, _surplus).cast("long"),
            **({"score": _score_of_words(F.col(w), weights)} if weights else {}),
            g: F.when(
                n >= 3,
                F.transform(
                    F.slice(w, 1, F.greatest(n - 2, F.lit(1))),
                    lambda x, i: F.struct(
                        F.xxhash64(x, F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)).alias("h"), i.alias("i")
                    ),
                ),
            ),
        }
    )
    out = out.withColumn(s, F.sort_array(g))
    same = lambda x, i, d: F.coalesce(x["h"] == F.get(F.col(s), i + d)["h"], F.lit(False))
    out = out.withColumn(
        p,
        F.sort_array(
            F.transform(F.filter(s, lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"])
        ),
    )
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(F.col(p), i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop(w, g, s, p)


def _surplus(values: Column) -> Column:
    return F.size(values) - F.size(F.array_distinct(values))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def _bucket_numbers(w: Column, size: int) -> Column:
    number = lambda *x: F.pmod(F.xxhash64(*x), F.lit(size)).cast("int")
    firsts = F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
    return F.concat(
        F.transform(w, lambda x: number(x)), F.transform(firsts, lambda x, i: number(x, F.get(w, i + 1)))
    )


def buckets(text: Column, size: int = BUCKETS) -> Column:
    """Bucket numbers of a text's words and word pairs."""
    return _let(words(text), lambda w: _bucket_numbers(w, size))


def log_ratios(
    docs: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = BUCKETS
) -> list[int]:
    """Log ratio of each bucket in 1/65536, from all documents.

    ``trusted`` holds a bounded number of distinct ids (see ``trusted_sample``) and is broadcast.
    """
    marked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(trusted.withColumn("t", F.lit(1))), "doc_id", "left"
    )
    counts = (
        marked.select(F.explode(buckets(F.col("text"), size)).alias("b"), "t")
        .groupBy("b")
        .agg(F.count("t").alias("t"), F.count("*").alias("r"))
        .collect()
    )
    target, raw = [0] * size, [0] * size
    for row in counts:
        target[row["b"]], raw[row["b"]] = row["t"], row["r"]
    t, r = sum(target), sum(raw)
    if not t:
        return [0] * size
    ratio = lambda a, b: math.log((a + 1) * (r + size) / ((b + 1) * (t + size)))
    return [round(SCALE * ratio(a, b)) for a, b in zip(target, raw)]


def score(text: Column, weights: list[int]) -> Column:
    """Mean weight of a text's n-grams; null without any."""
    return _score_of_words(words(text), weights)


def _score_of_words(w: Column, weights: list[int]) -> Column:
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    total = lambda found: F.aggregate(found, F.lit(0).cast("long"), lambda a, b: a + F.get(table, b))
    mean = lambda found: F.when(F.size(found) > 0, F.floor(total(found) / F.size(found)))
    return _let(_let(w, lambda x: _bucket_numbers(x, len(weights))), mean)


def fit_threshold(scored: DataFrame, keep_share: float = KEEP_SHARE) -> int:
    """The score from which documents pass, from labelled rows (score, good).

    Best balanced accuracy among the scores that keep at least ``keep_share`` of the good rows. Scores
    are counted in bins of 1/1024, so the driver receives a bounded table.
    """
    width = SCALE // 1024
    rows = (
        scored.groupBy(F.floor(F.col("score") / width).alias("bin"))
        .agg(F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad"))
        .orderBy("bin")
        .collect()
    )
    rows = [r for r in rows if r["bin"] is not None]
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    best, at = 0.0, -(1 << 62)
    lost = caught = 0
    if not good or not bad:
        return at
    for r in rows:
        if lost <= (1 - keep_share) * good and caught / bad - lost / good > best:
            best, at = caught / bad - lost / good, r["bin"] * width
        lost, caught = lost + r["good"], caught + r["bad"]
    return at


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Base columns, ``score`` and ``kept`` for every document.

    ``labels`` (doc_id, quality, toxic) name the trusted documents: quality 1, not toxic. At most
    ``max_labelled`` labelled ids of either kind are used: half of the trusted ones (by a hash) make the
    target model, the other half and the bad ones set the threshold, since documents of the
    model itself score higher than others like them. The raw corpus is counted over all documents.
    """
    good = trusted_sample(labels, F.expr("quality = 1 and coalesce(toxic, 0) = 0"), max_labelled)
    bad = trusted_sample(labels, F.expr("quality = 0"), max_labelled)
    odd = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    weights = log_ratios(docs, good.filter(~odd), text, doc_id)
    known = good.filter(odd).withColumn("good", F.lit(True)).union(bad.withColumn("good", F.lit(False)))
    sample = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(known), "doc_id"
    )
    threshold = fit_threshold(sample.select(score(F.col("text"), weights).alias("score"), "good"))
    out = with_base(docs, text, weights)
    kept = ~F.col("base_failed") & (F.coalesce(F.col("score"), F.lit(0)) >= F.lit(threshold))
    out = out.withColumn("kept", kept)
    # Behind a generator, so that a later filter is not evaluated again inside every step above.
    found = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    rest = [c for c in docs.columns if c.lower() not in found]
    one = fresh(docs, "rules")
    rest = quoted(rest)
    return out.select(*rest, F.explode(F.array(F.struct(*found))).alias(one)).select(*rest, f"{one}.*")
