"""Source divergence audit: how far each source's use of terms is from every other source of its language.

Terms are counted by length-bucketed packing.  A task turns its texts into one byte string, finds the terms
in it, and packs those of up to 8 bytes into one unsigned 64-bit word and those of up to 16 into two.  Packed
terms are radix-sorted, 16 bits a pass, and equal neighbours counted; the sort is stable, so inside a term the
occurrences stay in order of group and document and one sort gives counts and document counts together.
Longer terms go to one bucket per length, which are sorted by their bytes.  Blocks of one task are merged by the
same sort before anything is shuffled: a task sends one row per term and group it has met, so a source with
a third of all rows costs no more than its vocabulary.

One shuffle by (lang, term) gives the counts and the number of documents of each term.  Terms kept by a language
are then dealt into buckets by a hash; each bucket meets the list of the language's sources, and sums up f for
every two of them over its terms.  The sums of the buckets add up to the result, which has one row for every two
sources of a language.

Every number is whole.  Spark computes the shares from decimals; ``f`` is below 2^31 and its square terms below
2^62.  Defined cases: null lang, source or text count as ''.  Rows without a term, and languages that keep none,
give their sources value 0 in part `pair` and no row in part `term`.  Repeated rows count each; ids play no
part.  Ties rank by term or source in UTF-8 order.  A language of one source has no pair.  Very long texts are
cut nowhere: blocks grow to hold the longest.  An empty table gives no row; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slowdigest.llm.common import batches, staged
from slowdigest.llm.vectors import named

LEAST_DOCUMENTS = 10
TOP = 10
UNIT = 1_000_000_000
#: Bytes of text that a task packs at once, and packed entries it holds before it merges or sends them.
BLOCK = 8 << 20
HELD = 1 << 21
#: Rows of counts in one bucket of part `pair`.
BUCKET = 200_000
_CELLS = 1 << 19

_LOWER = np.zeros(256, dtype=np.uint8)
_LOWER[0x80:] = np.arange(0x80, 0x100)
_LOWER[ord("a") : ord("z") + 1] = _LOWER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of entries by 64-bit words, the first word leading; 16 bits a pass."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows equal in all sorted columns starts."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _packed(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Up to 16 bytes from each start as two words, filled up with zeros; high bytes first."""
    out = []
    for half in (0, 8):
        word = np.zeros(len(start), dtype=np.uint64)
        for k in range(half, half + 8):
            byte = data[np.minimum(start + k, len(data) - 1)].astype(np.uint64)
            word = (word << np.uint64(8)) | np.where(k < length, byte, np.uint64(0))
        out.append(word)
    return out[0], out[1]


def _runs(order, words, group, doc):
    """Sorted entries to (words, group, occurrences, documents) per run of one term and group."""
    words, group, doc = [w[order] for w in words], group[order], doc[order]
    at = _starts(*words, group)
    if not len(at):
        return words, group, at, at
    seen = np.zeros(len(group), dtype=np.int64)
    seen[_starts(*words, group, doc)] = 1
    return [w[at] for w in words], group[at], np.diff(np.append(at, len(group))), np.add.reduceat(seen, at)


def count_block(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple]:
    """Counts of one block: ('short' or 'long', terms, group, occurrences, documents) per length class.

    ``groups`` numbers the group of each text and must ascend.
    """
    data = _LOWER[np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)]
    inside = np.concatenate([[False], data != 0])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, length = edge[0::2], edge[1::2] - edge[0::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, start, side="right")
    group = groups[doc]
    for low, high in ((0, 8), (8, 16)):
        own = np.flatnonzero((length > low) & (length <= high))
        first, second = _packed(data, start[own], length[own])
        words = [first] if high == 8 else [first, second]
        words, g, n, d = _runs(radix_order(words), words, group[own], doc[own])
        yield "short", (words[0], words[1] if high == 16 else np.zeros_like(words[0])), g, n, d
    for size in np.unique(length[length > 16]):
        own = np.flatnonzero(length == size)
        bytes_ = data[start[own][:, None] + np.arange(size)].view(f"S{size}").ravel()
        terms, g, n, d = _runs(np.argsort(bytes_, kind="stable"), [bytes_], group[own], doc[own])
        yield "long", terms[0], g, n, d


def merge(entries: list[tuple]) -> tuple:
    """Packed counts of several blocks as one, sorted by term and group."""
    first, second, group, n, d = (np.concatenate(c) for c in zip(*entries))
    order = radix_order([first, second, group.astype(np.uint64)])
    first, second, group = first[order], second[order], group[order]
    at = _starts(first, second, group)
    if not len(at):
        return first, second, group, n, d
    return first[at], second[at], group[at], np.add.reduceat(n[order], at), np.add.reduceat(d[order], at)


def _text(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.stack([first, second], 1).astype(">u8").view("S16").ravel()


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Partial counts (lang, source, term, n, documents): one row at least per term and group and task."""
    whole = [F.coalesce(named(c).cast("string"), F.lit("")).alias(a) for c, a in
             ((lang, "lang"), (source, "source"), (text, "text"))]

    def rows(names, terms, group, n, d):
        at = pa.array(group.astype(np.int64))
        yield from batches({
            "lang": pa.array([p[0] for p in names], pa.string()).take(at),
            "source": pa.array([p[1] for p in names], pa.string()).take(at),
            "term": pa.array(terms.tolist(), pa.binary()),
            "n": pa.array(n.astype(np.int64)),
            "documents": pa.array(d.astype(np.int64)),
        })

    def local(parts):
        numbers: dict[tuple[str, str], int] = {}
        names: list[tuple[str, str]] = []
        held, kept = [], 0

        def block(texts, groups):
            order = np.argsort(groups, kind="stable")
            return count_block([texts[i] for i in order], groups[order])

        def blocks():
            texts, groups, size = [], [], 0
            for batch in parts:
                columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
                for a, b, t in zip(*columns):
                    at = numbers.setdefault((a, b), len(names))
                    if at == len(names):
                        names.append((a, b))
                    texts.append(t.encode())
                    groups.append(at)
                    size += len(texts[-1])
                    if size >= BLOCK:
                        yield from block(texts, np.array(groups))
                        texts, groups, size = [], [], 0
            if texts:
                yield from block(texts, np.array(groups))

        for kind, terms, group, n, d in blocks():
            if kind == "long":
                yield from rows(names, terms, group, n, d)
                continue
            held.append((*terms, group, n, d))
            kept += len(group)
            if kept >= HELD:
                held = [merge(held)]
                kept = len(held[0][0])
                if kept >= HELD // 2:
                    first, second, group, n, d = held[0]
                    yield from rows(names, _text(first, second), group, n, d)
                    held, kept = [], 0
        if held:
            first, second, group, n, d = merge(held)
            yield from rows(names, _text(first, second), group, n, d)

    found = docs.select(*whole).mapInArrow(local, "lang string, source string, term binary, n long, documents long")
    return found.withColumn("term", F.col("term").cast("string"))


def _share(count: str, total: str, kept: str):
    """p of a count: 1 + floor(UNIT * (count + 2) / (total + 2 * kept)), exact beyond the range of longs."""
    return F.expr(
        f"1 + ({UNIT} * (cast({count} as decimal(28, 0)) + 2)) div"
        f" nullif(cast({total} as decimal(28, 0)) + 2 * cast({kept} as decimal(28, 0)), 0)"
    ).cast("long")


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // (p + q)


def _pair_sums(kept: DataFrame, groups: DataFrame, buckets: int) -> DataFrame:
    """f summed over all kept terms for every two sources (a before b) of a language."""
    spread = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets).cast("long")).alias("bucket"), "term", "source", "p")
    everywhere = groups.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), "source", "p0"
    )

    def local(counts: pa.Table, sources: pa.Table) -> pa.Table:
        names = sources["source"].combine_chunks()
        order = np.argsort(np.array([s.encode() for s in names.to_pylist()], dtype=object), kind="stable")
        names = names.take(pa.array(order))
        none = sources["p0"].to_numpy()[order]
        lang = sources["lang"][0]
        place = {s: i for i, s in enumerate(names.to_pylist())}
        column = np.array([place[s] for s in counts["source"].to_pylist()], dtype=np.int64)
        terms, row = np.unique(counts["term"].to_numpy(zero_copy_only=False), return_inverse=True) if len(counts) else ([], [])
        row = np.asarray(row, dtype=np.int64)
        by_row = np.argsort(row, kind="stable")
        row, column, p = row[by_row], column[by_row], counts["p"].to_numpy()[by_row]
        total = np.zeros((len(names), len(names)), dtype=np.int64)
        step = max(1, _CELLS // max(1, len(names)))
        for low in range(0, len(terms), step):
            high = min(low + step, len(terms))
            dense = np.repeat(none[None, :], high - low, axis=0)
            x, y = np.searchsorted(row, [low, high])
            dense[row[x:y] - low, column[x:y]] = p[x:y]
            for a in range(len(names) - 1):
                total[a, a + 1 :] += _distance(dense[:, a : a + 1], dense[:, a + 1 :]).sum(0)
        a, b = np.triu_indices(len(names), 1)
        return pa.table({
            "lang": pa.repeat(lang, len(a)), "a": names.take(pa.array(a)), "b": names.take(pa.array(b)),
            "value": pa.array(total[a, b]),
        })

    sums = (
        spread.groupBy("lang", "bucket")
        .cogroup(everywhere.groupBy("lang", "bucket"))
        .applyInArrow(local, "lang string, a string, b string, value long")
    )
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
    least_documents: int = LEAST_DOCUMENTS, top: int = TOP, bucket_rows: int = BUCKET,
) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources, and the terms that mark a source."""
    term = W.partitionBy("lang", "term")
    counts = (
        count_terms(docs, text, lang, source)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
        .withColumn("documents", F.sum("documents").over(term))
        .filter(F.col("documents") >= least_documents)
        .select(
            "lang", "term", "source", "n", F.sum("n").over(term).alias("lang_n"),
            (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
        )
    )
    counts = staged(counts)
    per_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("terms"))
    occurring = docs.select(
        F.coalesce(named(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(named(source).cast("string"), F.lit("")).alias("source"),
    ).distinct()
    groups = occurring.join(per_group, ["lang", "source"], "left").withColumn(
        "total", F.coalesce("total", F.lit(0).cast("long"))
    )
    langs = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.coalesce(F.sum("terms"), F.lit(0).cast("long")).alias("v")
    )
    groups = staged(
        groups.join(langs, "lang").select(
            "lang", "source", "total", "lang_total", "v",
            F.coalesce(_share("0", "total", "v"), F.lit(1).cast("long")).alias("p0"),
        )
    )
    kept = counts.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", _share("n", "total", "v").alias("p"), _share("lang_n", "lang_total", "v").alias("q")
    )
    buckets = max(1, -(-counts.count() // bucket_rows))
    half = _pair_sums(kept, groups, buckets)
    pairs = half.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionAll(
        half.select("lang", "b", "a", "value")
    )
    place = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(place).alias("rank")
    )
    apart = F.expr("((p - q) * (p - q)) div (p + q)")
    terms = kept.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart.alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    return pairs.unionAll(terms)
