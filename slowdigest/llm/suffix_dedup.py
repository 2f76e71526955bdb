"""Suffix-array dedup: bytes covered by strings of ``length`` bytes that also start elsewhere.

A sparse suffix array: of all suffixes only those at content-defined sample positions take part. The
sample of a window of ``length`` bytes is its smallest hashed ``gram`` (so equal windows sample equal
places), and the suffix carries the windows that chose it.

1. Suffixes whose leading gram and whole context agree are one class; a class with two members is repeated in
   all its windows. This is an aggregate, so thousands of copies are never gathered.
2. Other suffixes with a common leading gram are range-partitioned by it with sampled splitters; every
   bucket is sorted locally, and equal windows lie side by side. Suffixes with one leading gram never straddle
   two buckets. Leading grams with very many different contexts are compared window by window in one more
   aggregate instead.
3. Repeated windows go back to all members of their class, join into runs, and are cut from the text. Texts are shuffled
   only where a bit set of their keys says that they may be concerned.

By default every occurrence goes. With ``keep_first`` a window is repeated only where an equal one starts earlier, by
(id, text hash, place): members of a class but its first lose all windows, and the first ones of classes are compared in
that order. With ``passages`` texts are searched a second time, for shorter strings: bytes of runs that hold many words or
reach ``length`` are counted beside the others (every occurrence, whatever ``keep_first`` says) and stay in the text. With
``cut_passages`` they go too, and ``keep_first`` holds for them as for the others.

Defined cases: null and empty texts stay as they are, with no removed bytes; shorter texts than ``length``
have no window. Matches never cross documents. A null id is an id like others. Rows equal in id and text
are two documents, so each repeats the other (with ``keep_first`` both are treated as the first). An empty table gives an
empty result. Ids are whole numbers. Input columns of any name stay; one with the name of a result column is
replaced. Very long texts are hashed in chunks. Bytes may be cut inside a character; the text is then read without the
broken ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slowdigest.llm.common import batches, fresh, marked, mixed, quoted, staged

LENGTH = 400
GRAM = 100
CHUNK = 1 << 20
#: Leading grams with more different contexts are compared by an aggregate over their windows.
HEAVY = 4096
_BASE = 0x9E3779B97F4A7C15 | 1
_table = np.random.RandomState(7).randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, n: int) -> np.ndarray:
    table = _powers[which]
    base = _BASE if which == "up" else pow(_BASE, -1, 1 << 64)
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
    _powers[which] = table
    return table[:n]


def span_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all spans of ``size`` bytes."""
    n = len(data)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_table[data] * _power("up", n), out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * _power("down", n - size + 1))


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every window of ``width`` values, by running minima of blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[: n - width + 1], right[width - 1 : n])


def sampled(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(place, first start, last start, gram hash, context hash) of every sampled suffix of a text."""
    bits = np.uint64(CHUNK.bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    for begin in range(0, len(data) - length + 1, CHUNK):
        part = data[begin : begin + CHUNK + length - 1]
        hashes = span_hashes(part, gram)
        keyed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        chosen = (_window_least(keyed, length - gram + 1) & low).astype(np.int64)
        cut = np.flatnonzero(np.diff(chosen)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(chosen) - 1]])
        raw = part.tobytes()
        places = chosen[first]
        context = np.array(
            [
                xxhash.xxh3_64_intdigest(raw[a : b + length], seed=(int(p - a) << 10) + int(p - b))
                for p, a, b in zip(places, first, last)
            ],
            dtype=np.uint64,
        )
        yield places + begin, first + begin, last + begin, hashes[places], context


def suffixes(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(h, ctx, k, th, p, lo, hi): every sampled suffix of the rows (k, th, t)."""
    gram = min(GRAM, length // 4)

    def run(parts):
        for batch in parts:
            held: list[list[np.ndarray]] = [[] for _ in range(7)]
            for k, th, t in zip(*(batch.column(x).to_pylist() for x in ("k", "th", "t"))):
                data = np.frombuffer((t or "").encode(), dtype=np.uint8)
                for place, first, last, h, ctx in sampled(data, length, gram):
                    n = len(place)
                    for column, x in zip(
                        held,
                        (h.view(np.int64), ctx.view(np.int64), np.full(n, k), np.full(n, th), place, first, last),
                    ):
                        column.append(x)
            if held[0]:
                yield from batches(
                    dict(zip(("h", "ctx", "k", "th", "p", "lo", "hi"), map(np.concatenate, held)))
                )

    return rows.mapInArrow(run, "h long, ctx long, k long, th long, p long, lo long, hi long")


def _offsets(hit: np.ndarray, a: np.ndarray):
    """Intervals of neighbouring offsets."""
    at = np.sort(a[hit])
    if not len(at):
        return
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    for part in np.split(at, cut):
        yield int(part[0]), int(part[-1])


def _windows(context: bytes, before: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the sample place behind each window's start, and keys of the windows."""
    h = span_hashes(np.frombuffer(context, dtype=np.uint8), length)
    a = before - np.arange(len(h))
    return a, mixed(h + a.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def repeated(rows: DataFrame, length: int = LENGTH, heavy: int = HEAVY, keep_first: bool = False) -> DataFrame:
    """(k, th, spans): the removed byte ranges [begin, end) of each text that has any."""
    found = staged(suffixes(rows, length))
    place = ("k", "th", "p", "lo", "hi")
    classes = found.groupBy("h", "ctx")
    if keep_first:
        least = F.min(F.struct(*place)).alias("least")
        classes = classes.agg(F.count("*").alias("n"), least).select("h", "ctx", "n", "least.*")
    else:
        classes = classes.agg(F.count("*").alias("n"), *(F.first(x).alias(x) for x in place))
    shared = classes.groupBy("h").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).filter("total > 1")
    listed = staged(classes.join(shared, "h"))
    first = F.struct("k", "th", "p")
    # The member of a class that keeps the windows of this row, if any.
    spared = F.when(F.lit(keep_first), first).alias("spared")
    whole = listed.filter("n > 1").select(
        "h", "ctx", (F.col("p") - F.col("hi")).alias("a0"), (F.col("p") - F.col("lo")).alias("a1"), spared
    )
    wanted = (
        listed.filter("kinds > 1")
        .groupBy("k", "th")
        .agg(F.collect_list(F.struct("h", "ctx", "p", "lo", "hi", "n", "kinds")).alias("places"))
    )

    def fetch(parts):
        for batch in parts:
            out = []
            owners = []
            for k, th, t, places in zip(*(batch.column(x).to_pylist() for x in ("k", "th", "t", "places"))):
                raw = t.encode()
                owners += [(k, th)] * len(places)
                for x in places:
                    out.append(
                        (x["h"], x["ctx"], x["p"] - x["lo"], x["n"], x["kinds"], raw[x["lo"] : x["hi"] + length], x["p"])
                    )
            if out:
                columns = [*zip(*out), *zip(*owners)]
                kinds = [pa.int64()] * 5 + [pa.binary()] + [pa.int64()] * 3
                made = dict(zip(("h", "ctx", "before", "n", "kinds", "bytes", "p", "k", "th"), zip(columns, kinds)))
                yield from batches({c: pa.array(*made[c]) for c in names}, 4096)

    names = ["h", "ctx", "before", "n", "kinds", "bytes", *(("k", "th", "p") if keep_first else ())]
    key = F.xxhash64("k", "th")
    contexts = staged(
        marked(rows, key, listed.filter("kinds > 1"), key, "mark").filter("mark").join(
            wanted.select(F.col("k").alias("__k"), F.col("th").alias("__th"), "places"),
            F.col("k").eqNullSafe(F.col("__k")) & (F.col("th") == F.col("__th")),
        )
        .select("k", "th", "t", "places")
        .mapInArrow(fetch, ", ".join(f"{c} {'binary' if c == 'bytes' else 'long'}" for c in names))
    )

    def compare(parts):
        key, held = None, {}
        for batch in parts:
            columns = [batch.column(x).to_pylist() for x in ("h", "ctx", "before", "n", "bytes")]
            owner = [batch.column(x).to_pylist() for x in names[6:]]
            # Null ids first, as Spark orders structs.
            ranks = [(k is not None, k or 0, th, p) for k, th, p in zip(*owner)] or [None] * len(batch)
            for h, ctx, before, n, raw, rank in zip(*columns, ranks):
                if h != key:
                    if key is not None:
                        yield from _compared(key, held, length)
                    key, held = h, {}
                held[ctx] = (before, n, raw, rank)
        if key is not None:
            yield from _compared(key, held, length)

    schema = "h long, ctx long, a0 long, a1 long"
    light = (
        contexts.filter(f"kinds <= {heavy}")
        .repartitionByRange("h")
        .sortWithinPartitions("h")
        .mapInArrow(compare, schema)
    )

    def spread(parts):
        for batch in parts:
            columns = [batch.column(x).to_pylist() for x in ("h", "ctx", "before", "bytes")]
            owner = [batch.column(x).to_pylist() for x in names[6:]]
            for h, ctx, before, raw, *own in zip(*columns, *owner):
                a, w = _windows(raw, before, length)
                n = len(a)
                made = {"w": w.view(np.int64), "h": np.full(n, h), "ctx": np.full(n, ctx), "a0": a}
                yield from batches(made | {c: pa.array([x] * n, pa.int64()) for c, x in zip(names[6:], own)})

    each = contexts.filter(f"kinds > {heavy}").dropDuplicates(["h", "ctx"]).mapInArrow(
        spread, ", ".join(f"{c} long" for c in ("w", "h", "ctx", "a0", *names[6:]))
    )
    twice = each.groupBy("h", "w").agg(
        F.count("*").alias("c"), *([F.min(first).alias("first")] if keep_first else ())
    )
    many = each.join(twice.filter("c > 1").drop("c"), ["h", "w"])
    many = many.filter(first > F.col("first")) if keep_first else many
    many = many.select("h", "ctx", "a0", F.col("a0").alias("a1"))
    # A class's first member loses what was compared; the others have lost all windows already.
    flags = whole.union(light.union(many).withColumn("spared", F.lit(None).cast(whole.schema["spared"].dataType)))
    return (
        found.join(flags, ["h", "ctx"])
        .filter(F.col("spared").isNull() | ~F.struct("k", "th", "p").eqNullSafe(F.col("spared")))
        .select(
            "k",
            "th",
            F.struct((F.col("p") - F.col("a1")).alias("b"), (F.col("p") - F.col("a0") + length).alias("e")).alias("x"),
        )
        .groupBy("k", "th")
        .agg(F.collect_set("x").alias("spans"))
    )


def _compared(h: int, held: dict, length: int):
    """Windows of different contexts of one leading gram that are equal; with ranks, those that a lower one has too."""
    if len(held) < 2:
        return
    if next(iter(held.values()))[3] is not None:
        yield from _later(h, held, length)
        return
    made = [(ctx, n, *_windows(raw, before, length)) for ctx, (before, n, raw, _) in held.items()]
    keys = np.sort(np.concatenate([x[3] for x in made]))
    twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
    out: list[tuple[int, int, int, int]] = []
    for ctx, n, a, w in made:
        if n > 1 or not len(twice):
            continue
        at = np.minimum(np.searchsorted(twice, w), len(twice) - 1)
        out += [(h, ctx, a0, a1) for a0, a1 in _offsets(twice[at] == w, a)]
    if out:
        yield from batches(dict(zip(("h", "ctx", "a0", "a1"), (np.array(c, dtype=np.int64) for c in zip(*out)))))


def _later(h: int, held: dict, length: int):
    ordered = sorted(held.items(), key=lambda x: x[1][3])
    made = [(ctx, *_windows(raw, before, length)) for ctx, (before, _, raw, _) in ordered]
    keys = np.concatenate([x[2] for x in made])
    order = np.argsort(keys, kind="stable")  # equal windows stay in the order of ranks
    later = np.zeros(len(keys), dtype=bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    out, at = [], 0
    for ctx, a, w in made:
        out += [(h, ctx, a0, a1) for a0, a1 in _offsets(later[at : at + len(w)], a)]
        at += len(w)
    if out:
        yield from batches(dict(zip(("h", "ctx", "a0", "a1"), (np.array(c, dtype=np.int64) for c in zip(*out)))))


def _runs(spans) -> list[tuple[int, int]]:
    """Maximal runs of spans that overlap or touch, in order."""
    out: list[tuple[int, int]] = []
    for b, e in sorted((x["b"], x["e"]) for x in spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def remove_repeated(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = LENGTH,
    digest: bool = False,
    keep_first: bool = False,
    passages: tuple[int, int] | None = None,
    cut_passages: bool = False,
) -> DataFrame:
    """``docs`` without the repeated bytes, and n_bytes, n_removed, n_spans and kept_sha256.

    With ``digest`` only the id and these four columns; with ``keep_first`` the first occurrence of a string stays.

    ``passages`` (bytes, words) adds n_passage_bytes: bytes covered by strings of so many bytes that also start elsewhere, in
    maximal runs that have more than so many words, or ``length`` bytes. With ``cut_passages`` these runs are removed as well.
    """
    k, th, spans, short, found_k, found_th, mark = (
        fresh(docs, x) for x in ("k", "th", "spans", "short", "found_k", "found_th", "mark")
    )
    keyed = docs.withColumns({k: F.col(doc_id).cast("long"), th: F.xxhash64(F.coalesce(text, F.lit("")))})
    if digest:
        keyed = keyed.select(doc_id, k, th, text)
    rows = keyed.select(F.col(k).alias("k"), F.col(th).alias("th"), F.col(text).alias("t"))
    found = repeated(rows, length, keep_first=keep_first).toDF(found_k, found_th, spans)
    kind = found.schema[spans].dataType
    empty = F.lit(None).cast(kind)
    found = found.withColumn(short, empty)
    if passages:
        more = repeated(rows, passages[0], keep_first=keep_first and cut_passages).toDF(found_k, found_th, short).withColumn(spans, empty)
        found = found.unionByName(more).groupBy(found_k, found_th)
        found = found.agg(*(F.first(x, ignorenulls=True).alias(x) for x in (spans, short)))
    found = staged(found)
    keyed = marked(keyed, F.xxhash64(k, th), found, F.xxhash64(found_k, found_th), mark)
    both = keyed.filter(mark).join(
        found, F.col(k).eqNullSafe(F.col(found_k)) & (F.col(th) == F.col(found_th)), "left"
    )
    rest = keyed.filter(~F.col(mark)).withColumns({spans: empty, short: empty})
    both = both.drop(found_k, found_th).unionByName(rest).drop(k, th, mark)
    counts = ["n_bytes", "n_removed", "n_spans", *(["n_passage_bytes"] if passages else [])]
    drop = {*counts, "kept_sha256"}
    kept = [c for c in docs.columns if c.lower() not in drop]
    kept = [doc_id] if digest else kept
    # Names with dots cannot be handed to Arrow functions; positions can.
    carried = list({c: None for c in [*kept, text, spans, short]})
    at_of = {c: f"c{n}" for n, c in enumerate(carried)}
    both = both.select(*(F.col(q).alias(at_of[c]) for c, q in zip(carried, quoted(carried))))
    text_at, spans_at, short_at, kept_at = at_of[text], at_of[spans], at_of[short], [at_of[c] for c in kept]

    def cut(parts):
        for batch in parts:
            out: list[list] = [[] for _ in range(len(counts) + 2)]
            for t, found, more in zip(*(batch.column(x).to_pylist() for x in (text_at, spans_at, short_at))):
                raw = (t or "").encode()
                gone = _runs(found or ())
                if passages:
                    long = [
                        x for x in _runs(more or ()) if x[1] - x[0] >= length or len(raw[x[0] : x[1]].split()) > passages[1]
                    ]
                    if cut_passages:
                        gone = _runs([{"b": b, "e": e} for b, e in gone + long])
                pieces, at = [], 0
                for b, e in gone:
                    pieces.append(raw[at:b])
                    at = e
                pieces.append(raw[at:])
                left = b"".join(pieces)
                numbers = [len(raw), sum(e - b for b, e in gone), len(gone)]
                if passages:
                    numbers.append(sum(e - b for b, e in long))
                values = (None if t is None else left.decode("utf-8", "ignore"), *numbers, hashlib.sha256(left).hexdigest())
                for column, value in zip(out, values):
                    column.append(value)
            columns = {c: batch.column(c) for c in kept_at}
            if not digest:
                columns[text_at] = pa.array(out[0], pa.string())
            for c, v in zip(counts, out[1:]):
                columns[c] = pa.array(v, pa.int64())
            columns["kept_sha256"] = pa.array(out[-1], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([T.StructField(at_of[c], docs.schema[c].dataType) for c in kept])
    for c in counts:
        schema = schema.add(c, T.LongType())
    return both.mapInArrow(cut, schema.add("kept_sha256", T.StringType())).withColumnsRenamed(
        {at: c for c, at in at_of.items() if c in kept}
    )
