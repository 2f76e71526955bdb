"""N-gram Jaccard join: T-occurrence search over inverted lists with DivideSkip.

A text's set holds its distinct ``width``-word shingles, as 64-bit hashes. Texts with equal sets form a class,
which takes part once. Two sets that reach the similarity share a shingle among the rarest of either, so only
those enter the inverted lists: the short lists. Every other list is long and is never built; in place of it a
candidate's sorted set is probed by binary search.

1. Shingles are counted in hashed buckets over all documents, which gives one global order, rare first. The table grows
   with the text up to 2^22 buckets; beyond, counts stand out by what they exceed the usual bucket by.
2. The short lists are the sorted runs of one shuffle by shingle. A very frequent shingle is dealt over
   several tasks by class. Each list links neighbours (by size), its first class and, among frequent shingles, the class with
   the most of them (an original beside its copies) to all others as candidates: lines, not all
   pairs. Bitmaps of the sets rule out most candidates exactly; sets of the others are read and probed, each class's smallest
   candidate first and the rest where that leaves two components. Links make components.
3. Lists whose classes all lie in one component are done: a large group of near copies ends here. In the
   others, merging the lists counts the occurrences of every pair from different components; pairs whose count
   plus the most that the rest can add misses the required overlap T are dropped; the others are probed
   in the long lists. Lists beyond ``BLOCK`` classes are worked in blocks of pairs.
4. Frequent shingles, the last of the global order, form no pairs of single classes. Two linked texts either share a rare shingle of
   their short lists, or reach the overlap by frequent ones alone. So classes with equal frequent parts make one
   group, whose smallest class stands for it in the lists of frequent shingles: if a class links with any of its group
   by that part, it links with the smallest. A class that does not can link by its frequent part only with a
   smaller representative of another group, and does so with the one that leaves most room.

Components therefore equal those of all links, though links inside a component need not all be tested.

Defined cases: null, empty and blank texts have no shingles and stay alone; texts with fewer words than
``width`` have one shingle. Rows with a null id link like others: the component is the smallest id in it, null where it
has none. Repeated rows fall into one class. Ids are cast to long; those that are no numbers are refused by the cast. An empty table gives
an empty result. Very long texts are hashed whole, a chunk of about 1 MB or one text at a time. Input columns other than id and text do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slowdigest.llm.common import batches, components, mixed, staged

WIDTH = 5
PERCENT = 75
#: Shingles whose bucket is counted more often are dealt over several tasks, so many classes each.
SPLIT = 20_000
BLOCK = 2048
#: Shingles counted this much more often than chance puts other ones into their bucket are frequent.
FREQUENT = 64
#: Entries of one list that a task holds at once.
STRETCH = 500_000
#: Bytes of text hashed together.
CHUNK = 1 << 20
#: The table of counts has one bucket for 64 bytes of text, within these bounds; only the order depends on it.
LEAST_BITS, MOST_BITS = 16, 22
SLICE = 1 << 12
#: Bits of a class's bitmap: the power of two from twice its shingles on, within these bounds.
LEAST_SIGNATURE, MOST_SIGNATURE = 64, 1 << 18
#: The filter of wanted texts takes 16 bits a text, at most 32 MB.
MOST_FILTER_BITS = 28
_BASE = 0xD1342543DE82EF95
_UNBASE = pow(_BASE, -1, 1 << 64)
_up, _down = np.ones(1, np.uint64), np.ones(1, np.uint64)
_is_gap = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_byte_values = mixed(np.arange(1, 257, dtype=np.uint64))
_byte_values[0x41:0x5B] = _byte_values[0x61:0x7B]


def _rolling(table: np.ndarray, n: int, base: int) -> np.ndarray:
    """``table`` of powers of ``base`` modulo 2^64, with at least ``n`` entries."""
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
    return table


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, hashes) of the words of a text in bytes, A-Z lower-cased."""
    global _up, _down
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _is_gap[data], [True]])))
    starts, ends = edges[0::2], edges[1::2]
    _up, _down = _rolling(_up, len(data), _BASE), _rolling(_down, len(data), _UNBASE)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_values[data] * _up[: len(data)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * _down[starts])


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of every text's shingles; texts are hashed together in chunks of about 1 MB."""
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size < CHUNK):
            size += len(texts[end] or b"") + 1
            end += 1
        chunk = [t or b"" for t in texts[begin:end]]
        starts, h = _word_hashes(np.frombuffer(b" ".join(chunk), dtype=np.uint8))
        firsts = np.cumsum([0, *(len(t) + 1 for t in chunk)])
        at = np.searchsorted(starts, firsts)
        out = np.zeros(max(len(h) - width + 1, 0), dtype=np.uint64)
        for k in range(width if len(out) else 0):
            out = mixed(out + h[k : len(h) - width + 1 + k])
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= width:
                yield np.unique(out[a : b - width + 1])
                continue
            whole = np.full(min(b - a, 1), b - a, dtype=np.uint64)
            for k in range(a, b):
                whole = mixed(whole + h[k : k + 1])
            yield whole
        begin = end


def class_of(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63)


def required(n: int, m: int, percent: int = PERCENT) -> int:
    """The overlap T that two sets of these sizes need."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return shingle_sets(batch.column("t").cast(pa.binary()).to_pylist())


def shingle_counts(rows: DataFrame, bits: int) -> np.ndarray:
    """Occurrences of shingles in documents per bucket, the leading ``bits`` bits of the hash.

    A task sends its counts in compressed slices, which are added up as they arrive.
    """
    size = min(SLICE, 1 << bits)

    def local(parts):
        total = np.zeros(1 << bits, dtype=np.uint32)
        held, n = [], 0
        for batch in parts:
            for found in _sets(batch):
                held.append(found >> np.uint64(64 - bits))
                n += len(found)
                if n >= 1 << 20:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=1 << bits).astype(np.uint32)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held).astype(np.int64), minlength=1 << bits).astype(np.uint32)
        for k, x in enumerate(total.reshape(-1, size)):
            if x.any():
                packed = zlib.compress(x.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "c": pa.array([packed])})

    def add(parts):
        total: dict[int, np.ndarray] = {}
        for batch in parts:
            for k, c in zip(batch.column("slice").to_pylist(), batch.column("c").to_pylist()):
                planes = np.frombuffer(zlib.decompress(c), dtype=np.uint8).reshape(4, -1)
                x = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.uint64)
                total[k] = total[k] + x if k in total else x
        for k, x in total.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "c": pa.array([x.tobytes()])})

    schema = "slice int, c binary"
    got = rows.select("t").mapInArrow(local, schema).repartition("slice").mapInArrow(add, schema).toArrow()
    out = np.zeros((1 << bits) // size * size, dtype=np.uint64).reshape(-1, size)
    for k, c in zip(got.column("slice").to_pylist(), got.column("c").to_pylist()):
        out[k] = np.frombuffer(c, dtype=np.uint64)
    return np.minimum(out.ravel(), np.iinfo(np.uint32).max).astype(np.uint32)


def often_of(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    bits = len(counts).bit_length() - 1
    return counts[(found >> np.uint64(64 - bits)).astype(np.int64)]


def signature(found: np.ndarray) -> bytes:
    """A bitmap with the places of all shingles, by their last bits; it grows with the set, so that few share a place."""
    size = min(max(1 << (2 * len(found) - 1).bit_length(), LEAST_SIGNATURE), MOST_SIGNATURE)
    bits = np.zeros(size, dtype=bool)
    bits[(found % np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def most_common(na: np.ndarray, sa: list[bytes], nb: np.ndarray, sb: list[bytes]) -> np.ndarray:
    """The most shingles that pairs of sets of these sizes and bitmaps can share.

    A place that only one bitmap has stands for a shingle or more that the other set lacks. The longer bitmap of two is
    folded to the length of the other.
    """
    out = np.zeros(len(sa), dtype=np.int64)
    lengths = np.array([[len(x), len(y)] for x, y in zip(sa, sb)], dtype=np.int64).reshape(-1, 2)
    for la, lb in np.unique(lengths, axis=0):
        at = np.flatnonzero((lengths[:, 0] == la) & (lengths[:, 1] == lb))
        least = min(la, lb)
        x, y = (
            np.bitwise_or.reduce(np.frombuffer(b"".join(s[i] for i in at), np.uint8).reshape(len(at), -1, least), axis=1)
            for s in (sa, sb)
        )
        only_a, only_b = (np.bitwise_count(v).sum(1, dtype=np.int64) for v in (x & ~y, y & ~x))
        out[at] = np.minimum(na[at] - only_a, nb[at] - only_b)
    return out


def frequent_from(counts: np.ndarray, frequent: int = FREQUENT) -> float:
    """Shingles whose bucket counts more are frequent: ``frequent`` above what chance gives most buckets."""
    usual = float(np.median(counts))
    return usual + 6 * usual**0.5 + frequent


def profiles(rows: DataFrame, shared, limit: float) -> DataFrame:
    """(k, th, n, cls, nf, part, sig) of every row (k, th, t); cls is null for empty sets.

    ``nf`` counts the frequent shingles; ``part`` is their hash where they alone can reach the similarity.
    """

    def run(parts):
        for batch in parts:
            n, cls, nf, part, sig = [], [], [], [], []
            for s in _sets(batch):
                f = s[often_of(s, shared.value) > limit]
                alone = len(s) > 0 and 100 * len(f) >= PERCENT * len(s)
                n.append(len(s))
                cls.append(class_of(s) if len(s) else None)
                nf.append(len(f))
                part.append(class_of(f) if alone else None)
                sig.append(signature(s) if len(s) else None)
            longs = {x: pa.array(y, pa.int64()) for x, y in (("n", n), ("cls", cls), ("nf", nf), ("part", part))}
            yield pa.RecordBatch.from_pydict(
                {"k": batch.column("k"), "th": batch.column("th"), **longs, "sig": pa.array(sig, pa.binary())}
            )

    return rows.mapInArrow(run, "k long, th long, n long, cls long, nf long, part long, sig binary")


def group_members(classes: DataFrame) -> DataFrame:
    """(cls, n, rep, rep_n, near): classes by equal frequent parts; ``near`` ones link with the representative."""
    able = classes.filter("part is not null")
    reps = able.groupBy("part").agg(F.min(F.struct("n", "cls")).alias("least"))
    reach = F.expr(f"{100 + PERCENT} * nf >= {PERCENT} * (n + rep_n)")
    return (
        able.join(reps, "part")
        .select("cls", "n", "nf", F.col("least.cls").alias("rep"), F.col("least.n").alias("rep_n"))
        .select("cls", "n", "nf", "rep", "rep_n", ((F.col("cls") == F.col("rep")) | reach).alias("near"))
    )


def further_links(found: DataFrame, members: DataFrame) -> DataFrame:
    """Links of classes that are not near their representative, from pairs (a, b, o) of representatives."""
    ways = found.union(found.select("b", "a", "o")).toDF("rep", "other", "o")
    sizes = members.filter("cls = rep").select(F.col("cls").alias("other"), F.col("n").alias("other_n"))
    room = F.expr(f"{100 + PERCENT} * o - {PERCENT} * other_n").alias("room")
    best = ways.join(sizes, "other").select("rep", "other", room).groupBy("rep")
    best = best.agg(F.max(F.struct("room", "other")).alias("best"))
    far = members.filter("not near").select("cls", "n", "rep")
    return far.join(best, "rep").filter(f"{PERCENT} * n <= best.room").select("cls", "best.other")


def short_lists(rows: DataFrame, shared, limit: float, split: int = SPLIT) -> DataFrame:
    """Entries (s, salt, cls, n, pos, prev, prev_n, lead, lead_n) of all lists with two classes or more."""

    def emit(parts):
        table, seen = shared.value, set()
        held, size = [], 0
        for found in (s for batch in parts for s in _sets(batch)):
            n = len(found)
            if not n:
                continue
            cls = class_of(found)
            if cls in seen:
                continue
            seen.add(cls)
            often = often_of(found, table)
            order = np.lexsort((found, often))[: prefix_length(n)]
            parts_of = (np.maximum(often[order] - limit, 0) // split).astype(np.int64) + 1
            salt = np.where(parts_of > 1, (cls % (1 << 31)) % parts_of + 1, 0).astype(np.int32)
            held.append((found[order].view(np.int64), salt, cls, n, np.arange(len(order), dtype=np.int32)))
            size += len(order)
            if size >= 200_000:
                yield from _entries(held)
                held, size = [], 0
        yield from _entries(held)

    entries = rows.select("t").mapInArrow(emit, "s long, salt int, cls long, n int, pos int")
    ordered = entries.repartition("s", "salt").sortWithinPartitions("s", "salt", "n", "cls")

    def lists(parts):
        rest = None
        for batch in parts:
            now = pa.Table.from_batches([batch])
            if not len(now):
                continue
            if rest is not None:
                now = pa.concat_tables([rest, now])
            s, salt = now.column("s").to_numpy(), now.column("salt").to_numpy()
            other = np.flatnonzero((s != s[-1]) | (salt != salt[-1]))
            begin = int(other[-1]) + 1 if len(other) else 0
            if begin:
                yield from _runs(now.slice(0, begin))
                rest = now.slice(begin)
            elif len(now) < STRETCH:
                rest = now
            else:  # a longer list goes out in stretches that share one class
                yield from _runs(now)
                rest = now.slice(len(now) - 1)
        if rest is not None:
            yield from _runs(rest)

    schema = "s long, salt int, cls long, n int, pos int, prev long, prev_n int, lead long, lead_n int"
    return ordered.mapInArrow(lists, schema)


def _entries(held: list) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    sizes = [len(x[0]) for x in held]
    yield from batches(
        {
            "s": np.concatenate([x[0] for x in held]),
            "salt": np.concatenate([x[1] for x in held]),
            "cls": np.repeat(np.array([x[2] for x in held], dtype=np.int64), sizes),
            "n": np.repeat(np.array([x[3] for x in held], dtype=np.int32), sizes),
            "pos": np.concatenate([x[4] for x in held]),
        }
    )


def _runs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Entries of lists with two classes or more, beside the one before and the first."""
    c = {name: rows.column(name).to_numpy() for name in ("s", "salt", "cls", "n", "pos")}
    if not len(c["s"]):
        return
    new = np.ones(len(c["s"]), dtype=bool)
    new[1:] = (c["s"][1:] != c["s"][:-1]) | (c["salt"][1:] != c["salt"][:-1])
    again = np.zeros(len(new), dtype=bool)  # the same class from another task
    again[1:] = ~new[1:] & (c["cls"][1:] == c["cls"][:-1])
    if again.any():
        c, new = {k: v[~again] for k, v in c.items()}, new[~again]
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(new)))
    lead = np.repeat(begins, sizes)
    kept = np.repeat(sizes, sizes) > 1
    kept |= c["salt"] > 0
    before = np.maximum(np.arange(len(new)) - 1, lead)
    out = {k: v[kept] for k, v in c.items()}
    out |= {"prev": c["cls"][before][kept], "prev_n": c["n"][before][kept]}
    out |= {"lead": c["cls"][lead][kept], "lead_n": c["n"][lead][kept]}
    yield from batches(out)


def _pairs(a: str, an: str, b: str, bn: str) -> list:
    swap = F.col(a) < F.col(b)
    return [
        F.least(a, b).alias("a"),
        F.when(swap, F.col(an)).otherwise(F.col(bn)).cast("long").alias("an"),
        F.greatest(a, b).alias("b"),
        F.when(swap, F.col(bn)).otherwise(F.col(an)).cast("long").alias("bn"),
    ]


def _size_fits(percent: int = PERCENT) -> str:
    return f"100 * least(an, bn) >= {percent} * greatest(an, bn)"


def line_candidates(lists: DataFrame) -> DataFrame:
    """Candidate pairs of neighbours and of first classes, in every list."""
    near = lists.select(*_pairs("cls", "n", "prev", "prev_n"))
    first = lists.select(*_pairs("cls", "n", "lead", "lead_n"))
    heads = lists.filter("salt > 0").groupBy("s", "salt").agg(F.min("lead").alias("cls"), F.min("lead_n").alias("n"))
    top = heads.groupBy("s").agg(F.min("cls").alias("lead"))
    dealt = heads.join(top, "s").join(heads.select("s", F.col("cls").alias("lead"), F.col("n").alias("lead_n")), ["s", "lead"])
    across = dealt.select(*_pairs("cls", "n", "lead", "lead_n"))
    return near.union(first).union(across).filter("a <> b").filter(_size_fits())


def centre_candidates(lists: DataFrame, members: DataFrame) -> DataFrame:
    """Candidate pairs of representatives with the one of most frequent shingles, in every list of a frequent one."""
    reps = members.filter("cls = rep").select("cls", "nf")
    entries = lists.select("s", "cls", "n", "pos").join(reps, "cls").filter("pos >= n - nf")
    centres = entries.groupBy("s").agg(F.max(F.struct("nf", "cls", "n")).alias("x"))
    centres = centres.select("s", F.col("x.cls").alias("centre"), F.col("x.n").alias("centre_n"))
    both = entries.join(centres, "s").filter("cls <> centre")
    return both.select(*_pairs("cls", "n", "centre", "centre_n")).filter(_size_fits())


def occurrences(lists: DataFrame, known: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, an, b, bn) that their short lists let reach the overlap.

    ``known`` are (cls, nf, c, rep, open). Pairs are of different components c, or of a representative with ``open``
    members and a smaller one. Only representatives stand in the lists of frequent shingles.
    """
    # Common shingles before a place stand in lists too, so ``r`` bounds their number; where it and all
    # shingles from the place on stay below the overlap with any partner, the entry joins no pair.
    own_order = W.partitionBy("cls").orderBy("pos")
    entries = lists.select("s", "cls", "n", "pos").withColumn("r", F.row_number().over(own_order) - 1)
    entries = entries.filter(f"100 * (r + n - pos) >= {PERCENT} * n")
    labelled = (
        entries.join(known, "cls")
        .withColumn("rare", F.expr("pos < n - nf"))
        .filter("rare or rep")
        .withColumn("open", F.expr("open and not rare"))
        .withColumn("q", F.expr("if(rare, -1, pos - (n - nf))").cast("int"))
        .drop("nf", "rare", "rep")
    )
    labelled = staged(labelled)
    mixed_lists = (
        labelled.groupBy("s")
        .agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m"), F.max("open").alias("open"))
        .filter("m > 1 and (lo < hi or open)")
        .select("s", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, own).alias("i"), F.greatest(x, own).alias("j")),
    )
    dealt = (
        labelled.join(mixed_lists, "s")
        .withColumn("own", own)
        .withColumn("cell", F.explode(cells))
        .select("s", "cell.i", "cell.j", "own", "cls", "n", "pos", "r", "c", "open", "q")
        .repartition("s", "i", "j")
        .sortWithinPartitions("s", "i", "j", "cls")
    )

    names = ("s", "i", "j", "own", "cls", "n", "pos", "r", "c", "open", "q")

    def merge(parts):
        rest = None
        for batch in parts:
            now = pa.Table.from_batches([batch])
            if not len(now):
                continue
            if rest is not None:
                now = pa.concat_tables([rest, now])
            key = [now.column(x).to_numpy() for x in names[:3]]
            other = np.flatnonzero(np.logical_or.reduce([x != x[-1] for x in key]))
            begin = int(other[-1]) + 1 if len(other) else 0
            if begin:
                yield from _cross(now.slice(0, begin))
            rest = now.slice(begin)  # at most two blocks
        if rest is not None:
            yield from _cross(rest)

    # Lists of rare and of frequent shingles bound the overlap each on its own.
    found = dealt.mapInArrow(merge, "a long, an int, b long, bn int, pa int, pb int, often boolean")
    kinds = {"rare": ~F.col("often"), "often": F.col("often")}
    counted = {f"c_{kind}": F.count(F.when(x, 1)) for kind, x in kinds.items()}
    places = {f"{p}_{kind}": F.max(F.when(x, F.col(p))) for kind, x in kinds.items() for p in ("pa", "pb")}
    pairs = found.groupBy("a", "an", "b", "bn").agg(*(x.alias(name) for name, x in (counted | places).items()))
    need = F.expr(f"ceil({PERCENT}D * (an + bn) / {100 + PERCENT} - 1e-9)")
    enough = [F.expr(f"c_{kind} + least(an - pa_{kind} - 1, bn - pb_{kind} - 1)") >= need for kind in kinds]
    return pairs.filter(F.coalesce(enough[0], F.lit(False)) | F.coalesce(enough[1], F.lit(False))).select("a", F.col("an").cast("long"), "b", F.col("bn").cast("long"))


def _cross(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of classes to be counted in whole cells, sorted by cell and class; both blocks' own pairs go to cell (i, i).

    Entries meet those one place on in their cell, then two, and so on, in all cells at once.
    """
    c = {x: rows.column(x).to_numpy(zero_copy_only=False) for x in rows.column_names}
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (c["s"][1:] != c["s"][:-1]) | (c["i"][1:] != c["i"][:-1]) | (c["j"][1:] != c["j"][:-1])
    again = np.zeros(len(rows), dtype=bool)
    again[1:] = ~new[1:] & (c["cls"][1:] == c["cls"][:-1])
    c, new = {k: v[~again] for k, v in c.items()}, new[~again]
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(new)))
    ends = np.repeat(begins + sizes, sizes)
    cls, own, has, q, comp = c["cls"], c["own"], c["open"], c["q"], c["c"]
    n, pos = c["n"].astype(np.int64), c["pos"].astype(np.int64)
    # Of a frequent shingle, pairs that the frequent parts alone let link: q of them stand before it.
    r = np.where(q >= 0, np.minimum(q, c["r"]), c["r"])
    across = c["i"] != c["j"]
    x, step = np.arange(len(cls)), 0
    while True:
        step += 1
        x = x[x + step < ends[x]]
        if not len(x):
            return
        y = x + step
        ok = (comp[y] != comp[x]) | (has[x] & (n[y] < n[x])) | (has[y] & (n[y] > n[x]))
        ok &= ~across[x] | (own[y] != own[x])
        ok &= 100 * np.minimum(n[y], n[x]) >= PERCENT * np.maximum(n[y], n[x])
        most = np.minimum(r[y], r[x]) + np.minimum(n[y] - pos[y], n[x] - pos[x])
        ok &= (100 + PERCENT) * most >= PERCENT * (n[y] + n[x])
        a, b = x[ok], y[ok]
        if len(a):
            ints = {"an": n[a], "bn": n[b], "pa": pos[a], "pb": pos[b]}
            ints = {k: v.astype(np.int32) for k, v in ints.items()}
            yield from batches(
                {"a": cls[a], "an": ints["an"], "b": cls[b], "bn": ints["bn"], "pa": ints["pa"], "pb": ints["pb"], "often": q[b] >= 0}
            )


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the bitmaps of their sets let reach the overlap."""
    sigs = classes.select("cls", "n", "sig")
    both = pairs.select("a", "b").distinct()
    for x in ("a", "b"):
        both = both.join(sigs.select(*(F.col(c).alias(y) for c, y in (("cls", x), ("n", f"n{x}"), ("sig", f"s{x}")))), x)

    def run(parts):
        for batch in parts:
            if not len(batch):
                continue
            na, nb = (batch.column(x).to_numpy() for x in ("na", "nb"))
            most = most_common(na, batch.column("sa").to_pylist(), nb, batch.column("sb").to_pylist())
            mask = pa.array((100 + PERCENT) * most >= PERCENT * (na + nb))
            yield pa.RecordBatch.from_pydict({x: batch.column(x).filter(mask) for x in ("a", "b")})

    return both.mapInArrow(run, "a long, b long")


def sets_of(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(cls, found) of all classes in the pairs (a, b), and few others; one text of a class is read.

    A broadcast bitmap of the wanted texts' hashes keeps the other texts out of the pass. The sets are for one ``probe``,
    which takes them from the shuffle that makes them one a class, without another.
    """
    wanted = staged(
        classes.select("cls", "th").join(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "cls")
    )
    bits = min(max((16 * wanted.count()).bit_length(), 16), MOST_FILTER_BITS)
    place = F.shiftrightunsigned("th", 64 - bits)
    words = wanted.groupBy(F.shiftright(place, 5).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(th, {64 - bits}) & 31 as int))")).alias("x")
    )
    got = words.toArrow()
    table = np.zeros(1 << (bits - 5), dtype=np.uint32)
    table[got.column("w").to_numpy()] = got.column("x").to_numpy().astype(np.uint32)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def fetch(parts):
        seen = set()
        for batch in parts:
            at = batch.column("th").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            hit = (shared.value[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            cls, found = [], []
            for s in _sets(batch):
                own = class_of(s) if len(s) else None
                if own is not None and own not in seen:
                    seen.add(own)
                    cls.append(own)
                    found.append(s.tobytes())
            yield pa.RecordBatch.from_pydict({"cls": pa.array(cls, pa.int64()), "found": pa.array(found, pa.binary())})

    fetched = rows.select("th", "t").mapInArrow(fetch, "cls long, found binary")
    return fetched.groupBy("cls").agg(F.first("found").alias("found"))


def probe(pairs: DataFrame, sets: DataFrame, shared, limit: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the overlap, and how many frequent shingles they share; sets are (cls, found)."""
    left = sets.select(F.col("cls").alias("a"), F.col("found").alias("fa"))
    right = sets.select(F.col("cls").alias("b"), F.col("found").alias("fb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "fa", "fb")

    def run(parts):
        for batch in parts:
            ok, common = [], []
            for x, y in zip(batch.column("fa"), batch.column("fb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = x[y[at] == x]
                ok.append(len(both) >= required(len(x), len(y)))
                if ok[-1]:
                    common.append(int((often_of(both, shared.value) > limit).sum()))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_pydict(
                {
                    "a": batch.column("a").filter(mask),
                    "b": batch.column("b").filter(mask),
                    "o": pa.array(common, pa.int64()),
                }
            )

    return both.mapInArrow(run, "a long, b long, o long")


def jaccard_components(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    split: int = SPLIT,
    block: int = BLOCK,
    frequent: int = FREQUENT,
) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with an equal set) and component_id of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("k"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    bits = min(max((size // 64).bit_length(), LEAST_BITS), MOST_BITS)
    counts = shingle_counts(rows, bits)
    shared, limit = docs.sparkSession.sparkContext.broadcast(counts), frequent_from(counts, frequent)
    known = staged(profiles(rows, shared, limit))
    lists = staged(short_lists(rows, shared, limit, split))
    # Rows of one class agree in the rest.
    agreed = (F.max(c).alias(c) for c in ("n", "nf", "part", "sig"))
    classes = known.filter("cls is not null").groupBy("cls").agg(F.min("k").alias("id"), F.min("th").alias("th"), *agreed)
    classes = staged(classes)
    members = staged(group_members(classes))
    stars = members.filter("near and cls <> rep").select("cls", "rep")
    candidates = line_candidates(lists).union(centre_candidates(lists, members)).distinct()
    candidates = staged(plausible(candidates, classes))
    # Each class meets its smallest candidate first; the others only where that leaves two components.
    nearest = staged(candidates.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    first = staged(probe(nearest, sets_of(nearest, classes, rows), shared, limit).select("a", "b").union(stars))
    apart = candidates
    known_parts = components(first)
    for x in ("a", "b"):
        part = known_parts.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
        apart = apart.join(part, x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
    apart = staged(apart.filter("ca <> cb").select("a", "b").join(nearest, ["a", "b"], "left_anti"))
    more = staged(probe(apart, sets_of(apart, classes, rows), shared, limit).select("a", "b"))
    first = first.union(more)
    labels = components(first)
    opened = members.filter("not near").select(F.col("rep").alias("cls")).distinct().withColumn("open", F.lit(True))
    reps = members.filter("cls = rep").select("cls", F.lit(True).alias("rep"))
    attributes = (
        classes.select("cls", "nf")
        .join(labels.withColumnRenamed("node", "cls"), "cls", "left")
        .join(reps, "cls", "left")
        .join(opened, "cls", "left")
        .select(
            "cls",
            "nf",
            F.coalesce("component", "cls").alias("c"),
            F.coalesce("rep", F.lit(False)).alias("rep"),
            F.coalesce("open", F.lit(False)).alias("open"),
        )
    )
    counted = staged(plausible(occurrences(lists, attributes, block), classes))
    second = staged(probe(counted, sets_of(counted, classes, rows), shared, limit))
    second = second.select("a", "b").union(further_links(second, members))
    final = components(first.union(second)) if second.limit(1).count() else labels
    named = (
        classes.select("cls", "id").join(final.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("g", F.coalesce("component", "cls"))
    )
    least = named.groupBy("g").agg(F.min("id").alias("component_id"))
    named = named.join(least, "g").select("cls", F.col("id").alias("class_id"), "component_id")
    out = known.join(named, "cls", "left")
    return out.select(
        F.col("k").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "k").alias("component_id"),
        F.coalesce("class_id", "k").alias("class_id"),
    )
