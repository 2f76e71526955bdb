"""Document fingerprints: prefix polynomial hashes.

For a text of code points c0, c1, … and a base B, prefix sums of c(k)·B^k modulo a prime give the hash
of any span; two spans are equal when their hashes, shifted to one power, are. Two primes below 2^31 are
used together. ``common_extension`` finds the longest common extension from two positions by
binary search over the prefix arrays.

A fingerprint is the length, the hash of the whole text, and the hashes of its blocks on the coarsest power-of-two
grid with at most 32 blocks, all read from the prefix arrays. Likeness of two fingerprints is the share
of characters in equal blocks at equal positions, on the coarser of both grids.

Defined cases: null and empty texts have length 0 and equal fingerprints, alike by 1. The next document
follows in order of id (null first), then text; the last is followed by the first, and a single
document by itself. Repeated rows follow each other. Memory follows the longest text (about 40 bytes per character).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowdigest.llm.common import staged

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
BLOCKS = 32
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(which: int, n: int) -> np.ndarray:
    """B^0 … B^(n-1), kept for the next call."""
    table, prime = _powers[which], np.uint64(PRIMES[which])
    while len(table) < n:
        step = np.uint64(pow(BASES[which], len(table), PRIMES[which]))
        table = np.concatenate([table, table * step % prime])
    _powers[which] = table
    return table[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Prefixes:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        points = code_points(text).astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        self.sums = []
        for which, prime in enumerate(PRIMES):
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(points * powers(which, self.n) % np.uint64(prime), out=sums[1:])
            self.sums.append((sums % np.uint64(prime)).astype(np.uint32))

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of spans; equal texts have equal hashes wherever they stand."""
        out = np.zeros(len(begin), dtype=np.uint64)
        for which, prime in enumerate(PRIMES):
            p = np.uint64(prime)
            sums = self.sums[which].astype(np.uint64)
            part = (sums[end] + p - sums[begin]) % p
            inverse = pow(BASES[which], -1, prime)
            back = np.array([pow(inverse, int(b), prime) for b in begin], dtype=np.uint64)
            out = (out << np.uint64(31)) | (part * back % p)
        return out

    def equal(self, a: int, b: int, size: int, other: Prefixes) -> bool:
        for which, prime in enumerate(PRIMES):
            x = (int(self.sums[which][a + size]) - int(self.sums[which][a])) % prime
            y = (int(other.sums[which][b + size]) - int(other.sums[which][b])) % prime
            if x * pow(BASES[which], b, prime) % prime != y * pow(BASES[which], a, prime) % prime:
                return False
        return True


def common_extension(x: Prefixes, a: int, y: Prefixes, b: int) -> int:
    """Length of the longest common extension of ``x`` from ``a`` and ``y`` from ``b``."""
    low, high = 0, min(x.n - a, y.n - b)
    while low < high:
        middle = (low + high + 1) // 2
        if x.equal(a, b, middle, y):
            low = middle
        else:
            high = middle - 1
    return low


def grid(n: int) -> int:
    """Power of two so that blocks of that length are at most ``BLOCKS``."""
    return max(0, math.ceil(math.log2(max(1, n) / BLOCKS)))


def _block_hashes(text: Prefixes, power: int) -> np.ndarray:
    begin = np.arange(0, text.n, 1 << power, dtype=np.int64)
    return text.spans(begin, np.minimum(begin + (1 << power), text.n))


def fingerprint(text: Prefixes) -> str:
    """``length-grid-whole-blocks`` with 16 hexadecimal digits a hash."""
    power = grid(text.n)
    whole = int(text.spans(np.zeros(1, dtype=np.int64), np.array([text.n]))[0]) if text.n else 0
    blocks = "".join(f"{int(h):016x}" for h in _block_hashes(text, power))
    return f"{text.n}-{power}-{whole:016x}-{blocks}"


def _parsed(print_: str) -> tuple[int, int, list[int]]:
    n, power, _, blocks = print_.split("-")
    return int(n), int(power), [int(blocks[k : k + 16], 16) for k in range(0, len(blocks), 16)]


def _coarser(n: int, power: int, hashes: list[int], target: int) -> list[int]:
    low = (1 << 31) - 1
    while power < target:
        merged = []
        for k in range(0, len(hashes), 2):
            pair = hashes[k : k + 2]
            if len(pair) == 1:
                merged.append(pair[0])
                continue
            value = 0
            for which, shift in ((0, 31), (1, 0)):
                a, b = (pair[0] >> shift) & low, (pair[1] >> shift) & low
                value = (value << 31) | (a + b * pow(BASES[which], 1 << power, PRIMES[which])) % PRIMES[which]
            merged.append(value)
        hashes, power = merged, power + 1
    return hashes


def likeness(a: str, b: str) -> float:
    """Share of the longer text's characters that lie in equal blocks at equal positions."""
    if a == b:
        return 1.0
    (n, p, x), (m, q, y) = _parsed(a), _parsed(b)
    power = max(p, q)
    x, y = _coarser(n, p, x, power), _coarser(m, q, y, power)
    size, same = 1 << power, 0
    for k, (u, v) in enumerate(zip(x, y)):
        length = min(size, n - k * size)
        if u == v and length == min(size, m - k * size):
            same += length
    return same / max(n, m)


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Documents (k, text, guest) in ranges of ids, sorted; the first guest of a range follows its last document.

    Ids are cut into ranges by quantiles; each range also gets the first document of the next range that
    has one, so following documents always lie in one task. Only one id per range reaches the driver.
    """
    spark = docs.sparkSession
    low = -(1 << 63)
    rows = docs.select(F.col(doc_id).cast("long").alias("k"), F.coalesce(text, F.lit("")).alias("text"))
    key = F.coalesce("k", F.lit(low))
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Exact ids of about even ranks: the least id of each range of a range partitioning of the ids.
    ids = staged(
        docs.select(F.col(doc_id).cast("long").alias("k")).select(key.alias("k"))
        .repartitionByRange(count, "k").select("k", F.spark_partition_id().alias("p"))
    )
    firsts = [r["k"] for r in ids.groupBy("p").agg(F.min("k").alias("k")).orderBy("k").collect()]
    if not firsts:
        return rows.withColumn("guest", F.lit(False))
    table = F.split(F.lit(",".join(map(str, firsts))), ",").cast("array<bigint>")
    here = F.size(F.filter(table, lambda x: x <= F.col("key"))) - 1
    n = len(firsts)
    place = F.when(F.array_contains(table, F.col("key")), F.array(F.col("p"), (F.col("p") - 1 + n) % n)).otherwise(
        F.array("p")
    )
    # Rows with a range's first id may be several; only the first of them follows the range before.
    dealt = (
        rows.withColumn("key", key)
        .withColumn("p", here.cast("int"))
        .withColumn("to", F.explode(place))
        .withColumn("guest", F.col("to") != F.col("p"))
    )
    if n == 1:  # the only range is its own neighbour
        dealt = rows.withColumn("key", key).withColumn("p", F.lit(0)).withColumn("to", F.lit(0)).withColumn(
            "guest", F.explode(F.array(F.lit(False), F.lit(True)))
        ).filter(f"not guest or key = {firsts[0]}")
    return dealt.repartitionById(n, F.col("to")).sortWithinPartitions("guest", "key", "text")


def fingerprint_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The digest of every document and of its edited text (see the package's queries)."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, lce_edited long"
    )

    def digest(rows):
        out: dict[str, list] = {name: [] for name in (c.split()[0] for c in schema.split(", "))}
        before = None

        def put(one, following):
            k, text, made, print_ = one
            n = made.n
            half = n // 2
            edited = text[: n - half] + following[1][:half]
            other = Prefixes(edited)
            edited_print = fingerprint(other)
            values = (
                k,
                n,
                hashlib.sha256(edited.encode()).hexdigest(),
                print_,
                edited_print,
                likeness(print_, edited_print),
                likeness(print_, following[3]),
                common_extension(made, 0, other, 0),
            )
            for name, value in zip(out, values):
                out[name].append(value)

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(v, pa.float64() if c.startswith("near") else pa.string() if "finger" in c or "sha" in c else pa.int64())
                    for c, v in out.items()
                ],
                names=list(out),
            )
            for v in out.values():
                v.clear()
            return batch

        done = False
        for batch in rows:
            for k, text, guest in zip(
                batch.column("k").to_pylist(), batch.column("text").to_pylist(), batch.column("guest").to_pylist()
            ):
                if done:
                    break
                made = Prefixes(text)
                now = (k, text, made, fingerprint(made))
                if before is not None:
                    put(before, now)
                before, done = now, guest
            if out["doc_id"]:
                yield flush()

    return with_next(docs, text, doc_id).select("k", "text", "guest").mapInArrow(digest, schema)
