"""Best-fit packing: documents into sequences of a fixed number of tokens, in bulk.

Documents become pieces: the tokens and an end mark, and only longer ones are cut, so that all pieces but the first
have the full length. Pieces and gaps are kept as sorted runs of equal lengths. Each superstep takes the
longest run of pieces not yet placed and sweeps the sorted gaps upward for its successors: the run goes to the smallest gaps
that hold it, one piece a gap and step, the lowest ranks first; gaps shrink, and the sweep
repeats until nothing fits, when new sequences open. Equal pieces and equal gaps differ by rank only,
so a superstep moves whole rank intervals: its work follows the number of runs (at most the capacity), not of
documents. The intervals are then a bounded table (pieces of it per length), with which every task
finds sequence and offset of its pieces by rank.

Ranks are local ranks of a task plus the exact counts of the tasks before, so no length is gathered
in one task, however many documents share it.

Defined cases: a null or empty text is one piece with the end mark only. An empty table has no sequences. Rows
with equal ids are packed one by one.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slowdigest.llm.bpe import PATTERN, Bpe
from slowdigest.llm.common import staged

CAPACITY = 1024
END = 2


#: Texts with a longer stretch without a space, or more spaces in a row, go word by word.
UNBROKEN = 100_000


class PublicWords(Bpe):
    """Ids by public tokenizer libraries.

    Where the merges of the vocabulary stand in the order of their tokens' ids, as in the public files, whole texts
    are encoded by rank in one call.  Other vocabularies, texts with strings of special tokens and
    very long unbroken stretches are encoded per word, each kept word once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(path)
        self.library = Tokenizer.from_file(path)
        made = [self.ids.get(a + b, -1) for a, b in self.ranks]
        self.ranked = None
        if made == sorted(set(made)) and max((self.ids[bytes([n])] for n in range(256)), default=0) < made[0]:
            self.ranked = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=self.ids, special_tokens={})

    def _word(self, piece: str) -> bytes:
        return array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        alike = self.ranked is not None and not any(s in text for s in self.special)
        if not text or not alike or " " * UNBROKEN in text or max(map(len, text.split(" "))) > UNBROKEN:
            return super().encode(text)
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


@lru_cache(maxsize=1)
def load(path: str) -> PublicWords:
    return PublicWords(path)


def cut(size: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``size`` tokens."""
    first = size % capacity or min(size, capacity)
    begins = [0, *range(first, size, capacity)]
    return [(b, (first if k == 0 else capacity)) for k, b in enumerate(begins)]


def pieces(
    docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their checksum and local rank among the task's pieces of that length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local long"
    schema += ", ids array<int>" * ids

    def run(rows):
        bpe, seen, task = load(path), [0] * (capacity + 1), TaskContext.get().partitionId()
        end = np.array([END], dtype="<u4").tobytes()
        for batch in rows:
            out: list[list] = [[] for _ in range(8)]
            for k, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist()):
                data = bpe.encode(t or "") + end
                for n, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    part = data[4 * start : 4 * (start + length)]
                    row = (k, n, start, length, zlib.crc32(part), task, seen[length])
                    for column, value in zip(out, row):
                        column.append(value)
                    if ids:
                        out[7].append(np.frombuffer(part, "<i4"))
                    seen[length] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "local", "ids"]
            n = 8 if ids else 7
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out[:n], kinds)], names=names[:n])

    return docs.select(F.col(doc_id).cast("long").alias("k"), F.col(text).alias("t")).mapInArrow(run, schema)


def supersteps(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rank intervals (length, first rank, first sequence, offset, number) that place all pieces.

    Ranks and sequences of an interval run in parallel. Gaps are queues of sequence intervals by gap.
    """
    gaps: dict[int, deque[tuple[int, int]]] = {}
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fits = sorted(g for g in gaps if g >= length)
            if not fits:
                # A new sequence takes as many of them as fit, one after the other.
                each = capacity // length
                new = -(-left // each)
                gaps.setdefault(capacity, deque()).append((opened, new))
                opened += new
                fits = [capacity]
            gap = fits[0]
            queue = gaps[gap]
            moved: deque[tuple[int, int]] = deque()
            while left and queue:
                first, number = queue.popleft()
                taken = min(number, left)
                out.append((length, rank, first, capacity - gap, taken))
                rank, left = rank + taken, left - taken
                moved.append((first, taken))
                if taken < number:
                    queue.appendleft((first + taken, number - taken))
            if not queue:
                del gaps[gap]
            if gap > length:
                gaps.setdefault(gap - length, deque()).extend(moved)
    return out


def pack(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    made = staged(pieces(docs, path, text, doc_id, capacity, ids))
    # Rows: tasks x lengths at most.
    by_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    starts = by_task.select(
        F.col("length").alias("__length"),
        F.col("task").alias("__task"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"),
    )
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(supersteps(counts, capacity), dtype=np.int64).reshape(-1, 5)
    tables = {int(x): plan[plan[:, 0] == x] for x in np.unique(plan[:, 0])}
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    ranked = made.join(starts, (F.col("length") == F.col("__length")) & (F.col("task") == F.col("__task")))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    ranked = ranked.select(*keep, (F.col("local") + F.col("ahead")).alias("rank"))

    def place(rows):
        tables = shared.value
        for batch in rows:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(ranks), dtype=np.int64), np.empty(len(ranks), dtype=np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                table = tables[int(length)]
                at = np.searchsorted(table[:, 1], ranks[own], side="right") - 1
                sequence[own] = table[at, 2] + ranks[own] - table[at, 1]
                offset[own] = table[at, 3]
            columns = {name: batch.column(name) for name in keep}
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")
