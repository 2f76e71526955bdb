"""LM scoring: cross-entropy difference of a target and a background model.

Two bigram models of one form share one vocabulary, the distinct words of the corpus. Words and word pairs are
known by 64-bit hashes. Both models are counted over the whole corpus: the background over all documents, the
target over all trusted ones. With c the counts, N all tokens, V the distinct words and v the word before w (a
start mark for a text's first word):

    p(w) = (c(w) + 1) / (N + V)
    p(w | v) = MIX * p(w) + (1 - MIX) * (c(v, w) + p(w)) / (c(v before any word) + 1)

which sums to 1 over the vocabulary for every v. No document is scored by its own tokens: its counts are taken
out of a model that was counted over it (of the background always, of the target if it is trusted), so trusted
and other documents are measured alike, and what a score tells of a repeated text comes from its copies. A token's loss is -log p(w | v), and a document's losses are the means
over its tokens: cross-entropies. Its score is target loss minus background loss: low is like the target.

Counts have a row for every word and pair, so what is gathered grows with the corpus; nothing is sampled or capped,
and the driver only receives the number of tokens. Documents are packed once into batches of about ``BATCH``
tokens, written with their word hashes. Each batch adds up its distinct words and pairs and sends them, sorted,
to the parts of the hash range; a part adds up all batches and answers each with the totals of what it
sent. A hot word thus is one entry a batch. The answers meet their batch again and give the losses. Parts
multiply with the corpus, so none outgrows a task.

Defined cases: null and blank texts have no tokens and a null score. Without trusted documents the target model knows
the smoothing only: p(w | v) = 1 / V. Repeated rows are scored alike; ids may be null (never trusted).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slowdigest.llm.common import ascii_lower, mixed, staged

MIX = 0.5
#: Tokens of a batch.
BATCH = 1 << 20
#: Parts of the hash range: at least so many, and one for every so many tokens.
PARTS = 1024
PART_TOKENS = 1 << 22
_START = np.uint64(0x5851F42D4C957F2D)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().split()
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def _small(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    if not values.size:
        return b""
    planes = np.ascontiguousarray(values).reshape(-1).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _plain(blob: bytes, kind: str) -> np.ndarray:
    if not blob:
        return np.zeros(0, kind)
    size = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def word_batches(rows: DataFrame, size: int = BATCH) -> DataFrame:
    """Batches of rows (doc_id, t): ids, tokens per text, distinct word hashes and each token's place in them."""

    def packed(batch, ids, found):
        words, at = np.unique(np.concatenate(found), return_inverse=True)
        lengths = np.array([len(x) for x in found], dtype=np.uint32)
        return pa.RecordBatch.from_pydict(
            {
                "batch": pa.array([batch], pa.int64()),
                "n_tokens": pa.array([len(at)], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "lengths": pa.array([_small(lengths)], pa.binary()),
                "words": pa.array([_gaps(words)], pa.binary()),
                "places": pa.array([_small(at.astype(np.uint32))], pa.binary()),
            }
        )

    def run(parts):
        batch = TaskContext.get().partitionId() << 32
        ids, found, n = [], [], 0
        for rows in parts:
            for k, text in zip(rows.column("doc_id").to_pylist(), rows.column("t").to_pylist()):
                ids.append(k)
                found.append(word_hashes(text))
                n += len(found[-1]) + 1
                if n >= size:
                    yield packed(batch, ids, found)
                    batch, ids, found, n = batch + 1, [], [], 0
        if ids:
            yield packed(batch, ids, found)

    schema = "batch long, n_tokens long, ids array<long>, lengths binary, words binary, places binary"
    return rows.mapInArrow(run, schema)


def grams(lengths: np.ndarray, words: np.ndarray, places: np.ndarray):
    """A batch's words with the start mark and its pairs, sorted; each token's word, word before, and pair in them."""
    keys = np.union1d(words, np.array([_START]))
    word = np.searchsorted(keys, words)[places]
    start = np.searchsorted(keys, _START)
    before = np.concatenate([[start], word[:-1]])[: len(word)]
    before[(np.cumsum(lengths, dtype=np.int64) - lengths)[lengths > 0]] = start
    pairs, pair = np.unique(mixed(keys[before] * np.uint64(3) + mixed(keys[word])), return_inverse=True)
    return keys, pairs, word, before, pair


def _unpacked(row: dict):
    return _plain(row["lengths"], "u4"), _keys(row["words"]), _plain(row["places"], "u4")


def _trusted(row: dict, n: int) -> np.ndarray:
    marks = np.zeros(n, dtype=bool)
    marks[row["trusted"] or []] = True
    return marks


def _gaps(keys: np.ndarray) -> bytes:
    """Ascending hashes as their compressed differences."""
    return _small(np.diff(keys, prepend=np.uint64(0)))


def _keys(blob: bytes) -> np.ndarray:
    return np.cumsum(_plain(blob, "u8"), dtype=np.uint64)


def _blobs(values: np.ndarray, bounds: np.ndarray, sorted_: bool = False) -> pa.Array:
    """The rows of ``values`` between neighbouring bounds as binary values."""
    parts = (values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))
    return pa.array([_gaps(x) if sorted_ else _small(x) for x in parts], pa.binary())


def _joined(blobs, kind: str, width: int) -> np.ndarray:
    return np.concatenate([_plain(x, kind) for x in blobs.to_pylist()]).reshape(-1, width)


def requests(batches: DataFrame, bits: int) -> DataFrame:
    """One row a batch and part: the batch's words and pairs of that part and how often it has them.

    Counts of words are: in all documents, in trusted ones, before a word in all, in trusted ones.
    """

    def run(parts):
        for rows in parts:
            for row in rows.to_pylist():
                lengths, words, places = _unpacked(row)
                keys, pairs, word, before, pair = grams(lengths, words, places)
                own = np.repeat(_trusted(row, len(lengths)), lengths)
                count = lambda *found, n: np.stack([np.bincount(x, minlength=n) for x in found], axis=1)
                counts = count(word, word[own], before, before[own], n=len(keys))
                pair_counts = count(pair, pair[own], n=len(pairs))
                part = np.arange((1 << bits) + 1)
                at, pair_at = (
                    np.searchsorted((x >> np.uint64(64 - bits)).astype(np.int64), part) for x in (keys, pairs)
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(part[:-1].astype(np.int32)),
                        "batch": pa.array([row["batch"]] * len(part[:-1]), pa.int64()),
                        "words": _blobs(keys, at, sorted_=True),
                        "counts": _blobs(counts.astype(np.uint32), at),
                        "pairs": _blobs(pairs, pair_at, sorted_=True),
                        "pair_counts": _blobs(pair_counts.astype(np.uint32), pair_at),
                    }
                )

    schema = "part int, batch long, words binary, counts binary, pairs binary, pair_counts binary"
    return batches.mapInArrow(run, schema)


_ANSWER = (
    "part int, batch long, counts binary, pair_counts binary, n_words long, n_tokens long, n_trusted long"
)


def answers(sent: DataFrame) -> DataFrame:
    """For every request the corpus's counts of what it names, and the part's distinct words and tokens."""

    def run(group: pa.Table) -> pa.Table:
        out = {"part": group.column("part"), "batch": group.column("batch")}
        sums = {}
        for names, counts, width in (("words", "counts", 4), ("pairs", "pair_counts", 2)):
            blobs = [_keys(x) for x in group.column(names).to_pylist()]
            keys, at = np.unique(np.concatenate(blobs), return_inverse=True)
            found = _joined(group.column(counts), "u4", width)
            total = np.stack(
                [np.bincount(at, weights=found[:, n], minlength=len(keys)) for n in range(width)], axis=1
            ).astype(np.int64)
            ends = np.cumsum([0, *(len(x) for x in blobs)])
            out[counts], sums[names] = _blobs(total[at], ends), total
        one = lambda n: pa.array([int(n)] * len(group), pa.int64())
        n_tokens, n_trusted = sums["words"][:, 0].sum(), sums["words"][:, 1].sum()
        n_words = (sums["words"][:, 0] > 0).sum()
        return pa.table(out | {"n_words": one(n_words), "n_tokens": one(n_tokens), "n_trusted": one(n_trusted)})

    return sent.groupBy("part").applyInArrow(run, _ANSWER)


def _in_own_text(doc: np.ndarray, found: np.ndarray) -> np.ndarray:
    """How often each token's entry occurs in the token's own document."""
    _, at, n = np.unique(doc * (int(found.max(initial=0)) + 1) + found, return_inverse=True, return_counts=True)
    return n[at]


def losses(lengths, trusted, word, before, pair, counts, pair_counts, n_words: int, totals) -> list[np.ndarray]:
    """Each token's loss by the background and by the target model, the document's own counts taken out."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    own_word, own_before, own_pair = (_in_own_text(doc, x) for x in (word, before, pair))
    out = []
    for k, (total, counted) in enumerate(zip(totals, (np.ones(len(lengths), bool), trusted))):
        own = counted[doc]
        n = total - (lengths * counted)[doc].astype(np.int64)
        unigram = (counts[word, k] - own * own_word + 1) / (n + n_words)
        bigram = (pair_counts[pair, k] - own * own_pair + unigram) / (counts[before, 2 + k] - own * own_before + 1)
        out.append(-np.log(MIX * unigram + (1 - MIX) * bigram))
    return out


def score_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", batch_tokens: int = BATCH
) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), ascii_lower(F.col(text)).alias("t"))
    batches = staged(word_batches(rows, batch_tokens))
    n_tokens = batches.agg(F.sum("n_tokens")).first()[0] or 0
    bits = max(PARTS, n_tokens // PART_TOKENS).bit_length() - 1
    trusted = (
        labels.filter(F.expr("quality = 1 and coalesce(toxic, 0) = 0") & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"))
        .distinct()
    )
    # Written, so that Spark knows its size and shuffles the batches for it only if it is large.
    marks = staged(
        batches.select("batch", F.posexplode("ids").alias("pos", "doc_id"))
        .join(trusted, "doc_id")
        .groupBy("batch")
        .agg(F.collect_list("pos").alias("trusted"))
    )
    marked = batches.join(marks, "batch", "left")
    got = answers(requests(marked, bits))

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("part")
        whole = lambda c: sum(found.column(c).to_pylist())
        ids, score = [], {c: [] for c in ("n_tokens", "target_loss", "background_loss", "score")}
        for row in own.to_pylist():
            lengths, words, places = _unpacked(row)
            _, _, word, before, pair = grams(lengths, words, places)
            counts, pair_counts = (
                _joined(found.column(c), "i8", n) for c, n in (("counts", 4), ("pair_counts", 2))
            )
            totals = whole("n_tokens"), whole("n_trusted")
            trusted = _trusted(row, len(lengths))
            by_token = losses(
                lengths, trusted, word, before, pair, counts, pair_counts, whole("n_words"), totals
            )
            full = lengths > 0
            starts = (np.cumsum(lengths, dtype=np.int64) - lengths)[full]
            background, target = (np.full(len(lengths), np.nan) for _ in range(2))
            for means, x in zip((background, target), by_token):
                means[full] = np.add.reduceat(x, starts) / lengths[full] if len(starts) else 0
            ids += row["ids"]
            for c, x in zip(score, (lengths.astype(np.int64), target, background, target - background)):
                score[c].append(pa.array(x, mask=None if c == "n_tokens" else ~full))
        return pa.table({"doc_id": pa.array(ids, pa.int64())} | {c: pa.chunked_array(x) for c, x in score.items()})

    schema = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    return marked.groupBy("batch").cogroup(got.groupBy("batch")).applyInArrow(run, schema)
