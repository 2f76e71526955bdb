"""BPE encoding and decoding.

The backtracking encoder takes the longest vocabulary token at each place of a piece, found with an
Aho-Corasick automaton of all tokens, and steps back to a shorter one where the next token is not
compatible with the one before. Two tokens are compatible when the merges, applied to their joined bytes, give
exactly these two; a piece tiled by compatible neighbours is what the merges give. Decoding gathers bytes
through an offset table. Pieces come from the public pattern of byte-level BPE; encoded words are kept in a
bounded memory per worker.

Defined cases: null and empty texts have no tokens and decode to the empty text. The strings of special tokens
in a text become their ids, as the public library does by default. Repeated rows are encoded alike.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept per worker, twice: the newest and those before them.
KEPT_WORDS = 200_000


def _letters() -> dict[str, int]:
    """The public one-to-one map between bytes and the letters that vocabulary files write them with."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Memory(dict):
    """A dictionary that makes missing values and holds a bounded number of them, in two generations."""

    def __init__(self, make, most: int = KEPT_WORDS):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        letters = _letters()
        spelled = lambda s: bytes(letters[c] for c in s)
        model = read["model"]
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.ids = {spelled(s): i for s, i in model["vocab"].items() if s not in self.special}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * size
        for b, i in self.ids.items():
            self.tokens[i] = b
        for s, i in self.special.items():
            self.tokens[i] = s.encode()
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(t) for t in self.tokens], out=self.offsets[1:])
        self.bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for n, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[spelled(a), spelled(b)] = n
        self.finder = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.finder.add_word(b.decode("latin-1"), (len(b), i))
        self.finder.make_automaton()
        self.sizes = [len(t) for t in self.tokens]
        self.most = max(self.sizes)
        #: Of every token, the longest token that is a proper prefix of it, or -1.
        self.shorter = [
            next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), -1) for t in self.tokens
        ]
        self.pieces = regex.compile(PATTERN)
        self.compatible = _Memory(self._compatible, 2 * KEPT_WORDS)
        self.words = _Memory(self._word, KEPT_WORDS // 4)
        self.after_space = _Memory(lambda w: self._words(" " + w))
        self.at_start = _Memory(self._words)
        self.specials = regex.compile("|".join(f"({regex.escape(s)})" for s in self.special)) if self.special else None

    def merged(self, data: bytes) -> list[bytes]:
        """The merges applied in order of rank: the definition, for short inputs."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.ranks.get((parts[k], parts[k + 1]), 1 << 60))
            pair = parts[best], parts[best + 1]
            if pair not in self.ranks:
                break
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _compatible(self, pair: tuple[int, int]) -> bool:
        a, b = self.tokens[pair[0]], self.tokens[pair[1]]
        return self.merged(a + b) == [a, b]

    def _word(self, piece: str) -> bytes:
        """Ids of one piece as little-endian 32-bit integers."""
        data = piece.encode()
        whole = self.ids.get(data)
        if whole is not None and self.merged(data) == [data]:
            return whole.to_bytes(4, "little")
        letters, compatible, sizes, shorter = data.decode("latin-1"), self.compatible, self.sizes, self.shorter
        path: list[int] = []
        place, token, dead = 0, self._longest(data, letters, 0), set()
        while place < len(data):
            while token >= 0 and (place + sizes[token] in dead or (path and not compatible[path[-1], token])):
                token = shorter[token]
            if token < 0:
                # Tokens of a prefix are unique, so a place that leads nowhere is never tried again.
                dead.add(place)
                token = path.pop()
                place -= sizes[token]
                token = shorter[token]
                continue
            path.append(token)
            place += sizes[token]
            if place < len(data):
                token = self._longest(data, letters, place)
        return array("I", path).tobytes()

    def _longest(self, data: bytes, letters: str, place: int) -> int:
        """The longest token that starts at a place: the automaton's longest path, back to a token."""
        end = place + self.finder.longest_prefix(letters[place : place + self.most])
        while (token := self.ids.get(data[place:end])) is None:
            end -= 1
        return token

    def _words(self, text: str) -> bytes | None:
        """Ids of a stretch between two single spaces; None if it is not independent of its neighbours."""
        inner = text[1:] if text[:1] == " " else text
        if inner.isalpha():  # one piece, by the pattern
            return self.words[text]
        if not inner or inner[0].isspace() or inner[-1].isspace():
            return None
        return b"".join([self.words[p] for p in self.pieces.findall(text)])

    def _plain(self, text: str) -> bytes:
        """A single space between two other characters always begins a piece, so stretches are independent."""
        first, *rest = text.split(" ")
        found = [self.at_start[first], *[self.after_space[w] for w in rest]]
        if None in found:
            return b"".join([self.words[p] for p in self.pieces.findall(text)])
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if not text:
            return b""
        if self.specials is None or not any(s in text for s in self.special):
            return self._plain(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            if found.start() > at:
                out.append(self._plain(text[at : found.start()]))
            out.append(self.special[found.group()].to_bytes(4, "little"))
            at = found.end()
        if at < len(text):
            out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes, step: int = 1 << 16) -> str:
        """The text of ids; bytes that are no text become replacement characters."""
        tokens, out = np.frombuffer(ids, dtype="<u4"), []
        for k in range(0, len(tokens), step):
            begin = self.offsets[tokens[k : k + step]]
            sizes = self.offsets[tokens[k : k + step].astype(np.int64) + 1] - begin
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(begin - ends + sizes, sizes)
            out.append(self.bytes[at].tobytes())
        return b"".join(out).decode("utf-8", "replace")


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are written as little-endian 32-bit integers of the machine")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", ids: bool = False) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of every text, and with ``ids`` the ids themselves.

    ``path`` names the vocabulary file, present on every executor.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    digest = lambda b: hashlib.sha256(b).hexdigest()

    def run(rows):
        bpe = load(path)
        for batch in rows:
            encoded = [bpe.encode(t or "") for t in batch.column("t").to_pylist()]
            columns = {
                "doc_id": batch.column("k"),
                "n_tokens": pa.array([len(e) // 4 for e in encoded], pa.int64()),
                "ids_sha256": pa.array([digest(e) for e in encoded], pa.string()),
                "decoded_sha256": pa.array([digest(bpe.decode(e).encode()) for e in encoded], pa.string()),
            }
            if ids:
                columns["ids"] = pa.array([np.frombuffer(e, "<i4") for e in encoded], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(doc_id).cast("long").alias("k"), F.col(text).alias("t")).mapInArrow(run, schema)
