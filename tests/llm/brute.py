"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

GAP = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def base(text):
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    repeat = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(repeat),
        len(w) < 50 or 100 * len(repeat) > 50 * len(w),
    )


def shingle_set(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def jaccard_components(docs):
    sets = {k: shingle_set(t) for k, t in docs}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(k for k in sets if sets[k])
    holders = defaultdict(list)
    for k in ids:
        for s in sets[k]:
            holders[s].append(k)
    for k in ids:
        common = Counter(j for s in sets[k] for j in holders[s] if j > k)
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[k]) + len(sets[j]) - n):
                a, b = find(k), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in sets}


def line_dedup(docs, run=3, least=50):
    seen, out = set(), {}
    for k, text in sorted(docs, key=lambda d: d[0]):
        if text is None:
            out[k] = None
            continue
        lines = text.split("\n")
        real = [i for i, x in enumerate(lines) if words(x)]
        gone = set()
        for size in range(1, run + 1):
            for j in range(len(real) - size + 1):
                at = real[j : j + size]
                key = tuple(lines[i] for i in at)
                if size < run and sum(len(words(x)) for x in key) < least:
                    continue
                if key in seen:
                    gone |= set(at)
                seen.add(key)
        out[k] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def lm_losses(docs, trusted, mix=0.5):
    """(id, tokens, target loss, background loss, score) by plain bigram models of the trusted and of all rows.

    A row's own counts are left out of the models that were counted over it.
    """
    tokens = [(k, words("".join(c.lower() if c.isascii() else c for c in t or ""))) for k, t in docs]
    models = []
    for rows in ([w for k, w in tokens if k in trusted], [w for _, w in tokens]):
        pairs = Counter(p for w in rows for p in zip([None, *w], w))
        before = Counter()
        for (v, _), n in pairs.items():
            before[v] += n
        models.append((Counter(x for w in rows for x in w), before, pairs, sum(map(len, rows))))
    size, out = len(models[1][0]), []

    def p(model, v, w):
        word, before, pair, n = model
        alone = (word[w] + 1) / (n + size)
        return mix * alone + (1 - mix) * (pair[v, w] + alone) / (before[v] + 1)

    for model in models:
        for v in (None, *list(models[1][0])[:3]):
            assert abs(sum(p(model, v, w) for w in models[1][0]) - 1) < 1e-9
    def without(model, w):
        pairs = Counter(zip([None, *w], w))
        before = Counter([None, *w[:-1]])
        return model[0] - Counter(w), model[1] - before, model[2] - pairs, model[3] - len(w)

    for k, w in tokens:
        own = [without(models[0], w) if k in trusted else models[0], without(models[1], w)]
        means = [-sum(math.log(p(m, *x)) for x in zip([None, *w], w)) / len(w) if w else None for m in own]
        out.append((k, len(w), *means, means[0] - means[1] if w else None))
    return out


def kept_first(docs, length=400):
    """Texts without the bytes that a string of ``length`` bytes covers which started earlier too."""
    seen, out = set(), {}
    for k, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(b[i : i + length])
        out[k] = t and bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    return out


def passage_bytes(docs, length=250, words=50, whole=400):
    """Bytes in runs of repeated strings of ``length`` bytes that have over ``words`` words or ``whole`` bytes."""
    raw = {k: (t or "").encode() for k, t in docs}
    at = Counter(b[i : i + length] for b in raw.values() for i in range(len(b) - length + 1))
    out = {}
    for k, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if at[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs, i = [], 0
        while (i := gone.find(1, i)) >= 0:
            end = gone.find(0, i)
            end = len(b) if end < 0 else end
            runs.append(b[i:end])
            i = end
        out[k] = sum(len(x) for x in runs if len(x) >= whole or len(x.split()) > words)
    return out


def kept_first_passages(docs, length=250, words=50, whole=400):
    """Texts without repeats that start earlier: strings of ``whole`` bytes, and runs of strings of ``length`` with many words."""
    seen, out = {length: set(), whole: set()}, {}
    for k, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        gone = {size: bytearray(len(b)) for size in seen}
        for size, flags in gone.items():
            for i in range(len(b) - size + 1):
                if b[i : i + size] in seen[size]:
                    flags[i : i + size] = b"\x01" * size
                seen[size].add(b[i : i + size])
        for m in re.finditer(b"\x01+", bytes(gone[length])):
            i, end = m.span()
            if end - i >= whole or len(b[i:end].split()) > words:
                gone[whole][i:end] = b"\x01" * (end - i)
        out[k] = t and bytes(x for x, g in zip(b, gone[whole]) if not g).decode("utf-8", "ignore")
    return out


def suffix_dedup(docs, length=400):
    at = Counter()
    raw = [(k, (t or "").encode()) for k, t in docs]
    for _, b in raw:
        at.update(hashlib.md5(b[i : i + length]).digest() for i in range(len(b) - length + 1))
    out = {}
    for k, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if at[hashlib.md5(b[i : i + length]).digest()] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out[k] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
