"""Plain one-by-one versions of what the operators return."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def rem(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
        len(w) < 50 or 100 * len(hit) > 50 * len(w),
    )


def shingle_set(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_components(rows):
    """rows: (doc_id, text); gives {doc_id: (size, component)}."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


def base_scores(rows):
    """{doc_id: (n_tokens, n_known, N, score)} of the word model."""
    tokens = {i: [*words((t or "").translate(LOWER)), None] for i, t in rows}
    c = Counter(x for i, ts in tokens.items() if rem(i, 10) for x in ts)
    n, v = sum(c.values()), len(c)
    return {
        i: (len(ts), sum(c[x] > 0 for x in ts), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in ts))
        for i, ts in tokens.items()
    }


def pair_scores(rows, mix=0.3):
    """{doc_id: score} of the word model mixed with all pairs of training."""
    tokens = {i: [*words((t or "").translate(LOWER)), None] for i, t in rows}
    c = Counter(x for i, ts in tokens.items() if rem(i, 10) for x in ts)
    both = Counter(x for i, ts in tokens.items() if rem(i, 10) for x in zip([ts[-1], *ts], ts, strict=False))
    total = sum(c.values()) + 0.1 * (len(c) + 1)

    def part(v, w):
        p = (c[w] + 0.1) / total
        return math.log10((1 - mix) * p + mix * both[v, w] / c[v] if c[v] else p)

    return {i: sum(part(v, w) for v, w in zip([ts[-1], *ts], ts, strict=False)) for i, ts in tokens.items()}


def without_repeats(rows, size=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - size + 1):
            x = raw[s : s + size]
            if x in seen:
                gone[s : s + size] = b"\x01" * size
            seen.add(x)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def targets(sizes, cycle=(5, 2, 1), total=1.5, most=2):
    """{source: target}: excess is shared again by weight until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    left, open_, out = total * sum(sizes.values()), set(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / whole > most * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / whole for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in full)
        open_ -= full
    return out
