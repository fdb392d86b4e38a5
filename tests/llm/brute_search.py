"""Plain Python versions of the contracts of spelling variants, decontamination and search."""

import math
import re
import zlib
from collections import Counter, defaultdict

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def variants(rows, every=97):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 5:
                count[w] += 1
    words = {w: n for w, n in count.items() if n >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def leaks(rows, items, window=10):
    """Per row: words, spans of hit words, items, in the order of ``rows``."""
    windows = defaultdict(set)
    for item, text in items:
        w = TERM.findall(lower(text))
        if item is None or not w:
            continue
        k = min(window, len(w))
        for j in range(len(w) - k + 1):
            windows[tuple(w[j : j + k])].add(str(item))
    sizes = {len(g) for g in windows}
    out = []
    for i, text in rows:
        w = TERM.findall(lower(text))
        hit, found = set(), set()
        for j in range(len(w)):
            for k in sizes:
                got = windows.get(tuple(w[j : j + k]))
                if got and j + k <= len(w):
                    hit |= set(range(j, j + k))
                    found |= got
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def search(rows, items, k=10):
    docs = [(i, Counter(TERM.findall(lower(t)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_words = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(TERM.findall(lower(text)))
                if t in c
            )
            if score > 0:
                scored.append((-score, (1 << 63) - 1 if i is None else i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if i == (1 << 63) - 1 else i, -s))
    return out
