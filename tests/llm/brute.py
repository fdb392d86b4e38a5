"""Plain Python versions of the contracts, and small tables that hold every odd case."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def odd_documents():
    """Nulls, empty and very long texts, copies, near copies, shared lines and passages."""
    r = random.Random(7)
    vocab = ["the", "of", "and", "to", "is"] * 3 + ["w" + "".join(r.choices("abcdeéß", k=r.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    shared, passage = "A line that a good many documents carry, word for word.", prose(55)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "two words"), (5, prose(9000))]
    base = prose(160)
    rows += [(i, base) for i in (10, 12, 11)]  # exact copies
    for i in range(20, 32):  # near copies of one text
        words = base.split()
        words[r.randrange(len(words))] = "changed%d" % i
        rows.append((i, " ".join(words)))
    for i in range(40, 49):  # a line that goes but for the last one, and a passage
        rows.append((i, prose(30) + "\n  " + (shared.upper() if i % 2 else shared) + "\n" + passage + "\n" + prose(20) + "\n" + shared))
    rows += [(60, "x " * 300), (61, "a b c " * 100), (62, prose(25) + "\n\n" + prose(60) + "\r\n" + prose(3))]
    rows += [(70 + i, prose(r.randint(1, 120))) for i in range(30)]
    rows += [(10, base), (41, rows[[i for i, _ in rows].index(41)][1])]  # rows repeated
    return rows


def quality(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))


def lines(rows):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(line_key(line)) >= 40:
                holders[line_key(line)].add(i)
    out = []
    for i, t in rows:
        split = (t or "").split("\n")
        keep = [x for x in split if i is None or len(line_key(x)) < 40 or len(holders[line_key(x)]) < 5 or max(holders[line_key(x)]) == i]
        out.append((i, len(split), len(split) - len(keep), sha("\n".join(keep))))
    return out


def substrings(rows, n=20):
    first, out = {}, []
    for i, t in sorted({x for x in rows if x[0] is not None}, key=lambda x: (x[0], x[1] or "")):
        w = WORD.findall(t or "")
        gone = set()
        for s in range(len(w) - n + 1):
            if first.setdefault(tuple(w[s : s + n]), (i, s)) != (i, s):
                gone |= set(range(s, s + n))
        out.append((i, t, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    found = {(i, t): (i, *rest) for i, t, *rest in out}
    return [found.get((i, t), (i, len(WORD.findall(t or "")), 0, sha(" ".join(WORD.findall(t or ""))))) for i, t in rows]


def near(rows, n, percent=80):
    """doc_id -> (size of the set, component)."""
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(n, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows(rows, n, percent=80):
    """Per row: (doc_id, size of the set, component), where ids may be repeated with
    different texts: such rows are linked."""
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(n, len(w))
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            common = len(sets[a] & sets[b])
            alike = 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common)
            if sets[a] and sets[b] and (alike or rows[a][0] == rows[b][0]):
                root[find(b)] = find(a)
    least = {}
    for a, (i, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), i), i)
    return [(i, len(s), least[find(a)]) for a, ((i, _), s) in enumerate(zip(rows, sets))]
