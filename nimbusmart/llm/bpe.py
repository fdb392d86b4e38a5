"""BPE encoding and decoding by speculation and verification.

``encode`` gives every text its token ids and the decoded text, exactly as the
public vocabulary file defines them (NFC, lower case, word pattern, byte-level
symbols, an end-of-word mark, merges by rank; no decoder, so decoding joins the
tokens with a space).

A word is first cut by greedy longest match. The cut is the BPE result if every
token is what BPE makes of the token's own characters and if no merge happens
across any two neighbours; both tests are vectorised over all new words of a
batch. Only words that fail are merged pair by pair.

The work is one ``mapInArrow`` pass without a shuffle: words repeat, so each
Python worker keeps a bounded cache of them and looks each distinct word up once.

Python, ``regex`` and the tokenizers library follow different versions of Unicode.
``odd_characters`` finds the code points on which they differ from the library's
own normaliser and pre-tokenizer, once on the driver; pieces that hold one of
these are normalised and split by the library's classes.

Defined cases: a null text counts as empty (0 tokens, hashes of the empty
string). Very long texts are handled whole. Special tokens written in a text
count as those tokens. Repeated rows give repeated results, empty tables empty
results; other columns of the input are not returned.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

# Fixed values of the vocabulary's word pattern and end-of-word mark.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
CACHED_WORDS = 600_000
LONG_WORD = 64
# Separators that str.split knows and the word pattern doesn't count as space.
_ODD_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")
_NEVER = np.iinfo(np.int64).max


def _library_normalizer() -> normalizers.Normalizer:
    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def _library_split() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(WORD_PATTERN), "removed", invert=True)


def _library_classes(points: list[str]) -> dict[str, int]:
    """The words that the library makes of a code point written twice between two
    letters: 1 for letters, 4 for numbers, 3 for others. Space is left out."""
    split, out = _library_split(), {}
    for run, _ in split.pre_tokenize_str("".join(points)):
        kind = len(split.pre_tokenize_str(f"a{run[0] * 2}b"))
        out.update(dict.fromkeys(run, kind))
    return out


@lru_cache(maxsize=1)
def odd_characters() -> str:
    """Code points that Python or ``regex`` and the library class, lower-case,
    order or compose differently, and those that become such ones."""
    # Planes 4 to 13, 15 and 16 hold no characters in any version.
    points = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)) if not chr(c).isspace()]
    classes = _library_classes(points)
    kinds = {**dict.fromkeys(regex.findall(r"\p{L}", "".join(points)), 1), **dict.fromkeys(regex.findall(r"\p{N}", "".join(points)), 4)}
    odd = {c for c in points if classes.get(c, 2) != kinds.get(c, 3)}
    lower = normalizers.Lowercase().normalize_str(" ".join(points)).split(" ")
    odd.update(c for c, x in zip(points, lower, strict=True) if c.replace("Σ", "σ").lower() != x)
    # Between marks of the highest and a low class, to see the order that each gives a mark.
    for form, library in (("NFC", normalizers.NFC()), ("NFD", normalizers.NFD())):
        for before, after in (("", ""), ("\u0345", "\u0334")):
            texts = [before + c + after for c in points]
            made = library.normalize_str("\n".join(texts)).split("\n")
            for c, t, x in zip(points, texts, made, strict=True):
                if unicodedata.normalize(form, t) != x:
                    odd.update(unicodedata.normalize("NFD", c) + c)
                    odd.update(normalizers.NFD().normalize_str(c))
    odd.update([c for c in points if not odd.isdisjoint(unicodedata.normalize("NFC", c).lower())])
    return "".join(sorted(odd))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the vectorised compatibility test."""

    def __init__(self, path: str, odd: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        every = self.ids | self.specials
        self.tokens = [""] * (max(every.values()) + 1)
        for token, i in every.items():
            self.tokens[i] = token
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        n = len(self.tokens)
        self.left, self.right = np.arange(n), np.arange(n)
        self.rank = np.full(n, -1, dtype=np.int64)
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for r, (a, b) in enumerate(merges):
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            self.pair_rank[x, y] = r
            self.merged.append(z)
            self.left[z], self.right[z], self.rank[z] = x, y, r
        keys = np.array([x * n + y for x, y in self.pair_rank], dtype=np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.arange(len(keys))[order]
        self.longest = max(len(t) for t in self.ids)
        self.stable = self._stable()
        self.symbols = byte_symbols()
        self.word = regex.compile(WORD_PATTERN)
        self.odd = frozenset(odd)
        self.library_normalizer, self.library_split = _library_normalizer(), _library_split()
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE leaves the boundary between neighbours ``a`` and ``b`` alone.

        Undo both tokens' merges, latest first. The pieces that meet at the
        boundary live until the merge that made their parent; a merge of the
        two with a lower rank would have crossed the boundary. Of equal ranks
        the left one is done first. ``until`` looks only at earlier ranks.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok = np.ones(len(a), dtype=bool)
        end_a = np.full(len(a), _NEVER) if until is None else until.astype(np.int64)
        end_b = end_a.copy() if until is None else end_a - 1
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            m = self._rank_of(x, y)
            ok[live[(m < end_a[live]) & (m <= end_b[live])]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_x = rx > ry
            undo_y = ~undo_x & (ry >= 0)
            i, j = live[undo_x], live[undo_y]
            end_a[i], a[i] = rx[undo_x], self.right[x[undo_x]]
            end_b[j], b[j] = ry[undo_y], self.left[y[undo_y]]
            live = live[(undo_x | undo_y) & ok[live]]
        return ok

    def _stable(self) -> np.ndarray:
        """Tokens that BPE makes of their own characters."""
        made = np.flatnonzero(self.rank >= 0)
        good = np.ones(len(self.tokens), dtype=bool)
        good[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for t in made[np.argsort(self.rank[made])]:
            good[t] &= good[self.left[t]] and good[self.right[t]]
        return good

    def greedy(self, word: str) -> list[int]:
        """Longest match first; ``word`` is in byte symbols, without the mark."""
        out, i, n, ids = [], 0, len(word), self.ids
        while i < n:
            rest = ids.get(word[i:] + END) if n - i <= self.longest else None
            if rest is not None:
                out.append(rest)
                break
            j = min(n - 1, i + self.longest)
            while word[i:j] not in ids:
                j -= 1
            out.append(ids[word[i:j]])
            i = j
        return out

    def _symbols(self, word: str) -> list[int]:
        return [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + END]]

    def merge(self, word: str) -> list[int]:
        """Exact BPE of one word of any length, by a heap of possible merges."""
        ids = self._symbols(word)
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        get = self.pair_rank.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != x or ids[j] != y:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (q := get((ids[k], ids[after[k]]))) is not None:
                    heapq.heappush(heap, (q, k, ids[k], ids[after[k]]))
        return [t for t in ids if t >= 0]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """Exact BPE of many words of similar length at once: every step does
        each word's first merge of lowest rank."""
        lists = [self._symbols(w) for w in words]
        sizes = np.array([len(x) for x in lists])
        width = int(sizes.max())
        ids = np.full((len(words), width + 1), -1, dtype=np.int64)
        for i, x in enumerate(lists):
            ids[i, : len(x)] = x
        ranks = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        merged, columns = np.array(self.merged), np.arange(width)
        live = np.arange(len(words))
        while len(live):
            at = ranks[live].argmin(axis=1)
            lowest = ranks[live, at]
            live, at, lowest = (x[lowest != _NEVER] for x in (live, at, lowest))
            if not len(live):
                break
            # Move what stands after the pair one place to the left.
            ids[live, at] = merged[lowest]
            take = columns + (columns > at[:, None])
            ids[live, :width] = np.take_along_axis(ids[live], take, axis=1)
            ranks[live, : width - 1] = np.take_along_axis(ranks[live], take[:, : width - 1], axis=1)
            ids[live, width], ranks[live, width - 1] = -1, _NEVER
            ranks[live, at] = self._pair_ranks(ids[live, at], ids[live, at + 1])
            left = at > 0
            i, j = live[left], at[left]
            ranks[i, j - 1] = self._pair_ranks(ids[i, j - 1], ids[i, j])
            sizes[live] -= 1
        return [row[:n].tolist() for row, n in zip(ids, sizes, strict=True)]

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where((a < 0) | (b < 0), _NEVER, self._rank_of(np.maximum(a, 0), np.maximum(b, 0)))

    def mend(self, words: list[str]) -> list[list[int]]:
        """Exact BPE of the words whose proposals failed, by length."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for lo in range(0, len(order), 2048):
            part = order[lo : lo + 2048]
            short = [i for i in part if len(words[i]) <= LONG_WORD]
            if short:
                for i, x in zip(short, self.merge_all([words[i] for i in short]), strict=True):
                    out[i] = x
            for i in part[len(short) :]:
                out[i] = self.merge(words[i])
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of words: speculate, verify all at once, mend the failures."""
        proposals = [self.greedy(w) for w in words]
        sizes = np.array([len(p) for p in proposals])
        flat = np.array([t for p in proposals for t in p], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        bad = np.zeros(len(words), dtype=bool)
        bad[owner[~self.stable[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair, back = np.unique(flat[inner] * len(self.tokens) + flat[inner + 1], return_inverse=True)
        fits = self.compatible(pair // len(self.tokens), pair % len(self.tokens))
        bad[owner[inner[~fits[back]]]] = True
        failed = np.flatnonzero(bad).tolist()
        for i, ids in zip(failed, self.mend([words[i] for i in failed]), strict=True):
            proposals[i] = ids
        return proposals

    def split(self, chunk: str) -> list[str]:
        """Words of a piece of text, in byte symbols."""
        if chunk.isascii() or self.odd.isdisjoint(chunk):
            words = self.word.findall(unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())
        else:
            text = self.library_normalizer.normalize_str(chunk)
            words = [w for w, _ in self.library_split.pre_tokenize_str(text)]
        symbols = self.symbols
        return ["".join([symbols[b] for b in w.encode()]) for w in words]

    def pieces(self, text: str) -> list[str]:
        """Space-free pieces of a text; special tokens stand alone."""
        if any(s in text for s in self.specials):
            return [
                p
                for part in self.special.split(text)
                for p in ([part] if part in self.specials else self._spaced(part))
            ]
        return self._spaced(text)

    @staticmethod
    def _spaced(text: str) -> list[str]:
        if any(c in text for c in _ODD_SPACES):
            return regex.findall(r"\S+", text)
        return text.split()


@lru_cache(maxsize=2)
def vocabulary(path: str, odd: str) -> Vocabulary:
    return Vocabulary(path, odd)


class Encoder:
    """A vocabulary with bounded caches of words and space-free pieces."""

    def __init__(self, voc: Vocabulary, most: int = CACHED_WORDS):
        self.voc, self.most = voc, most
        self.words: dict[str, list[int]] = {}
        self.known: dict[str, tuple[int, str, str]] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        new = [p for p in pieces if p not in self.known]
        split = [[] if p in self.voc.specials else self.voc.split(p) for p in new]
        fresh = list({w for ws in split for w in ws if w not in self.words})
        if fresh:
            self.words.update(zip(fresh, self.voc.encode_words(fresh), strict=True))
        tokens = self.voc.tokens
        for p, ws in zip(new, split, strict=True):
            ids = [t for w in ws for t in self.words[w]] if ws else [self.voc.specials[p]] if p in self.voc.specials else []
            self.known[p] = (len(ids), " ".join(map(str, ids)), " ".join([tokens[t] for t in ids]))

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, ids and decoded text."""
        pieces = self.voc.pieces(text)
        if len(self.known) > self.most:
            self.known.clear()
            self.words.clear()
        known = self.known
        try:
            got = [known[p] for p in pieces]
        except KeyError:
            self.learn(set(pieces))
            got = [known[p] for p in pieces]
        return sum([g[0] for g in got]), " ".join([g[1] for g in got]), " ".join([g[2] for g in got])


def _rows(batch: pa.RecordBatch, encoder: Encoder, make: Callable) -> list[tuple]:
    keys, texts = batch.column(0).to_pylist(), batch.column(1)
    # Learn the new words of the whole batch together, a slice of texts at a time.
    out = []
    for lo in range(0, len(keys), 64):
        part = [t or "" for t in texts.slice(lo, 64).to_pylist()]
        if len(encoder.known) <= encoder.most:
            encoder.learn({p for t in part for p in encoder.voc.pieces(t)} if len(part) > 1 else ())
        out += [(k, *make(*encoder.encode(t))) for k, t in zip(keys[lo : lo + 64], part, strict=True)]
    return out


def _map(docs: DataFrame, path: str, schema: pa.Schema, ddl: str, make: Callable, key: str, text: str) -> DataFrame:
    odd = odd_characters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path, odd))
        for batch in batches:
            if batch.num_rows:
                columns = zip(*_rows(batch, encoder, make), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ddl)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (array) and the decoded text of every document."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    )
    make = lambda n, ids, decoded: (n, [int(i) for i in ids.split()], decoded)
    return _map(docs, path, schema, "doc_id long, n_tokens long, ids array<int>, decoded string", make, key, text)


def _hex(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text; the
    ids themselves never leave the task."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    make = lambda n, ids, decoded: (n, _hex(ids), _hex(decoded))
    return _map(docs, path, schema, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make, key, text)
