"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds all runs of words of the benchmark's items. A document's
words stream through it; at every word it knows the longest run of words ending
there that some item holds too. Where that is at least ``window`` words long, the
last ``window`` words are hit. An item of fewer words than a window counts as one
window as a whole. What is found are word spans and items; ``decontaminate`` cuts
the spans out of the texts and drops documents that are covered too far.

Plan: items are cut into pieces of at most ``PIECE_WORDS`` words that overlap by a
window less one word, so no window is lost, and dealt to shards of about
``SHARD_WORDS`` words. For each shard the documents are read once, without a
shuffle; only a shard's pieces, which that number bounds, are sent to the workers,
which build the automaton once. Up to that size of benchmark there is one shard
and one pass; beyond it the passes are written to the shared folder in between.
Nothing grows with the documents but the stream itself.

Defined cases: a null or empty text has no words and no hits. Items without id,
text or words take no part; items of one id count as one. Repeated documents are
rows of their own. An empty benchmark hits nothing. All other columns of the
documents pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.tables import materialise
from nimbusmart.llm.terms import TABLE, term_slices, terms

WINDOW = 10
PIECE_WORDS = 4096
SHARD_WORDS = 250_000
_LONG_WORD = 32

_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_HITS = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])
HITS_DDL = "struct<n_words:bigint,spans:array<struct<first:bigint,last:bigint>>,items:array<string>>"


def _name(word: bytes) -> bytes:
    """A word, or 33 bytes that stand for a long one; 0xFF is in no UTF-8 text."""
    return word if len(word) <= _LONG_WORD else b"\xff" + hashlib.sha256(word).digest()


class Automaton:
    """Generalised suffix automaton over pieces (item, words, whole)."""

    def __init__(self, pieces: list[tuple[str, list[bytes], bool]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        coded = [(item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], whole) for item, words, whole in pieces]
        self.size = max(len(self.vocabulary), 1)
        self.long_words = any(len(w) > _LONG_WORD for w in self.vocabulary)
        self.next: dict[int, int] = {}  # state * size + word -> state
        self.link, self.length = [-1], [0]
        out: list[list[int]] = [[]]  # words that leave each state; only for cloning
        for _, words, _ in coded:
            last = 0
            for w in words:
                last = self._extend(last, w, out)
        del out
        # The state that holds the last ``window`` words of what a state holds.
        self.last_window = [-1] * len(self.link)
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            if self.length[s] >= window:
                up = self.link[s]
                self.last_window[s] = s if self.length[up] < window else self.last_window[up]
        self.items: dict[int, set[str]] = {}  # state of a window -> items that hold it
        self.short: dict[int, list[tuple[int, str]]] = {}  # state -> (length, item) of whole short items
        bigrams = set()
        self.least = window
        for item, words, whole in coded:
            state = 0
            for i, w in enumerate(words):
                state = self.next[state * self.size + w]
                if i:
                    bigrams.add(words[i - 1] * self.size + w)
                if self.length[state] >= window and i + 1 >= window:
                    self.items.setdefault(self.last_window[state], set()).add(item)
            if whole and 0 < len(words) < window:
                self.least = min(self.least, len(words))
                self.short.setdefault(state, []).append((len(words), item))
        # Whether a state or one above it holds a whole short item.
        self.has_short = [False] * len(self.link)
        if self.short:
            for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                self.has_short[s] = s in self.short or self.has_short[self.link[s]]
        self._bits = max(16, (4 * len(bigrams) + 1).bit_length())
        self._pairs = np.zeros(1 << self._bits, dtype=bool)
        self._pairs[self._place(np.fromiter(bigrams, dtype=np.uint64, count=len(bigrams)))] = True

    def _extend(self, last: int, w: int, out: list[list[int]]) -> int:
        size, step = self.size, self.next
        at = step.get(last * size + w)
        if at is not None:
            return at if self.length[at] == self.length[last] + 1 else self._clone(last, at, w, out)
        new = len(self.link)
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        out.append([])
        p = last
        while p != -1 and p * size + w not in step:
            step[p * size + w] = new
            out[p].append(w)
            p = self.link[p]
        if p != -1:
            q = step[p * size + w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w, out)
        return new

    def _clone(self, p: int, q: int, w: int, out: list[list[int]]) -> int:
        """A state for the shorter part of what ``q`` holds."""
        size, step = self.size, self.next
        c = len(self.link)
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        out.append(list(out[q]))
        for x in out[q]:
            step[c * size + x] = step[q * size + x]
        self.link[q] = c
        while p != -1 and step.get(p * size + w) == q:
            step[p * size + w] = c
            p = self.link[p]
        return c

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)

    def codes(self, text: str | None) -> np.ndarray:
        """The automaton's number of each word of ``text``; -1 for unknown words."""
        get, parts = self.vocabulary.get, []
        for words in term_slices(text):
            if self.long_words:
                words = [_name(w) for w in words]
            parts.append(np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words)))
        return np.concatenate(parts) if len(parts) != 1 else parts[0]

    def _stretches(self, codes: np.ndarray) -> np.ndarray:
        """(first, end) of the stretches in which a hit can lie: known words, each
        two neighbours of which stand together in the benchmark as well (up to
        a hash), at least as many as the shortest window has."""
        known = codes >= 0
        if not known.any():
            return np.zeros((0, 2), dtype=np.int64)
        joined = known[1:] & known[:-1]
        at = np.flatnonzero(joined)
        pairs = codes[at].astype(np.uint64) * np.uint64(self.size) + codes[at + 1].astype(np.uint64)
        joined[at] = self._pairs[self._place(pairs)]
        begins = known.copy()
        begins[1:] &= ~joined
        ends = known.copy()
        ends[:-1] &= ~joined
        edges = np.stack([np.flatnonzero(begins), np.flatnonzero(ends) + 1], axis=1)
        return edges[edges[:, 1] - edges[:, 0] >= self.least]

    def match(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words; the spans (first, last word) of hits; the items hit."""
        codes = self.codes(text)
        spans: list[tuple[int, int]] = []
        windows, items = set(), set()
        step, size, link, length, window = self.next, self.size, self.link, self.length, self.window
        for first, end in self._stretches(codes).tolist():
            state = depth = 0
            for i, w in enumerate(codes[first:end].tolist(), first):
                at = step.get(state * size + w)
                while at is None and state:
                    state = link[state]
                    depth = length[state]
                    at = step.get(state * size + w)
                if at is None:
                    continue
                state, depth = at, depth + 1
                if depth >= window:
                    windows.add(self.last_window[state])
                    spans.append((i - window + 1, i))
                if self.has_short[state]:
                    t = state
                    while t > 0:
                        for n, item in self.short.get(t, ()):
                            if n <= depth:
                                spans.append((i - n + 1, i))
                                items.add(item)
                        t = link[t]
        for s in windows:
            items |= self.items[s]
        return len(codes), merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


_built: dict[str, Automaton] = {}


def _automaton(key: str, pieces, window: int) -> Automaton:
    """The shard's automaton, built once in a worker; the one before goes."""
    if key not in _built:
        _built.clear()
        rows = [(item, words.split(b" "), whole) for item, words, whole in pieces.value]
        _built[key] = Automaton(rows, window)
    return _built[key]


def _pieces(window: int):
    schema = pa.schema([("item", pa.string()), ("words", pa.binary()), ("n", pa.int64()), ("whole", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = [_name(w) for w in terms(text)]
                starts = range(0, max(len(words) - window + 1, 1), PIECE_WORDS)
                cut = [words[s : s + PIECE_WORDS + window - 1] for s in starts] if words else []
                rows = [(item, b" ".join(c), len(c), len(cut) == 1) for c in cut]
                if rows:
                    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run, "item string, words binary, n long, whole boolean"


def _shards(benchmark: DataFrame, window: int) -> tuple[DataFrame, int]:
    """(item, words, whole, shard), written, and the number of shards."""
    run, ddl = _pieces(window)
    items = benchmark.select(F.col("item_id").cast("string"), "text").where("item_id is not null and text is not null")
    rows = materialise(items.mapInArrow(run, ddl).distinct(), "benchmark-pieces")
    total = rows.agg(F.sum("n")).first()[0] or 0
    n = -(-total // SHARD_WORDS)
    return rows.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(max(n, 1)))), n


def _scan(key: str, pieces, window: int, merge: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            automaton = _automaton(key, pieces, window)
            before = batch.column(2).to_pylist() if merge else repeat(None)
            hits = []
            for text, old in zip(batch.column(1).to_pylist(), before):
                n, spans, items = automaton.match(text)
                if old:
                    spans = merged(spans + [(s["first"], s["last"]) for s in old["spans"]])
                    items = items | set(old["items"])
                hits.append({"n_words": n, "spans": [{"first": a, "last": b} for a, b in spans], "items": sorted(items)})
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, _HITS)], names=["doc", "text", "hits"])

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, text, hits): the row of ``docs`` as a struct, its text, and the
    number of words, word spans (first, last) and items (as strings) found."""
    shards, n = _shards(benchmark, window)
    sc = docs.sparkSession.sparkContext
    whole = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("doc")
    rows = docs.select(whole, docs["text"].alias("text"))
    schema = rows.withColumn("hits", F.lit(None).cast(HITS_DDL)).schema
    for shard in range(max(n, 1)):
        found = shards.where(F.col("shard") == shard).select("item", "words", "whole").collect()  # about SHARD_WORDS words
        pieces = sc.broadcast([(r["item"], bytes(r["words"]), r["whole"]) for r in found])
        rows = rows.mapInArrow(_scan(uuid.uuid4().hex, pieces, window, shard > 0), schema)
        if shard + 1 < n:
            rows = materialise(rows, "benchmark-pass")
    return rows


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)


def _cut(text: str, spans: list[dict]) -> str:
    """``text`` without the words of ``spans``, from the first byte of a span's
    first word to the last byte of its last one."""
    data = text.encode()
    buf = np.frombuffer(data.translate(TABLE), dtype=np.uint8)
    gap = np.ones(len(buf) + 2, dtype=bool)
    gap[1:-1] = buf == 0x20
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    begin, end = edge[0::2], edge[1::2]
    out, at = [], 0
    for s in spans:
        out.append(data[at : begin[s["first"]]])
        at = int(end[s["last"]])
    return b"".join([*out, data[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_percent: float = 50.0) -> DataFrame:
    """``docs`` without the spans found in the benchmark; documents of whose
    words more than ``max_percent`` percent are hit are dropped."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                _cut(t, h["spans"]) if h["spans"] else t
                for t, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc", "text"])

    rows = find_contamination(docs, benchmark, window)
    rows = rows.where(100 * n_hit(F.col("hits.spans")) <= max_percent * F.col("hits.n_words"))
    rows = rows.mapInArrow(cut, rows.select("doc", "text").schema)
    names = [F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return rows.select(*names)
