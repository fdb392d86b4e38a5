"""Substring dedup: words in repeated 20-word windows go, the first stays.

The places of all documents are grouped by fingerprints of the words that start
there: the first ``SEED`` words, then all ``WINDOW`` of them. Equal windows form a
group, and all but its first place by document and position are repeats. No
suffix tree is built: prefixes have these two fixed lengths, and there are no
maximal repeats. Words go if any repeated window covers them, so windows give the
same words as maximal repeats of ``WINDOW`` words or more. Range partitioning on
(fingerprint of the first ``SEED`` words, fingerprint of all ``WINDOW`` words,
document, place) spreads the groups: a boundary falls inside a group only if the
group is larger than a partition, and then even the place may split it (see
``runs``).

Most places share no prefix with any other. To keep them out of the large
shuffle, each window names one of its own SEED-word prefixes, the one with the
smallest fingerprint; equal windows name the same one. One place a name is
grouped first; only the windows whose name has a second occurrence can
repeat, and only those are then compared in full. Texts that are exact copies
of an earlier document are settled beforehand from their digest.

Defined cases: a null or empty text has no words. A document without an id keeps
all words and makes no other repeat. Rows with the same id and text are one
document; rows with the same id and different texts are ordered by a hash of the
text. Words of any length and very long texts are taken whole. An empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.hashing import batch_word_hashes, ngram_hashes
from nimbusmart.llm.runs import repeats
from nimbusmart.llm.tables import materialise, text_key

WINDOW, SEED = 20, 6
_SHIFT = 32
_PLACES = pa.schema([(c, pa.int64()) for c in ("high", "low", "doc", "pos")])
BATCH = 256


class _Words:
    """Word hashes of a batch of texts, the windows inside them and their names."""

    def __init__(self, texts: list[bytes], window: int, seed: int):
        self.hashes, self.offsets = batch_word_hashes(texts)
        sizes = np.diff(self.offsets)
        owner = np.repeat(np.arange(len(texts)), sizes)
        n = len(self.hashes) - window + 1
        starts = np.arange(max(n, 0))
        inside = owner[starts] == owner[starts + window - 1] if n > 0 else np.zeros(0, dtype=bool)
        self.starts = starts[inside]
        self.owner = owner[self.starts]
        self.place = self.starts - self.offsets[self.owner]
        self.seeds = ngram_hashes(self.hashes, seed)
        if len(self.starts):
            views = np.lib.stride_tricks.sliding_window_view(self.seeds, window - seed + 1)
            self.name = self.starts + views.argmin(axis=1)[self.starts]
        else:
            self.name = self.starts


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t.encode() for t in batch.column(column).to_pylist()]


def _columns(high, low, doc, key, place) -> pa.RecordBatch:
    arrays = [high.view(np.int64), low.view(np.int64), doc, key << _SHIFT | place]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], schema=_PLACES)


def _names(window: int, seed: int):
    """One occurrence for every SEED-word prefix that some window names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                w = _Words(_texts(part, 2), window, seed)
                if not len(w.starts):
                    continue
                first = np.concatenate([[True], w.name[1:] != w.name[:-1]])
                name, owner = w.name[first], w.owner[first]
                doc, key = (part.column(i).to_numpy(zero_copy_only=False)[owner] for i in (0, 1))
                seeds = w.seeds[name]
                yield _columns(seeds, np.zeros_like(seeds), doc, key, name - w.offsets[owner])

    return run


def _windows(window: int, seed: int):
    """All windows whose named prefix is among the document's repeated ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                w = _Words(_texts(part, 2), window, seed)
                if not len(w.starts):
                    continue
                shared = np.zeros(len(w.hashes) + 1, dtype=bool)
                for i, places in enumerate(part.column(3).to_pylist()):
                    shared[w.offsets[i] + np.asarray(places, dtype=np.int64)] = True
                pick = shared[w.name]
                if not pick.any():
                    continue
                at, owner = w.starts[pick], w.owner[pick]
                doc, key = (part.column(i).to_numpy(zero_copy_only=False)[owner] for i in (0, 1))
                high = w.seeds[at] >> np.uint64(32)  # order: the short prefix, then all words
                yield _columns(high, ngram_hashes(w.hashes, window)[at], doc, key, w.place[pick])

    return run


def _cut(text: str, starts, window: int) -> tuple[int, int, str]:
    """Number of words, of removed words, and the rest joined by spaces."""
    words = text.encode().split()
    if starts is None:
        return len(words), 0, b" ".join(words).decode()
    if not len(starts):  # a copy of an earlier document
        return (len(words), 0, b" ".join(words).decode()) if len(words) < window else (len(words), len(words), "")
    edge = np.zeros(len(words) + window + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.asarray(starts) + window, -1)
    gone = np.cumsum(edge)[: len(words)] > 0
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode()


def _apply(window: int):
    """(doc_id, text, starts) -> (doc_id, n_words, n_removed, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                ids, texts, starts = (part.column(i).to_pylist() for i in range(3))
                cut = [_cut(t or "", s, window) for t, s in zip(texts, starts, strict=True)]
                columns = [ids, *map(list, zip(*cut, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _places(found: DataFrame, name: str) -> DataFrame:
    """(doc, pos) rows as one list of places per document."""
    place = F.col("pos").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int")
    return found.groupBy(F.col("doc").alias("doc_id"), F.shiftright("pos", _SHIFT).alias("key")).agg(
        F.collect_set(place).alias(name)
    )


def drop_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and the text that is left, for every row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    known = base.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    ddl = "high long, low long, doc long, pos long"

    # Exact copies: all but the smallest (doc_id, key) of a text.
    digests = known.select("doc_id", "key", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    firsts = digests.groupBy("a", "b").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.count("*").alias("n"))
    # Written first, so that a text with very many copies meets a plain table, and
    # the skew join can split it.
    firsts = materialise(firsts.where("n > 1").select("a", "b", "first"), "substring-firsts")
    copies = (
        digests.join(firsts, ["a", "b"])
        .where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("key") != F.col("first.key")))
        .select("doc_id", "key", F.array().cast("array<int>").alias("starts"))
        .distinct()
    )
    copies = materialise(copies, "substring-copies")

    named = repeats(known.mapInArrow(_names(window, seed), ddl), 2, "place", "none", "substring-names")
    hints = _places(named, "shared").join(copies, ["doc_id", "key"], "left_anti")
    # Texts meet their hints on the way to the windows and their places at the end,
    # and are not written in between.
    candidates = known.join(hints, ["doc_id", "key"]).select("doc_id", "key", "text", "shared")
    repeated = repeats(candidates.mapInArrow(_windows(window, seed), ddl), 2, "place", "place", "substring-windows")
    starts = _places(repeated, "starts").unionByName(copies)
    cut = base.join(starts, ["doc_id", "key"], "left").select("doc_id", "text", "starts")
    return cut.mapInArrow(_apply(window), "doc_id long, n_words long, n_removed long, text string")
