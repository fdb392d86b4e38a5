"""Ranked lexical search with Block-Max MaxScore over an inverted index.

``build_index`` inverts the documents in shards of about ``SHARD_WORDS`` terms, each
inside the task that reads it, without a shuffle: a row of the index is one
term's list in one shard, cut into blocks of ``BLOCK`` postings. A block is kept
compressed (gaps and counts in 1, 2 or 4 bytes); beside it stand its last
document and, for one, two, three and more occurrences, the shortest document,
from which the largest score of the block follows once the corpus statistics
are known. Every document and every term is in the index.

``search`` reads the lists of the queries' terms, sums up document frequencies,
and streams shard by shard. In a shard a query's lists are ordered by their
bound. Documents are met in the essential lists only, those without which the
k-th best score so far can't be reached; a document's bound is its part from
there plus the maxima of its blocks in all other lists, and only where that can
still reach the k-th score are those blocks decompressed. A task keeps one heap
of k for each query over all shards it reads; the heaps are merged by a window
that is cut to k before its shuffle.

Score of a term: w * ((10^9 tf) div (1000 tf + 8 m)), w = floor(1000 ln((2N + 2) /
(2 df + 1))), m = 10 + (90 n N) div L; N documents with a term, L their terms, n
the document's. All but w is integer, so bounds are exact and ties are kept.

Queries go in blocks of at most ``QUERY_TERMS`` terms or ``QUERY_BYTES`` bytes,
each one pass over their lists: that bounds what is broadcast.

Defined cases: null and empty texts have no terms, don't count in N, and are never
found; queries without terms find nothing; each query row is ranked on its own,
also where item ids are repeated or null; documents of one id are documents of
their own; a document without id is ranked behind the others of its score, with
a null id. Other columns take no part.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbusmart.llm.tables import materialise
from nimbusmart.llm.terms import term_slices, terms

K = 10
SHARD_WORDS = 4_000_000
BLOCK = 128
CHUNK = 256
QUERY_TERMS, QUERY_BYTES = 50_000, 8 << 20
_LEVELS = 4
_NO_ID = (1 << 63) - 1
_FAR = np.iinfo(np.int32).max

INDEX_DDL = "shard long, term string, df int, words long, blocks binary, postings binary"
_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int32()), ("words", pa.int64()), ("blocks", pa.binary()), ("postings", pa.binary())])
# A block: last document, offset of its bytes, shortest document with 1, 2 and 3
# occurrences, most occurrences and shortest document with more.
_COLUMNS = 7


def _width(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 256, 1, np.where(largest < 65536, 2, 4))


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    for b in range(4):
        wide = width > b
        out[at[wide] + b] = (values[wide] >> (8 * b)) & 255


class _Encoded:
    """All lists of a shard, from (term, document) codes sorted and counted."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, lengths: np.ndarray):
        new_term = np.concatenate([[True], term[1:] != term[:-1]])
        self.first = np.flatnonzero(new_term)  # first posting of each list
        self.df = np.diff(np.append(self.first, len(term)))
        self.words = np.add.reduceat(tf, self.first)
        in_list = np.arange(len(term)) - np.repeat(self.first, self.df)
        starts = np.flatnonzero(in_list % BLOCK == 0)
        size = np.diff(np.append(starts, len(term)))
        gap = doc.copy()
        gap[1:] = np.where(new_term[1:], doc[1:], doc[1:] - doc[:-1])
        wide = _width(np.maximum.reduceat(gap, starts)), _width(np.maximum.reduceat(tf, starts))
        used = 1 + size * (wide[0] + wide[1])
        end = np.cumsum(used)
        begin = end - used
        self.bytes = np.zeros(int(end[-1]), dtype=np.uint8)
        self.bytes[begin] = wide[0] | (wide[1] << 4)
        block = np.repeat(np.arange(len(starts)), size)
        place = np.arange(len(term)) - starts[block]
        at = begin[block] + 1
        _put(self.bytes, at + place * wide[0][block], gap, wide[0][block])
        _put(self.bytes, at + size[block] * wide[0][block] + place * wide[1][block], tf, wide[1][block])
        self.block_first = np.searchsorted(starts, self.first)  # first block of each list
        self.n_blocks = np.diff(np.append(self.block_first, len(starts)))
        self.begin, self.end = begin, end
        table = np.zeros((len(starts), _COLUMNS), dtype=np.int32)
        table[:, 0] = doc[starts + size - 1]
        table[:, 1] = begin - np.repeat(begin[self.block_first], self.n_blocks)
        n = lengths[doc]
        for level in range(1, _LEVELS):
            table[:, 1 + level] = np.minimum.reduceat(np.where(tf == level, n, _FAR), starts)
        more = tf >= _LEVELS
        table[:, 5] = np.maximum.reduceat(np.where(more, tf, 0), starts)
        table[:, 6] = np.minimum.reduceat(np.where(more, n, _FAR), starts)
        self.table = table

    def rows(self, shard: int, names: np.ndarray, step: int = 20_000) -> Iterator[pa.RecordBatch]:
        last = self.block_first + self.n_blocks - 1
        low, high = self.begin[self.block_first], self.end[last]
        for lo in range(0, len(names), step):
            hi = min(lo + step, len(names))
            offsets = np.append(low[lo:hi], high[hi - 1]) - low[lo]
            data = self.bytes[low[lo] : high[hi - 1]].tobytes()
            postings = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
            blocks = [self.table[b : b + k].tobytes() if k > 1 else None for b, k in zip(self.block_first[lo:hi].tolist(), self.n_blocks[lo:hi].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(hi - lo, shard)), pa.array(names[lo:hi], pa.binary()).cast(pa.string()), pa.array(self.df[lo:hi].astype(np.int32)), pa.array(self.words[lo:hi]), pa.array(blocks, pa.binary()), postings],
                schema=_INDEX,
            )


class _Shard:
    """Documents of a shard that is being built."""

    def __init__(self, number: int):
        self.number = number
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.codes: list[np.ndarray] = []
        self.words = 0
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__

    def add(self, doc_id: int | None, text: str | None) -> None:
        n, parts = 0, []
        for words in term_slices(text):
            parts.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words)))
            n += len(words)
        if n:
            self.codes += [(part << 32) | len(self.ids) for part in parts]
            self.ids.append(_NO_ID if doc_id is None else doc_id)
            self.lengths.append(n)
            self.words += n

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        lengths = np.array(self.lengths, dtype=np.int32)
        # The shard's documents: the row without a term.
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.number]), pa.array([""]), pa.array([len(self.ids)], pa.int32()), pa.array([self.words]), pa.array([lengths.tobytes()], pa.binary()), pa.array([np.array(self.ids, dtype=np.int64).tobytes()], pa.binary())],
            schema=_INDEX,
        )
        code, tf = np.unique(np.concatenate(self.codes), return_counts=True)
        self.codes = []
        encoded = _Encoded(code >> 32, code & 0xFFFFFFFF, tf, lengths)
        names = np.array(list(self.numbers), dtype=object)
        yield from encoded.rows(self.number, names)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32  # the same in every attempt of the task
        shard = _Shard(first)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard.add(doc_id, text.as_py())
                if shard.words >= SHARD_WORDS:
                    yield from shard.rows()
                    shard = _Shard(shard.number + 1)
        yield from shard.rows()

    return materialise(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX_DDL), "index")


class _List:
    """One term's list in a shard."""

    def __init__(self, df: int, blocks: bytes | None, postings: bytes, m: np.ndarray, m_of):
        self.df, self.postings, self.m = df, np.frombuffer(postings, dtype=np.uint8), m
        self.decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if blocks is None:
            self.table = None
            self.last, self.best = None, None
            self.all = self._decode(0, df, 0)
            self.bound = int(self.all[1].max())
        else:
            self.table = t = np.frombuffer(blocks, dtype=np.int32).reshape(-1, _COLUMNS).astype(np.int64)
            self.all = None
            self.last = t[:, 0]
            self.best = np.zeros(len(t), dtype=np.int64)
            for level in range(1, _LEVELS + 1):
                tf, n = (np.full(len(t), level), t[:, 1 + level]) if level < _LEVELS else (t[:, 5], t[:, 6])
                held = n < _FAR
                self.best[held] = np.maximum(self.best[held], _part(tf[held], m_of(n[held])))
            self.bound = int(self.best.max())

    def _decode(self, at: int, n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, parts of the score) of the block at byte ``at``."""
        head = int(self.postings[at])
        a, b = head & 15, head >> 4
        at += 1
        kind = {1: np.uint8, 2: "<u2", 4: "<u4"}
        docs = np.cumsum(self.postings[at : at + n * a].view(kind[a]), dtype=np.int64) + base
        tf = self.postings[at + n * a : at + n * (a + b)].view(kind[b]).astype(np.int64)
        return docs, _part(tf, self.m[docs])

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.decoded:
            n = BLOCK if i + 1 < len(self.last) else self.df - BLOCK * i
            self.decoded[i] = self._decode(int(self.table[i, 1]), n, int(self.last[i - 1]) if i else 0)
        return self.decoded[i]

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self.all is None:
            parts = [self.block(i) for i in range(len(self.last))]
            self.all = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            self.decoded = {}
        return self.all

    def bounds(self, docs: np.ndarray) -> np.ndarray:
        """At most what this list adds to ``docs``; nothing is decompressed."""
        if self.all is not None:
            return self.parts(docs)
        block = np.searchsorted(self.last, docs)
        inside = block < len(self.last)
        return np.where(inside, self.best[np.minimum(block, len(self.last) - 1)], 0)

    def parts(self, docs: np.ndarray) -> np.ndarray:
        """What this list adds to ``docs``; decompresses the blocks they are in."""
        if self.all is not None:
            return _found(docs, *self.all)
        out = np.zeros(len(docs), dtype=np.int64)
        block = np.searchsorted(self.last, docs)
        for i in np.unique(block[block < len(self.last)]).tolist():
            at = block == i
            out[at] = _found(docs[at], *self.block(i))
        return out


def _part(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _found(docs: np.ndarray, held: np.ndarray, parts: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
    return np.where(held[at] == docs, parts[at], 0)


class _Top:
    """The k best (score, document id) of a query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    @property
    def least(self) -> int:
        """The score that a document must reach to matter (1: any above 0)."""
        return max(int(self.score[-1]), 1) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least
        if good.any():
            s, d = np.concatenate([self.score, score[good]]), np.concatenate([self.id, ids[good]])
            order = np.lexsort((d, -s))[: self.k]
            self.score, self.id = s[order], d[order]


def _search_shard(query: list[tuple[int, _List]], ids: np.ndarray, top: _Top) -> None:
    """Block-Max MaxScore of one query, (weight, list) each, in one shard."""
    query = sorted(query, key=lambda x: x[0] * x[1].bound, reverse=True)
    rest = np.cumsum([w * x.bound for w, x in reversed(query)])[::-1].tolist() + [0]
    seen = np.zeros(len(ids), dtype=bool)
    i = 0
    while i < len(query) and rest[i] >= top.least:  # the lists from i on are essential still
        # Essential lists are met together until they hold enough documents; before
        # there is a k-th score, only as many as may give one.
        j, held, enough = i, 0, CHUNK if len(top.score) == top.k else top.k
        while j < len(query) and held < enough and (j == i or rest[j] >= top.least):
            held += query[j][1].df
            j += 1
        whole = [query[x][1].whole() for x in range(i, j)]
        docs = np.unique(np.concatenate([d for d, _ in whole]))
        docs = docs[~seen[docs]]
        seen[docs] = True
        score = np.zeros(len(docs), dtype=np.int64)
        for (w, _), (d, parts) in zip(query[i:j], whole, strict=True):
            score += w * _found(docs, d, parts)
        # Lists behind j can add this much; the first sum is cheaper than the blocks'.
        near = score + rest[j] >= top.least
        docs, score = docs[near], score[near]
        bounds = np.array([w * x.bounds(docs) for w, x in query[j:]], dtype=np.int64).reshape(len(query) - j, len(docs))
        reach = score + bounds.sum(axis=0)
        order = np.argsort(-reach, kind="stable")
        for lo in range(0, len(order), CHUNK):
            at = order[lo : lo + CHUNK]
            at = at[reach[at] >= top.least]
            if not len(at):
                break
            sums, open_ = score[at], reach[at]
            for x in range(j, len(query)):
                w, postings = query[x]
                parts = w * postings.parts(docs[at])
                sums = sums + parts
                open_ = open_ - bounds[x - j, at] + parts
                good = open_ >= top.least
                at, sums, open_ = at[good], sums[good], open_[good]
                if not len(at):
                    break
            if len(at):
                top.add(sums, ids[docs[at]])
        i = j


def _run_search(queries, n_docs: int, n_words: int, k: int):
    """Streams the lists of shards, sorted by shard and term ('' first)."""
    schema = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def m_of(n):
        return 10 + (90 * np.asarray(n, dtype=np.int64) * n_docs) // n_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = queries.value
        tops: dict[int, _Top] = {}

        def finish(lists: dict[str, _List], ids: np.ndarray) -> None:
            for number, words in asked:
                query = [(weights[t], lists[t]) for t in words if t in lists and weights[t] > 0]
                if query:
                    _search_shard(query, ids, tops.setdefault(number, _Top(k)))

        shard, lists, ids, m = None, {}, None, None
        for batch in batches:
            for number, term, df, blocks, postings in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != shard:
                    if lists:
                        finish(lists, ids)
                    shard, lists = number, {}
                if term == "":
                    ids, m = np.frombuffer(postings, dtype=np.int64), m_of(np.frombuffer(blocks, dtype=np.int32))
                else:
                    lists[term] = _List(df, blocks, postings, m, m_of)
        if lists:
            finish(lists, ids)
        for number, top in tops.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top.id), number)), pa.array(top.id), pa.array(top.score)], schema=schema)

    return run, "query long, doc_id long, score long"


def _query_blocks(queries: DataFrame) -> Iterator[list[tuple[int, object, list[str]]]]:
    """(number, item id, distinct terms) of the queries, in bounded blocks."""
    block, n, size = [], 0, 0
    for number, (item, text) in enumerate(queries.select("item_id", "text").toLocalIterator()):
        words = [t.decode() for t in sorted(set(terms(text)))]
        if not words:
            continue
        if block and (n + len(words) > QUERY_TERMS or size + sum(map(len, words)) > QUERY_BYTES):
            yield block
            block, n, size = [], 0, 0
        block.append((number, item, words))
        n, size = n + len(words), size + sum(map(len, words))
    if block:
        yield block


def search(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each row of
    ``queries`` (item_id, text) over an index that ``build_index`` has written."""
    spark = index.sparkSession
    item_type = queries.schema["item_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    totals = index.where("term = ''").agg(F.sum("df"), F.sum("words")).first()
    n_docs, n_words = totals[0] or 0, totals[1] or 0
    out = None
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for block in _query_blocks(queries) if n_docs else ():
        names = sorted({t for _, _, words in block for t in words})
        asked = spark.createDataFrame([(t,) for t in ["", *names]], "term string")
        lists = index.join(F.broadcast(asked), "term")  # at most QUERY_TERMS + one query's terms
        df = {r["term"]: r["df"] for r in lists.where("term <> ''").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator()}
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        sent = spark.sparkContext.broadcast(([(number, words) for number, _, words in block], weights))
        run, ddl = _run_search(sent, n_docs, n_words, k)
        columns = ["shard", "term", "df", "blocks", "postings"]
        dealt = lists.select(*columns).repartitionByRange(n_parts, "shard").sortWithinPartitions("shard", "term")
        best = dealt.mapInArrow(run, ddl)
        order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        items = spark.createDataFrame([(number, item) for number, item, _ in block], f"query long, item_id {item_type}")
        doc_id = F.when(F.col("doc_id") != _NO_ID, F.col("doc_id"))
        found = best.join(F.broadcast(items), "query").select("item_id", F.col("rank").cast("int").alias("rank"), doc_id.alias("doc_id"), "score")
        out = found if out is None else out.unionAll(found)
    return empty if out is None else out
