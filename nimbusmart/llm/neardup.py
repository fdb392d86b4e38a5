"""Near-duplicate documents by an LSH forest over MinHash signatures.

Documents whose shingle sets are equal form a class; only classes go on. Each of
``TREES`` trees has its own sequence of signature values and sorts the classes by
it: range-partitioned by the sequence, so that a hot prefix spreads over many
partitions. Neighbours in an order share their longest common prefixes. A region
is a run of neighbours that share ``DEPTHS[0]`` values, at which two sets of
similarity 0.8 meet in at least one tree but for 3 cases in 10^8. Depth adapts to
the region: one of more than ``REGION`` classes is cut, while the order streams
by, where neighbours have the least in common, up to ``DEPTHS[-1]`` values deep;
the two neighbours at a cut stay together. A region that a partition's border
parts is cut as well.

There are two rounds, so that no group of copies is turned into all its pairs.
First each region gives a maximum spanning forest over the signatures' agreement;
these candidates are joined with the full sets and confirmed. Then only regions
that still hold several components are looked at again, whole and without the
classes that have no candidate and were in no region cut: the full sets come to the
region, and what comes out are confirmed links between different components, not
pairs. Agreement below ``J - 4.5 sigma`` is the only guess that keeps a pair from
being compared; confirmed links are exact. Components are found by
``components``.

In the second round a large region of which all but a few classes are in one
component already, such as a group of very many near copies, is cut into blocks
with the few in each; any other large region is dealt to a grid of block pairs.
Either way all its remaining pairs are compared in full. The grid is quadratic:
a region of n classes of similar size makes about n^2 / 1024 rows.

Defined cases: a document without words or text has an empty set, links with
nothing and stays. With fewer words than a shingle, the whole sequence is the
shingle. A row without id takes no part and is kept, with no component. Rows
that share an id and have words are linked with each other, whatever their texts;
``drop_near_duplicates`` keeps or drops them together. An empty table gives an
empty result; other columns pass through ``drop_near_duplicates`` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.components import components
from nimbusmart.llm.hashing import batch_word_hashes, minhash, minhash_multipliers, mix, shingle_set
from nimbusmart.llm.tables import materialise

SHINGLE_WORDS, PERCENT = 5, 80
VALUES, TREES = 128, 24
# Signature values that a region has in common: the least, and the most that are looked at.
DEPTHS = (3, 16)
REGION = 2048
BATCH = 256
# The side of classes in a cell of a grid: 0, 1, or all of them with each other.
WHOLE = 2
# Shingles are compared by 40 bits on the full sets.
_KEPT_BYTES = 5


def tree_columns() -> np.ndarray:
    """The signature values each tree looks at, in its order. The first ones
    differ between trees; the deeper ones are drawn anew for each."""
    rng = np.random.default_rng(11)
    first = rng.permutation(VALUES)[: TREES * DEPTHS[0]].reshape(TREES, DEPTHS[0])
    more = [rng.permutation(np.setdiff1d(np.arange(VALUES), row))[: DEPTHS[-1] - DEPTHS[0]] for row in first]
    return np.concatenate([first, np.array(more)], axis=1)


def _sets(texts: list[str], n: int) -> list[np.ndarray]:
    hashes, offsets = batch_word_hashes([t.encode().lower() for t in texts])
    return [shingle_set(hashes[a:b], n) for a, b in zip(offsets, offsets[1:], strict=False)]


def _frame(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _signatures(n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = minhash_multipliers(VALUES)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                sets = _sets([t or "" for t in part.column(2).to_pylist()], n)
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), dtype="<i8").reshape(-1, 2)
                signed = [minhash(s, multipliers).tobytes() if len(s) else None for s in sets]
                yield _frame(schema, part.column(0), part.column(1), [len(s) for s in sets], digests[:, 0].copy(), digests[:, 1].copy(), signed)

    return run, "doc_id long, key long, n_shingles long, high long, low long, signature binary"


def _signature_matrix(column: pa.Array, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), -1)


def _low_bytes():
    """Adds the lowest byte of each signature value: enough to count agreement."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [np.frombuffer(s, dtype=np.uint32).astype(np.uint8).tobytes() for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.binary())], names=["node", "n_shingles", "signature", "bytes"])

    return run, "node long, n_shingles long, signature binary, bytes binary"


def _sequences():
    """(sequence, node) for each tree: the tree and its signature values, by their
    low 16 bits as big-endian bytes, so that the order of bytes is that of values."""
    schema = pa.schema([("sequence", pa.binary()), ("node", pa.int64())])
    columns = tree_columns()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                signature = _signature_matrix(part.column(1)).astype(">u2")
                values = np.empty((part.num_rows, TREES, 1 + columns.shape[1]), dtype=">u2")
                values[:, :, 0] = np.arange(TREES)
                values[:, :, 1:] = signature[:, columns]
                rows = values.reshape(part.num_rows * TREES, -1)
                node = np.repeat(part.column(0).to_numpy(zero_copy_only=False), TREES)
                yield _frame(schema, [r.tobytes() for r in rows], node)

    return run, "sequence binary, node long"


class _Order:
    """Cuts one sorted partition into regions, as it streams by.

    Held are the rows of the open run, at most ``region`` of them and a batch, and
    the row before them if that run has been cut.
    """

    def __init__(self, region: int, depth: int):
        self.region, self.depth = region, depth + 1  # the tree is a value as well
        self.values = self.node = None
        self.lead = 0  # rows held that stand in the block before
        self.cut = True  # the first run may have begun in an earlier partition
        self.out: list[tuple] = []

    def _put(self, lo: int, hi: int, cut: bool) -> None:
        """A block. Its last row is in no other block of the tree at the end."""
        if hi - lo > 1 or cut:
            key = mix(self.node[hi - 1 : hi].astype(np.uint64) ^ mix(self.values[hi - 1 : hi, 0].astype(np.uint64)))
            self.out.append((np.repeat(key, hi - lo), self.node[lo:hi], np.full(hi - lo, cut)))

    def _blocks(self, common: np.ndarray, lo: int, hi: int) -> int:
        """Blocks of the run ``lo:hi`` while it is too large; where the rest begins."""
        half = max(self.region // 2, 1)
        while hi - lo - self.lead > self.region:
            begin = lo + self.lead
            end = begin + half + int(common[begin + half : begin + self.region + 1].argmin())
            self._put(lo, end, True)
            lo, self.lead, self.cut = end - 1, 1, True
        return lo

    def _run(self, common: np.ndarray, lo: int, hi: int) -> None:
        """A run that is whole."""
        lo = self._blocks(common, lo, hi)
        self._put(lo, hi, self.cut)
        self.lead, self.cut = 0, False

    def feed(self, values: np.ndarray, node: np.ndarray) -> None:
        if self.node is not None:
            values, node = np.concatenate([self.values, values]), np.concatenate([self.node, node])
        self.values, self.node = values, node
        same = values[1:] == values[:-1]
        common = np.concatenate([[0], np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))])
        starts = np.flatnonzero(common < self.depth)
        if len(starts) > 1:
            self._run(common, 0, int(starts[1]))
            lengths = np.diff(starts)
            rest = np.arange(len(lengths)) > 0
            fit = rest & (lengths > 1) & (lengths <= self.region)
            if fit.any():
                inside = np.repeat(fit, lengths)
                last = (starts[1:] - 1)[fit]
                key = mix(node[last].astype(np.uint64) ^ mix(values[last, 0].astype(np.uint64)))
                picked = node[: starts[-1]][inside]
                self.out.append((np.repeat(key, lengths[fit]), picked, np.zeros(len(picked), dtype=bool)))
            for i in np.flatnonzero(rest & (lengths > self.region)):
                self._run(common, int(starts[i]), int(starts[i + 1]))
        lo = self._blocks(common, int(starts[-1]), len(node))
        self.values, self.node = values[lo:], node[lo:]

    def close(self) -> None:
        if self.node is not None:
            self._put(0, len(self.node), True)  # it may go on in the next partition


def _regions_of_orders(region: int, depth: int):
    """(key, node, cut) of the regions of sorted rows (sequence, node); ``cut`` where
    a region is not whole."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("cut", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _Order(region, depth)

        def taken() -> Iterator[pa.RecordBatch]:
            if order.out:
                key, node, cut = (np.concatenate(x) for x in zip(*order.out, strict=True))
                order.out.clear()
                yield _frame(schema, key.view(np.int64), node, cut)

        for batch in batches:
            if batch.num_rows:
                order.feed(_signature_matrix(batch.column(0), ">u2"), batch.column(1).to_numpy(zero_copy_only=False))
                yield from taken()
        order.close()
        yield from taken()

    return run, "key long, node long, cut boolean"


def _neighbours(classes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(key, node, label, side): classes in regions of the trees' orders; and (node)
    those whose region is not whole."""
    run, ddl = _sequences()
    rows = classes.select("node", "signature").mapInArrow(run, ddl)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["sequence", "node"]
    run, ddl = _regions_of_orders(REGION, DEPTHS[0])
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = materialise(ranged.mapInArrow(run, ddl), f"{name}-orders")
    regions = found.select("key", "node", F.col("node").alias("label"), F.lit(WHOLE).alias("side"))
    return regions, found.where("cut").select("node").distinct()


def _prefixes(depth: int):
    """(node, key): the prefix of each tree."""
    schema = pa.schema([("node", pa.int64()), ("key", pa.int64())])
    columns = tree_columns()[:, :depth]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                node = part.column(0).to_numpy(zero_copy_only=False)
                signature = _signature_matrix(part.column(1)).astype(np.uint64)
                tree = np.tile(np.arange(TREES, dtype=np.uint64), len(node))
                values = signature[:, columns].reshape(len(tree), depth)
                key = mix(tree + np.uint64(depth << 32))
                for i in range(depth):
                    key = mix(key ^ values[:, i])
                yield _frame(schema, np.repeat(node, TREES), key.view(np.int64))

    return run, "node long, key long"


def _sizes(rows: DataFrame) -> DataFrame:
    """Of keys with several labels: the number of rows, the smallest node, and
    the commonest label with its number of rows."""
    parts = rows.groupBy("key", "label").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    top = F.max(F.struct("n", "label"))
    sizes = parts.groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first"), top.alias("top"), F.count("*").alias("labels"))
    return sizes.where("labels > 1").select("key", "n", "first", F.col("top.label").alias("main"), F.col("top.n").alias("most"))


def _grid(region: DataFrame, percent: int) -> DataFrame:
    """(key, node, label, side): the classes of large regions, dealt to cells
    that together hold every pair which can reach the similarity.

    A class stands in the band of its size; sizes whose ratio can reach the
    similarity are in the same band or in neighbouring ones. A band is cut into
    blocks, and each two blocks of such bands are a cell of their own, with one
    block on side 0 and one on side 1. A block by itself is on side ``WHOLE``.
    """
    # A little wider than the ratio, so that rounding can't part two sizes by two bands.
    width = math.log(100 / percent) + 1e-9
    banded = region.withColumn("band", F.floor(F.log(F.col("n_shingles")) / width))
    counts = banded.groupBy("key", "band").agg(F.ceil(F.count("*") / (REGION // 2)).alias("blocks"))
    blocks = counts.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("blocks"))
    rows = banded.join(blocks, "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "node"), F.col("blocks")[F.col("band")]))

    def cells(step: int, cell):
        there = F.col("blocks")[F.col("band") + step]
        return F.when(there.isNull(), F.array()).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), there - 1), cell))

    band, block = F.col("band"), F.col("block")
    made = lambda lo, i, hi, j, side: F.struct(F.xxhash64("key", lo, i, hi, j).alias("cell"), side.alias("side"))
    side = lambda j: F.when(block < j, 0).when(block > j, 1).otherwise(WHOLE)
    own = cells(0, lambda j: made(band, F.least(block, j), band, F.greatest(block, j), side(j)))
    above = cells(1, lambda j: made(band, block, band + 1, j, F.lit(0)))
    below = cells(-1, lambda j: made(band - 1, j, band, block, F.lit(1)))
    dealt = rows.select("node", "label", F.explode(F.concat(own, above, below)).alias("c"))
    return dealt.select(F.col("c.cell").alias("key"), "node", "label", F.col("c.side").alias("side"))


def _regions(classes: DataFrame, percent: int, name: str) -> DataFrame:
    """(key, node, label, side): classes that share a whole region with a different label.

    A region that is too large is cut into blocks by a hash of the node if all but
    a few of its classes belong to one component: the few are in every block and no
    pair is lost. If not, it is dealt to a grid that loses no pair either.
    """
    half = REGION // 2
    run, ddl = _prefixes(DEPTHS[0])
    labels = classes.select("node", "label", "n_shingles")
    rows = classes.select("node", "signature").mapInArrow(run, ddl).join(labels, "node")
    rows = materialise(rows, f"{name}-rows")
    sizes = materialise(_sizes(rows), f"{name}-sizes")
    fit = rows.join(sizes.where(F.col("n") <= REGION), "key").select("key", "node", "label", F.lit(WHOLE).alias("side"))
    large = sizes.where(F.col("n") > REGION)
    if large.isEmpty():
        return fit
    few = F.col("n") - F.col("most") <= half
    grid = _grid(rows.join(large.where(~few).select("key"), "key"), percent)
    blocks = F.ceil(F.col("n") / half)
    everywhere = (F.col("label") != F.col("main")) | (F.col("node") == F.col("first"))
    one = F.array(F.pmod(F.xxhash64("key", "node"), blocks))
    block = F.explode(F.when(everywhere, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(one))
    cut = rows.join(large.where(few), "key").select("key", "node", "label", block.alias("block"))
    cut = cut.select(F.xxhash64("key", "block").alias("key"), "node", "label", F.lit(WHOLE).alias("side"))
    return fit.unionByName(grid).unionByName(cut)


def _forest(agree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum spanning forest (Prim) of a matrix in which -1 means no pair."""
    n = len(agree)
    out = np.zeros(n, dtype=bool)
    best, parent = np.full(n, -1, dtype=agree.dtype), np.zeros(n, dtype=np.int64)
    a, b = [], []
    v = 0
    for _ in range(n):
        out[v] = True
        better = agree[v] > best
        best[better], parent[better] = agree[v][better], v
        rest = np.where(out, -2, best)
        v = int(rest.argmax())
        if rest[v] >= 0:
            a.append(parent[v])
            b.append(v)
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def _agreement(x: tuple, y: tuple, percent: int) -> np.ndarray:
    """Signature values in which the classes ``x`` agree with the classes ``y``,
    each given as (values, sizes, labels); -1 for pairs that can't reach the
    similarity, or are in one component already."""
    agree = np.zeros((len(x[1]), len(y[1])), dtype=np.uint8)
    for c, d in zip(x[0].T, y[0].T, strict=True):
        agree += c[:, None] == d[None, :]
    agree = agree.astype(np.int16)
    small, large = np.minimum(x[1][:, None], y[1][None, :]), np.maximum(x[1][:, None], y[1][None, :])
    agree[(agree < _least(percent)) | (100 * small < percent * large) | (x[2][:, None] == y[2][None, :])] = -1
    return agree


def _least(percent: int) -> int:
    """The similarity less 4.5 standard deviations, in signature values."""
    j = percent / 100
    return math.floor(VALUES * (j - 4.5 * math.sqrt(j * (1 - j) / VALUES)))


def _confirmed(x: np.ndarray, y: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the pairs (x[i], y[i]) of a region reach the similarity on their
    full sets. Only shingles that two sets share can count, so the sets become
    rows of bits over those."""
    shingles, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(shingles, return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    width = int(shared.sum())
    bits = np.zeros((len(sets), -(-width // 64)), dtype=np.uint64)
    at = place[column[keep]]
    np.bitwise_or.at(bits, (owner[keep], at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    common = np.zeros(len(x), dtype=np.int64)
    step = max(1, (1 << 21) // max(bits.shape[1], 1))
    for lo in range(0, len(x), step):
        both = bits[x[lo : lo + step]] & bits[y[lo : lo + step]]
        common[lo : lo + step] = np.bitwise_count(both).sum(axis=1)
    sizes = np.array([len(s) for s in sets])
    return 100 * common >= percent * (sizes[x] + sizes[y] - common)


def _links_of_regions(forest: bool, percent: int):
    """Pairs of each region, by streaming sorted rows (key, node, label, n, side,
    bytes, set). With ``forest``, a spanning forest of candidates; else all links
    between different labels, confirmed on the sets that came along."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(node, label, size, side, values, sets) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        agree = _agreement((values[left], size[left], label[left]), (values[right], size[right], label[right]), percent)
        if forest:
            np.fill_diagonal(agree, -1)
            x, y = _forest(agree)
        else:
            x, y = np.nonzero(agree >= 0)
            x, y = left[x], right[y]
            once = (side[x] != WHOLE) | (x < y)
            x, y = x[once], y[once]
            if len(x):
                # Only the sets that some pair asks for.
                asked, back = np.unique(np.concatenate([x, y]), return_inverse=True)
                linked = _confirmed(back[: len(x)], back[len(x) :], [_unpack(sets[i]) for i in asked], percent)
                x, y = x[linked], y[linked]
        return np.minimum(node[x], node[y]), np.maximum(node[x], node[y])

    def regions(rows) -> Iterator[pa.RecordBatch]:
        key, node, label, size, side, values, sets = rows
        bounds = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        starts, lengths = bounds[:-1], np.diff(bounds)
        found = []
        two = starts[lengths == 2]  # most regions: all at once
        if len(two):
            agree = (values[two] == values[two + 1]).sum(axis=1)
            small, large = np.minimum(size[two], size[two + 1]), np.maximum(size[two], size[two + 1])
            two = two[(agree >= _least(percent)) & (100 * small >= percent * large) & (label[two] != label[two + 1])]
            if forest:
                found.append((np.minimum(node[two], node[two + 1]), np.maximum(node[two], node[two + 1])))
            else:
                lengths[np.isin(starts, two)] = 3  # looked at one by one below
        for s, n in zip(starts[lengths > 2], np.diff(bounds)[lengths > 2], strict=True):
            e = s + n
            found.append(pairs(node[s:e], label[s:e], size[s:e], side[s:e], values[s:e], sets[s:e]))
        if found:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(a):
                once = np.unique(np.stack([a, b]), axis=1)
                yield _frame(schema, once[0].astype(np.int64), once[1].astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            rows += [_signature_matrix(batch.column(5), np.uint8), np.array(batch.column(6).to_pylist(), dtype=object)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            start = int(np.searchsorted(rows[0], rows[0][-1]))
            if start:
                yield from regions([x[:start] for x in rows])
            held = [x[start:] for x in rows]
        if held is not None:
            yield from regions(held)

    return run, "a long, b long"


def _pairs(regions: DataFrame, classes: DataFrame, sets: DataFrame | None, percent: int) -> DataFrame:
    """Candidate forests of the regions; with ``sets``, all confirmed links
    between the different labels that regions hold."""
    rows = regions.join(classes.select("node", "n_shingles", "bytes"), "node")
    if sets is None:
        rows = rows.withColumn("shingles", F.lit(None).cast("binary"))
    else:
        rows = rows.join(sets, "node")
    rows = rows.select("key", "node", "label", "n_shingles", "side", "bytes", "shingles")
    run, ddl = _links_of_regions(sets is None, percent)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, ddl).distinct()


def _pack(s: np.ndarray) -> bytes:
    """Sorted shingles by their high bytes, so that order stays."""
    return s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :_KEPT_BYTES].tobytes()


def _packed_sets(n: int):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                sets = _sets(part.column(1).to_pylist(), n)
                yield _frame(schema, part.column(0).to_pylist(), [_pack(s) for s in sets])

    return run, "node long, shingles binary"


def _unpack(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // _KEPT_BYTES, 8), dtype=np.uint8)
    out[:, :_KEPT_BYTES] = np.frombuffer(b, dtype=np.uint8).reshape(-1, _KEPT_BYTES)
    return out.view(">u8").ravel().astype(np.uint64)


def _confirm(percent: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            u, v = [], []
            for i, j, x, y in zip(a, b, batch.column(2), batch.column(3), strict=True):
                p, q = np.unique(_unpack(x.as_py())), np.unique(_unpack(y.as_py()))
                common = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * common >= percent * (len(p) + len(q) - common):
                    u.append(i)
                    v.append(j)
            yield _frame(schema, u, v)

    return run, "u long, v long"


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    run, ddl = _confirm(percent)
    # Both sides grow with the corpus: a shuffle at every size, never a broadcast.
    left = pairs.join(sets.toDF("a", "x").hint("merge"), "a")
    both = left.join(sets.toDF("b", "y").hint("merge"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, ddl)


def _same_id(usable: DataFrame, classes: DataFrame) -> tuple[DataFrame | None, bool]:
    """Links (u, v) between the classes of rows that share an id, each to the
    smallest of them; and whether any id is repeated at all."""
    digest = F.struct("high", "low")
    ids = usable.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(digest).alias("least"), F.max(digest).alias("most"))
    ids = materialise(ids.where("n > 1").select("doc_id", (F.col("least") != F.col("most")).alias("differ")), "repeated-ids")
    differ = ids.where("differ").select("doc_id")
    if differ.isEmpty():
        return None, not ids.isEmpty()
    nodes = usable.join(differ, "doc_id").join(classes.select("high", "low", "node"), ["high", "low"])
    nodes = materialise(nodes.select("doc_id", "node").distinct(), "repeated-id-nodes")
    least = materialise(nodes.groupBy("doc_id").agg(F.min("node").alias("v")), "repeated-id-least")
    return nodes.join(least, "doc_id").where("node <> v").select(F.col("node").alias("u"), "v"), True


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    text = F.col("text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text)
    run, ddl = _signatures(shingle_words)
    signed = materialise(base.mapInArrow(run, ddl), "signatures")

    usable = signed.where("doc_id is not null and n_shingles > 0")
    # A class is a node of its own, named by its row in the table written here. The
    # smallest (doc_id, key) leads to a text of it.
    classes = usable.groupBy("high", "low").agg(
        F.min(F.struct("doc_id", "key")).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    classes = classes.select("high", "low", "first.doc_id", "first.key", "n_shingles", "signature", F.monotonically_increasing_id().alias("node"))
    classes = materialise(classes, "classes")
    same_id, repeated = _same_id(usable, classes)
    run, ddl = _low_bytes()
    nodes = classes.select("node", "n_shingles", "signature").mapInArrow(run, ddl)
    nodes = materialise(nodes.withColumn("label", F.col("node")), "class-nodes")

    regions, parted = _neighbours(nodes, "forest")
    first = materialise(_pairs(regions, nodes, None, percent), "forest-pairs")
    # In a whole region a class without a candidate has been compared with all
    # others; in a cut one it has not.
    involved = first.select(F.col("a").alias("node")).union(first.select("b")).union(parted)
    involved = materialise(involved.distinct(), "involved")
    run, ddl = _packed_sets(shingle_words)
    leads = involved.join(classes.select("node", "doc_id", "key"), "node")
    texts = base.where("text is not null").join(leads.hint("merge"), ["doc_id", "key"]).select("node", "text")
    if repeated:  # the row that leads to a class may be there several times
        texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    sets = materialise(texts.mapInArrow(run, ddl), "shingle-sets")
    links = _links(first, sets, percent)
    links = materialise(links if same_id is None else links.unionAll(same_id), "forest-links")
    roots = components(links, "forest-components")

    labelled = nodes.drop("label").join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    labelled = materialise(labelled.join(involved, "node", "left_semi"), "labelled-classes")
    more = _pairs(_regions(labelled, percent, "rest"), labelled, sets, percent)
    more = materialise(more.toDF("u", "v"), "rest-links")
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(more), "components")

    member = classes.select("high", "low", "node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    member = materialise(member.select("high", "low", "root", "doc_id"), "class-roots")
    least = materialise(member.groupBy("root").agg(F.min("doc_id").alias("least")), "component-ids")
    member = materialise(member.join(least, "root").select("high", "low", "least"), "class-components")
    out = signed.select("doc_id", "n_shingles", "high", "low").join(member, ["high", "low"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id."""
    gone = near_duplicates(docs, shingle_words, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
