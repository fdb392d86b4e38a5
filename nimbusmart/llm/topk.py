"""Exact top-k by inner product with a pivot table.

Vectors become integers, floor(1024 x). For integer vectors the inner product is
``(|q|^2 + |x|^2 - |q - x|^2) / 2``, so a lower bound of the distance is an
upper bound of the score. The pivot table holds the distances of every vector to
``PIVOTS`` pivots; by the triangle inequality the largest difference
``|d(q, p) - d(x, p)|`` over the pivots is such a lower bound. A query looks at
its candidates in order of the bound and stops as soon as the next bound is
below its k-th best score: everything after it is out, exactly.

Candidates are cut into blocks of about ``BLOCK`` rows by a hash of their id and
queries into blocks of about ``QUERY_BLOCK``; one task sees one cell of that
grid, so neither side is ever gathered whole and equal vectors spread evenly. Of
each cell only the k best per query come out; they are merged by a window.
Pivots are picked from a sample of at most ``PIVOT_SAMPLE`` vectors, one far
from the others after another; any choice gives the same result.

Defined cases: vectors that are null, or hold a null or a component that isn't
finite, and rows without id take no part. Short vectors count as filled up with
zeros. Components are exact up to 2^24 in size; scores are 64-bit. Rows that
repeat an id are separate candidates, but never of a query with that id; a
repeated query id is asked once, with its smallest vector. Fewer candidates than
k give fewer rows; an empty table gives an empty result. Other columns of the
input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbusmart.llm.tables import materialise

K, SCALE = 10, 1024
PIVOTS, PIVOT_SAMPLE = 32, 1024
BLOCK, QUERY_BLOCK = 8192, 512
FIRST_STEP = 64


def integer_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the usable rows with integer components."""
    x = F.col(vector)
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    usable = F.col(key).isNotNull() & x.isNotNull() & F.forall(x, finite)
    v = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE))
    return rows.where(usable).select(F.col(key).cast("long").alias("id"), v.alias("v"))


def pick_pivots(vectors: DataFrame, n: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """Up to ``n`` vectors of a sample of at most ``sample`` rows, far apart."""
    drawn = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(sample).select("v").collect()
    width = max([len(r.v) for r in drawn], default=0)
    rows = _matrix([r.v for r in drawn], width).astype(np.float64)
    if not len(rows):
        return np.zeros((0, 0))
    chosen, gap = [0], ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(rows)) and gap.max() > 0:
        i = int(gap.argmax())
        chosen.append(i)
        gap = np.minimum(gap, ((rows - rows[i]) ** 2).sum(axis=1))
    return rows[chosen]


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(m.shape[1], pivots.shape[1])
    x, p = _wide(m, width).astype(np.float64), _wide(pivots, width)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T, 0))


def _cell(q_id, q, q_dist, c_id, c, c_dist, k: int) -> tuple[list, list, list]:
    """The k best candidates of every query of one cell, exactly."""
    width = max(q.shape[1], c.shape[1])
    q, c = _wide(q, width), _wide(c, width)
    exact = (np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(width, 1)) < 2.0**53
    q_float, c_float = q.astype(np.float64), c.astype(np.float64)
    q_norm, c_norm = (q_float**2).sum(axis=1), (c_float**2).sum(axis=1)
    ids, others, scores = [], [], []
    for i in range(len(q)):
        # Slack for rounding: distances are good to about 1e-7 of their size.
        apart = np.abs(c_dist - q_dist[i]).max(axis=1, initial=0)
        slack = 1e-6 * (q_norm[i] + c_norm) + 1
        bound = (q_norm[i] + c_norm - np.maximum(apart - np.sqrt(slack) * 1e-3, 0) ** 2) / 2 + slack
        own = np.flatnonzero(c_id != q_id[i])
        order = own[np.argsort(-bound[own], kind="stable")]
        best_score, best_id = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at, step = 0, FIRST_STEP
        while at < len(order) and (len(best_score) < k or bound[order[at]] >= best_score[-1]):
            part = order[at : at + step]
            score = (c_float[part] @ q_float[i]).astype(np.int64) if exact else c[part] @ q[i]
            best_score, best_id = np.concatenate([best_score, score]), np.concatenate([best_id, c_id[part]])
            top = np.lexsort((best_id, -best_score))[:k]
            best_score, best_id = best_score[top], best_id[top]
            at, step = at + step, 2 * step
        ids += [q_id[i]] * len(best_id)
        others += best_id.tolist()
        scores += best_score.tolist()
    return ids, others, scores


def _block(key: Column, blocks: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(blocks)).cast("int")


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score from (id, v) queries and candidates, the latter
    a written table (see ``vector_table``): its row numbers stay in a retry."""
    pivots = pick_pivots(candidates)
    n_blocks = max(1, -(-candidates.count() // BLOCK))
    queries = queries.groupBy("id").agg(F.min("v").alias("v"))
    q_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def table_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the pivot distances."""
        for b in batches:
            v = b.column(1).to_pylist()
            d = _distances(_matrix(v, max(map(len, v), default=0)), pivots) if len(pivots) else np.zeros((len(v), 0))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d.tolist(), pa.list_(pa.float64()))], names=["id", "v", "d"])

    def pivoted(rows: DataFrame) -> DataFrame:
        return rows.select("id", "v").mapInArrow(table_of, "id long, v array<long>, d array<double>")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Blocks by the row's number in its table, so that rows of one id spread as well.
    c = pivoted(candidates).withColumn("c_block", _block(F.monotonically_increasing_id(), n_blocks, 1)).withColumn("q_block", every(q_blocks))
    q = pivoted(queries).withColumn("q_block", _block(F.col("id"), q_blocks, 2)).withColumn("c_block", every(n_blocks))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = []
        for t in (left, right):
            v = t["v"].to_pylist()
            d = np.array(t["d"].to_pylist(), dtype=np.float64).reshape(len(v), -1)
            sides.append((t["id"].to_numpy(), _matrix(v, max(map(len, v), default=0)), d))
        (q_id, qv, qd), (c_id, cv, cd) = sides
        found = _cell(q_id, qv, qd, c_id, cv, cd, k) if len(q_id) and len(c_id) else ([], [], [])
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])

    cells = q.groupBy("q_block", "c_block").cogroup(c.groupBy("q_block", "c_block"))
    best = cells.applyInArrow(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def vector_table(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The integer vectors, written once: several passes read them."""
    return materialise(integer_vectors(rows, key, vector), "vectors")
