"""Packing: length buckets that are optimal for the corpus, and batches in them.

A document's length is its number of words. The histogram of all lengths is
pre-aggregated by Spark, and is the only thing that reaches the driver: a row for
each length that occurs, of which a corpus of w words has fewer than sqrt(2 w).
Dynamic programming over it picks the at most ``BUCKETS`` upper bounds that
minimise the padded total of the lengths so rounded up. A later length never cuts
further left than an earlier one, so a step divides the lengths and conquers both
halves, n log n in place of n^2.

Batches hold as many documents of one bucket as fit the token budget at the
padded length, at least one. A document's place in its bucket is by (shard,
doc_id), where a shard is a hash of the id, or of the row where more than ``SHARD``
rows share an id or have none, that keeps about ``SHARD`` documents: places within a shard are counted per shard, the shards' sizes are summed up in
two levels, so no bucket is ever sorted in one task. All batches of a bucket but its last
are full.

Defined cases: a null or empty text has length 0 and is packed like any other; a
row without id counts as id -1 for its order in a shard. Texts longer than the budget have
a batch each. Rows that repeat an id keep their own places, in any order. An
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbusmart.llm.tables import materialise, words

BUCKETS, TOKEN_BUDGET = 16, 65_536
SHARD, LEVEL = 1024, 1024


def _one_more_bucket(cost: np.ndarray, values: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cost, cut) with a bucket more: the least of cost[i] + values[j - 1] * (below[j]
    - below[i]) over i < j, and its smallest i. All segments of a depth at once."""
    n = len(values)
    best, cut = np.zeros(n + 1), np.zeros(n + 1, dtype=np.int64)
    low, high, first, last = (np.array([x]) for x in (1, n, 0, n - 1))
    while len(low):
        mid = (low + high) // 2
        size = np.minimum(last, mid - 1) - first + 1
        start = np.cumsum(size) - size
        of = np.repeat(np.arange(len(mid)), size)
        i = np.arange(len(of)) - start[of] + first[of]
        j = mid[of]
        option = cost[i] + values[j - 1] * (below[j] - below[i]).astype(np.float64)
        best[mid] = np.minimum.reduceat(option, start)
        cut[mid] = np.minimum.reduceat(np.where(option == best[j], i, n), start)
        low, high = np.concatenate([low, mid + 1]), np.concatenate([mid - 1, high])
        first, last = np.concatenate([first, cut[mid]]), np.concatenate([cut[mid], last])
        left = low <= high
        low, high, first, last = low[left], high[left], first[left], last[left]
    return best, cut


def optimal_bounds(values: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds, at most ``buckets``, with the least padded total; of equally
    good ones the fewest. ``values`` ascend."""
    n = len(values)
    if not n:
        return []
    below = np.concatenate([[0], np.cumsum(counts)])
    # cost[j]: of the first j values in the buckets so far, the last bound being values[j - 1].
    cost = np.concatenate([[0.0], values * below[1:].astype(np.float64)])
    steps, totals = [np.zeros(n + 1, dtype=np.int64)], [cost[n]]
    for _ in range(1, min(buckets, n)):
        cost, cut = _one_more_bucket(cost, values, below)
        steps.append(cut)
        totals.append(cost[n])
    level, j, bounds = int(np.argmin(totals)), n, []
    while j > 0:
        bounds.append(int(values[j - 1]))
        j, level = (int(steps[level][j]), level - 1) if level else (0, 0)
    return bounds[::-1]


def lengths(docs: DataFrame) -> DataFrame:
    """doc_id and n_tokens of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.size(words(F.col("text"))).cast("long").alias("n_tokens"))


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, shard: int = SHARD) -> DataFrame:
    """doc_id, n_tokens, bucket (from 0), bucket_tokens (its padded length),
    batch (from 0 in each bucket) and place (from 0 in each batch)."""
    spark = docs.sparkSession
    sized = materialise(lengths(docs).withColumn("row", F.monotonically_increasing_id()), "lengths")
    histogram = sized.groupBy("n_tokens").agg(F.count("*").alias("count")).orderBy("n_tokens").collect()
    values = np.array([r["n_tokens"] for r in histogram], dtype=np.int64)
    counts = np.array([r["count"] for r in histogram], dtype=np.int64)
    bounds = optimal_bounds(values, counts, buckets)
    if not bounds:
        return spark.createDataFrame([], "doc_id long, n_tokens long, bucket int, bucket_tokens long, batch long, place long")
    # The bounds are a handful of literals: no join.
    bucket = sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    shards = max(1, -(-int(counts.sum()) // shard))
    # Rows of an id with very many of them, or without id, are dealt by their row in
    # the table written above; all others by their id, so that places repeat.
    crowd = materialise(sized.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > shard).select("doc_id"), "crowded-ids")
    name = F.col("doc_id").cast("string")
    if not crowd.isEmpty():
        crowded = crowd.select(F.col("doc_id").alias("crowd"), F.lit(True).alias("dealt"))
        sized = sized.join(crowded, F.col("doc_id").eqNullSafe(F.col("crowd")), "left")
        name = F.when(F.col("dealt"), F.concat(F.lit("row "), F.col("row").cast("string"))).otherwise(name)
    digest = F.conv(F.substring(F.md5(F.coalesce(name, F.lit("-1"))), 1, 8), 16, 10).cast("long")
    placed = sized.select("doc_id", "n_tokens", bucket.cast("int").alias("bucket"), (digest % shards).alias("shard"))

    within = Window.partitionBy("bucket", "shard").orderBy(F.coalesce("doc_id", F.lit(-1)), "n_tokens")
    nth = placed.withColumn("nth", F.row_number().over(within) - 1)
    # What stands before a shard in its bucket, summed up in two levels.
    sums = placed.groupBy("bucket", "shard").count().withColumn("upper", F.floor(F.col("shard") / LEVEL))
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    low = sums.withColumn("low", F.coalesce(F.sum("count").over(before("bucket", "upper", "shard")), F.lit(0)))
    high = sums.groupBy("bucket", "upper").agg(F.sum("count").alias("count"))
    high = high.withColumn("high", F.coalesce(F.sum("count").over(before("bucket", "upper")), F.lit(0))).drop("count")
    offsets = low.join(high, ["bucket", "upper"]).select("bucket", "shard", (F.col("low") + F.col("high")).alias("offset"))

    bound = F.element_at(F.array(*[F.lit(b) for b in bounds]), F.col("bucket") + 1).cast("long")
    at = (F.col("offset") + F.col("nth")).cast("long")
    size = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_tokens", F.lit(1)))).cast("long")
    out = nth.join(offsets, ["bucket", "shard"]).withColumn("bucket_tokens", bound)
    return out.select("doc_id", "n_tokens", "bucket", "bucket_tokens", F.floor(at / size).alias("batch"), (at % size).alias("place"))
