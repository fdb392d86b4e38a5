"""Inspection helpers."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def partition_count(df: DataFrame) -> int:
    """Number of partitions of the plan's output."""
    return df.rdd.getNumPartitions()


def rows_per_partition(df: DataFrame) -> DataFrame:
    """(partition, rows) for every non-empty partition, computed on executors."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows, for display (L4); with ``order_by`` always the same ones."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_tree(df: DataFrame) -> str:
    """What ``printSchema`` prints."""
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.printSchema()
    return buf.getvalue()


def row_count(df: DataFrame) -> int:
    """Row count (A8). Inside a write, prefer ``DataFrame.observe`` to save a job."""
    return df.count()


class TooManyRows(RuntimeError):
    pass


def bounded_collect(df: DataFrame, max_rows: int) -> list[Row]:
    """Collect to the driver only when the result is provably small (C8): reads
    at most ``max_rows + 1`` rows and raises if there are more."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise TooManyRows(f"more than {max_rows} rows; write the result instead of collecting it")
    return rows


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A large input made of many files and row groups is already split finely,
    so this is a no-op at scale; a single-row-group file would otherwise run
    every operator up to the first shuffle in one task. The check only plans
    the scan (no data is read). The row ids of a file scan are the same on a
    recomputation, so a retried task sends every row where it went before.
    """
    spark = df.sparkSession
    try:
        target = min_partitions or spark.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no SparkContext (Spark Connect): leave the plan alone
        return df
    if current >= target:
        return df
    # Hash of the row id spreads rows evenly (copies included) and, unlike a
    # round-robin repartition, needs no sort to stay deterministic on retry.
    return df.repartition(target, F.monotonically_increasing_id())
