"""JDBC source.

A plain ``spark.read.jdbc(url, table)`` reads through ONE connection in ONE
task. For anything large give a numeric/date ``partition_column`` with bounds
so the read splits into ``num_partitions`` range queries; filters and column
pruning are pushed into the generated SQL. Credentials are always passed in by
the caller (N16).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """The reader options of :func:`read_jdbc`."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower/upper bounds and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A JDBC table as a DataFrame; ``kwargs`` as in :func:`jdbc_read_options`."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **kwargs)).load()
