"""JDBC sink (K3): ``overwrite`` drops and re-creates the table unless
``truncate`` keeps its definition. ``num_partitions`` bounds the number of
concurrent connections (Spark coalesces to it before writing)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    truncate: bool = False,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """The writer options of :func:`write_jdbc`."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size), "truncate": str(truncate).lower()}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **kwargs) -> None:
    """Write ``df`` to a JDBC table; ``kwargs`` as in :func:`jdbc_write_options`."""
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **kwargs)).save()
