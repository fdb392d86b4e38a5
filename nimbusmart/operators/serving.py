"""Mart reads: open by name, optional filters, capped result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.functions.metrics import MART_KEYS

DEFAULT_LIMIT = 100


class MartNotFound(LookupError):
    """The requested mart is neither registered nor a catalog table."""


def open_mart(
    spark: SparkSession, name: str, registry: Mapping[str, str] | None = None
) -> DataFrame:
    """A mart by name: a registered Parquet path first, else a catalog table."""
    if registry and name in registry:
        return spark.read.parquet(registry[name])
    if spark.catalog.tableExists(name):
        return spark.table(name)
    raise MartNotFound(f"mart {name!r} not found")


def filter_mart(df: DataFrame, year: int | None = None, country: str | None = None) -> DataFrame:
    """Optional equality filters, ANDed; a filter on a column the mart lacks is
    skipped (P12). On a year-partitioned mart the year filter prunes partitions."""
    if year is not None and "year" in df.columns:
        df = df.where(F.col("year") == F.lit(year))
    if country is not None and "country" in df.columns:
        df = df.where(F.col("country") == F.lit(country))
    return df


def capped(df: DataFrame, limit: int | None, order_by: list[str] | None = None) -> DataFrame:
    """At most ``limit`` rows. The rows are ordered by the mart key first so the
    same call always returns the same rows (a top-k, not a full sort). ``None``
    is the whole mart, unsorted: the bulk read has no cap."""
    if limit is None:
        return df
    keys = order_by if order_by is not None else [k for k in MART_KEYS if k in df.columns]
    if keys:
        df = df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return df.limit(limit)


def read_mart(
    spark: SparkSession,
    name: str,
    year: int | None = None,
    country: str | None = None,
    limit: int | None = DEFAULT_LIMIT,
    registry: Mapping[str, str] | None = None,
) -> DataFrame:
    """The mart read of the API (T5): name + optional year, country, limit."""
    return serve(open_mart(spark, name, registry), year, country, limit)


def serve(
    mart: DataFrame, year: int | None = None, country: str | None = None, limit: int | None = DEFAULT_LIMIT
) -> DataFrame:
    """Same as :func:`read_mart` on an already opened mart."""
    return capped(filter_mart(mart, year, country), limit)


def has_rows(df: DataFrame) -> bool:
    """Emptiness guard that reads at most one row."""
    return not df.isEmpty()


def as_json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row in a ``json`` column (K6); NULL fields stay as null."""
    record = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))


def parse_json_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of :func:`as_json_records` read back with their schema."""
    return records.select(F.from_json("json", schema).alias("r")).select("r.*")
