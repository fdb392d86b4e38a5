"""Catalog surface: databases, tables, delimited external tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    parts = name.split(".")
    if not all(_IDENT.match(p) for p in parts):
        raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def list_databases(spark: SparkSession) -> list[str]:
    """``SHOW DATABASES``."""
    return sorted(db.name for db in spark.catalog.listDatabases())


def create_database(
    spark: SparkSession, name: str, use: bool = False, location: str | None = None
) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` and optionally ``USE`` it.
    ``location`` places the database folder (else under the warehouse)."""
    loc = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}{loc}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_delimited_table(
    spark: SparkSession,
    name: str,
    columns: str,
    location: str,
    sep: str = ",",
    hive_format: bool = False,
    replace: bool = True,
) -> DataFrame:
    """External table over delimited text, typed by DDL.

    ``columns`` is a DDL column list such as ``"NUM INT, NAME CHAR(100)"``.
    Cells that do not parse as their type read as NULL (a header line becomes a
    row of NULLs and strings); ``CHAR(n)`` values come back blank padded.
    With ``hive_format`` the statement is the Hive ``ROW FORMAT DELIMITED``
    form, which needs a session with a Hive metastore; otherwise it is the
    equivalent ``USING csv`` table of the built-in catalog.
    """
    ident = _ident(name)
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {ident}")
    loc = location.replace("'", "\\'")
    delim = sep.replace("'", "\\'")
    if hive_format:
        spark.sql(
            f"CREATE EXTERNAL TABLE IF NOT EXISTS {ident} ({columns}) "
            f"ROW FORMAT DELIMITED FIELDS TERMINATED BY '{delim}' "
            f"STORED AS TEXTFILE LOCATION '{loc}'"
        )
    else:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {ident} ({columns}) USING csv "
            f"OPTIONS (header 'false', sep '{delim}', mode 'PERMISSIVE') LOCATION '{loc}'"
        )
    return spark.table(name)


def register_parquet_table(spark: SparkSession, name: str, path: str, replace: bool = True) -> DataFrame:
    """Catalog table over an already written (partitioned) Parquet folder.

    Metadata only: the schema and the ``key=value`` partition columns are read
    from the folder and its partitions are registered, so a multi-terabyte
    layer gets a table name without being copied.
    """
    ident = _ident(name)
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {ident}")
    loc = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ident} USING parquet LOCATION '{loc}'")
    if spark.table(name).columns and _is_partitioned(spark, name):
        spark.sql(f"ALTER TABLE {ident} RECOVER PARTITIONS")
    return spark.table(name)


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The partitions of a catalog table, one row each, with the partition columns
    in their types (``SHOW PARTITIONS``, K2). Only the catalog is read. The NULL
    partition comes out as NULL."""
    spec = spark.sql(f"SHOW PARTITIONS {_ident(name)}")
    keys = [c for c in spark.catalog.listColumns(name) if c.isPartition]
    # The catalog writes a value as in the folder's name: special characters as %XX.
    part = lambda i: F.substring_index(F.get(F.split("partition", "/"), F.lit(i)), "=", -1)
    value = lambda i: F.url_decode(F.replace(part(i), F.lit("+"), F.lit("%2B")))
    typed = [F.when(~part(i).isin(HIVE_NULL, "null"), value(i)).try_cast(c.dataType).alias(c.name) for i, c in enumerate(keys)]
    return spec.select(*typed)
