"""File and table sinks (K1, K2, K4, K5).

Partitioned writes go through a ``rebalance`` on the partition columns: rows of
one year land in the same tasks (few files per year), and AQE splits a year
that is much larger than the others over several tasks instead of writing it
from one task, and merges the small ones. Spark itself refuses to overwrite a
path that the same plan reads (N15).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.session import settings

# Cap on rows per output file, so one large partition does not become one
# huge file.
MAX_RECORDS_PER_FILE = 5_000_000
# Cap on rows per row group, the least that a later task reads: Parquet's own cap
# goes by the written size, to which many rows may shrink.
MAX_RECORDS_PER_GROUP = 250_000
# Files that a task keeps open side by side; rows of more partitions are sorted first.
MAX_OPEN_FILES = 16


def _balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def write_partitioned_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] = "year",
    mode: str = "overwrite",
    dynamic_overwrite: bool = False,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    observation: Observation | None = None,
    observed: Mapping[str, Column] | None = None,
    laid_out: bool = False,
) -> str:
    """Hive-style ``key=value`` Parquet dataset (K1). ``overwrite`` replaces the
    whole dataset unless ``dynamic_overwrite`` limits it to the partitions being
    written. Rows with a NULL key go to ``__HIVE_DEFAULT_PARTITION__``.

    ``laid_out`` says that the rows already stand by partition, so they are not
    moved again. ``observation`` receives ``rows`` = rows written and what
    ``observed`` adds. It is attached above the rebalance exchange, i.e. in the write's result stage, whose task updates are
    applied once even when a lost executor makes Spark re-run map stages.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    balanced = df if laid_out else _balanced(df, cols)
    if observation is not None:
        more = [c.alias(name) for name, c in (observed or {}).items()]
        balanced = balanced.observe(observation, F.count(F.lit(1)).alias("rows"), *more)
    writer = (
        balanced
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("parquet.block.row.count.limit", MAX_RECORDS_PER_GROUP)
    )
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if cols:
        writer = writer.partitionBy(*cols)
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": MAX_OPEN_FILES}):
        writer.parquet(path)
    return path


def save_partitioned_table(
    df: DataFrame,
    name: str,
    partition_by: str | list[str] = "year",
    mode: str = "overwrite",
    path: str | None = None,
    fmt: str = "parquet",
) -> str:
    """Catalog table partitioned by ``partition_by`` (K2). Without ``path`` the
    table is managed (data under the warehouse folder); with ``path`` its data
    lives there and dropping the table keeps the files."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    writer = _balanced(df, cols).write.mode(mode).format(fmt)
    if cols:
        writer = writer.partitionBy(*cols)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", sep: str = ",") -> str:
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def schema_json(df: DataFrame, indent: int | None = 2) -> str:
    """The schema as JSON text (K4)."""
    return json.dumps(json.loads(df.schema.json()), indent=indent)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema JSON as rows, next to what the table holds (K4, C7): position,
    name, type (JSON text for nested types), nullable, and the rows and values of
    each column, counted in one pass without a shuffle of the table."""
    spark = df.sparkSession
    fields = "struct<fields:array<struct<name:string,type:string,nullable:boolean>>>"
    text = spark.createDataFrame([(schema_json(df, None),)], "json string")
    schema = text.select(F.posexplode(F.from_json("json", fields)["fields"]).alias("position", "f"))
    counted = [F.struct(F.lit(i).alias("at"), F.count(F.col(f"`{c}`")).alias("n_values")) for i, c in enumerate(df.columns)]
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*counted).alias("counts"))
    counts = counts.select("n_rows", F.explode("counts").alias("c")).select("n_rows", "c.*")
    joined = schema.join(counts, F.col("position") == F.col("at"))
    return joined.select("position", "f.name", "f.type", "f.nullable", "n_rows", "n_values")


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))
