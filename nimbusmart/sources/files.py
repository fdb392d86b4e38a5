"""File sources.

Schema inference (CSV ``inferSchema``, JSON) costs an extra pass over the
input; at scale pass ``schema=`` instead. Every reader returns a lazy
DataFrame, so projections and filters applied later reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet with schema from footers and ``key=value`` partition discovery."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    infer_schema: bool = True,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """CSV with a header line and inferred types (S2); an explicit ``schema``
    skips inference (and keeps codes such as ``007`` as text)."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def read_csv_positional(spark: SparkSession, path: str, sep: str = ",", n_columns: int | None = None) -> DataFrame:
    """CSV read without a header: string columns ``_c0, _c1, ...``; a header
    line in the file is returned as an ordinary row (S3). Spark takes the number
    of columns from the first line it meets; ``n_columns`` fixes it instead, where
    some lines end early."""
    reader = spark.read.option("header", False).option("sep", sep)
    if n_columns is not None:
        reader = reader.schema(", ".join(f"_c{i} string" for i in range(n_columns)))
    return reader.csv(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    """JSON lines with inferred (or given) nested schema."""
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Plain text, one row per line in a ``value`` column."""
    return spark.read.text(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``, from the store's listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(root).getLength()


def partition_bytes(spark: SparkSession, path: str, column: str) -> dict[str, int]:
    """Bytes below each ``column=value`` folder of ``path``, from the store's listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for status in fs.listStatus(root):
        key, _, value = status.getPath().getName().partition("=")
        if status.isDirectory() and key == column:
            out[value] = fs.getContentSummary(status.getPath()).getLength()
    return out
