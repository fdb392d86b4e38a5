"""In-memory rows with an explicit schema (S6). For small reference data only:
the rows travel from the driver to the executors inside the plan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
