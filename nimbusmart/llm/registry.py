"""Registry of the training-data queries: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

_shipped: set[str] = set()  # application ids


def ship_package(spark: SparkSession) -> None:
    """Give the session's Python workers this package, as ``--py-files`` would;
    they may run on machines, or in folders, from which it can't be imported."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Spark serves the file to executors for as long as the application lives.
    path = os.path.join(tempfile.mkdtemp(prefix="nimbusmart-package-"), "nimbusmart-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return deco
