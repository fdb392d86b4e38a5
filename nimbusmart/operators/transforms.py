"""Column-level reshaping from the exercise sheet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusmart.functions.scalar import midpoint


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns in one projection; names that are absent are
    ignored, like ``withColumnRenamed`` (P4)."""
    present = {a: b for a, b in mapping.items() if a in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name; unknown names are ignored and every column carrying a
    dropped name goes (P5)."""
    return df.drop(*names)


MODES = ("noop", "", "full")


def interval_midpoint(df: DataFrame, lower: str, upper: str, mode: str = "") -> DataFrame:
    """Rename the bounds to ``lcl``/``ucl``; unless ``mode`` is ``noop`` add the
    midpoint ``avg`` and the copies ``lcl2``/``ucl2``; ``full`` adds then drops
    them again (P18 — the intent of the exercise's mode switch)."""
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    out = rename_columns(df, {lower: "lcl", upper: "ucl"})
    if mode == "noop":
        return out
    out = out.withColumns({"avg": midpoint("lcl", "ucl"), "lcl2": F.col("lcl"), "ucl2": F.col("ucl")})
    if mode == "full":
        out = out.drop("avg", "lcl2", "ucl2")
    return out
