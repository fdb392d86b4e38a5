"""Reading the training-data tables and writing intermediate results.

Intermediate tables go to the shared folder of ``spark.checkpoint.dir`` (see
``nimbusmart.session.checkpoint_dir``), so a lost executor costs a re-run of
tasks, never data that only one machine had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusmart.session import scratch_path

# Characters that separate words: space and \x09-\x0D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` for helper columns, lengthened until ``df`` has none of them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def text_key(text: Column) -> Column:
    """31 bits of the text: with doc_id it names a row where ids are repeated."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(0x7FFFFFFF))
