"""Word count over whole texts.

Tokens follow the classic MapReduce word count: case-sensitive, separated by
runs of space, tab, newline, carriage return or form feed; empty tokens are
dropped. ``groupBy`` aggregates partially on each task before the shuffle, so
a very frequent word costs one row per task in the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed value: the token separators ---------------------------------------
SEPARATORS = "[ \\t\\n\\r\\f]+"
# ---------------------------------------------------------------------------


def tokens(df: DataFrame, text_col: str = "text") -> DataFrame:
    words = df.select(F.explode(F.split(F.col(text_col), SEPARATORS)).alias("word"))
    return words.where(F.col("word") != "")


def word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) for every distinct token of every text."""
    return tokens(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def write_counts(counts: DataFrame, path: str) -> str:
    """The word-count output directory (K5): text part files of
    ``word<TAB>count`` lines. A token never holds a tab or a line break (they
    separate tokens), so every line splits back unambiguously. The tasks of the
    aggregate write their own part files; nothing is merged into one file."""
    line = F.concat_ws("\t", F.col("word"), F.col("n").cast("string"))
    counts.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(word, n) back from a word-count output directory."""
    parts = F.split(F.col("value"), "\t")
    return spark.read.text(path).select(
        F.get(parts, 0).alias("word"), F.get(parts, 1).cast("long").alias("n")
    )
