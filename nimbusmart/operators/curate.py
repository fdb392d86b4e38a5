"""Silver curation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.functions.metrics import METRIC_COLUMNS, REQUIRED_COLUMNS
from nimbusmart.functions.scalar import try_double


def cast_metrics(df: DataFrame, metrics: list[str] = METRIC_COLUMNS) -> DataFrame:
    """Cast the metrics that are present to double in one projection; text that
    does not parse becomes NULL (N1: ANSI ``cast`` would fail the job)."""
    present = [c for c in metrics if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: try_double(c) for c in present})


def is_complete(df: DataFrame, subset: list[str] = REQUIRED_COLUMNS) -> Column:
    """True for the rows :func:`drop_incomplete` keeps: no NULL in ``subset``,
    and no NaN in its float columns."""
    conds = []
    for c in subset:
        cond = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return reduce(and_, conds)


def drop_incomplete(df: DataFrame, subset: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows with NULL in any of ``subset`` (NaN counts as missing too)."""
    return df.dropna(how="any", subset=list(subset))


def curate(df: DataFrame, metrics: list[str] = METRIC_COLUMNS) -> DataFrame:
    """Bronze -> silver: typed metrics, complete keys, whole-row distinct.

    ``dropDuplicates()`` plans as a partial aggregate before the shuffle, so a
    group of copies holding a third of the data shrinks to one row per map task
    before it is exchanged.
    """
    return drop_incomplete(cast_metrics(df, metrics)).dropDuplicates()


# A row with more copies than this share of all rows, and than so many, is hot.
HOT_SHARE, HOT_COPIES = 0.001, 1_000_000
_TRACKED = 10_000  # items of the sketch that finds them: its error is well below the share
PART = "__part"


def row_hash(df: DataFrame) -> Column:
    """64 bits of a whole row; equal rows have equal hashes, whatever the order of columns."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def copies_sketch(df: DataFrame, metrics: list[str] = METRIC_COLUMNS) -> Column:
    """The commonest rows of ``df`` as they will stand in silver: an aggregate of a
    few thousand counters, cheap enough to be observed while bronze is written."""
    present = [c for c in metrics if c in df.columns]
    typed = [try_double(c) if c in present else F.col(f"`{c}`") for c in sorted(df.columns)]
    return F.call_function("approx_top_k", F.xxhash64(*typed), F.lit(int(1 / HOT_SHARE)), F.lit(_TRACKED))


def hot_hashes(sketch: Iterable, rows: int) -> list[int]:
    """Hashes of the rows with more copies than ``HOT_SHARE`` of ``rows``: at most
    ``1 / HOT_SHARE``, and none in a table that has fewer than ``HOT_COPIES`` rows."""
    least = max(HOT_SHARE * rows, HOT_COPIES)
    return [r["item"] for r in sketch or () if r["item"] is not None and r["count"] > least]


def curate_by_year(
    df: DataFrame, parts: Mapping[int, int], hot: Iterable[int] = (), metrics: list[str] = METRIC_COLUMNS, by: str = "year"
) -> DataFrame:
    """:func:`curate`, already laid out for a write by year: one shuffle of the rows.

    A year is dealt to ``parts[year]`` parts by a hash of the whole row. Copies are
    of one year and one hash, so the tasks that the write wants are also those
    that can drop the copies: the distinct needs no exchange of its own.

    That exchange comes before the copies are dropped, so a row with very many
    copies (``hot``, by hash; see :func:`copies_sketch`) would meet in one task.
    Hot rows take the other way: a plain distinct, whose partial aggregate leaves
    one row a map task before its exchange. ``hot`` decides the plan, never the rows.
    """
    rows = drop_incomplete(cast_metrics(df, metrics))
    h, hot = row_hash(rows), list(hot)
    n = F.lit(1)
    if parts:
        sizes = F.create_map(*[F.lit(x) for year, k in parts.items() for x in (int(year), int(k))])
        n = F.coalesce(F.try_element_at(sizes, F.col(by).cast("int")), F.lit(1))
    dealt = rows.withColumn(PART, F.pmod(h, n))
    common = dealt.where(~h.isin(hot)) if hot else dealt
    out = common.repartition(by, PART).dropDuplicates().drop(PART)
    return out.unionByName(rows.where(h.isin(hot)).dropDuplicates()) if hot else out
