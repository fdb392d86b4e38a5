"""Analytic views over a mart.

The reference computes these in pandas on a pulled copy of the mart capped at
150 000 rows; here each one is a lazy DataFrame that aggregates where the data
lives, so there is no cap and nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusmart.functions.metrics import MART_KEYS, label_of, metrics_of
from nimbusmart.functions.scalar import compass_glyph, compass_name, nan_to_null

WIND_DIR = "avg_wind_dir_deg"
# Rows are listed in this order wherever the reference relied on arrival order.
VIEW_ORDER = ["country", "region", "city_name"]


def _require_city(mart: DataFrame, view: str) -> None:
    if "city_name" not in mart.columns:
        raise ValueError(f"{view} needs a city_name column; this mart has {mart.columns}")


def _ordered(df: DataFrame, names: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in names if c in df.columns]


def year_bounds(mart: DataFrame) -> DataFrame:
    """Smallest and largest year."""
    y = F.col("year").cast("int")
    return mart.agg(F.min(y).alias("min_year"), F.max(y).alias("max_year"))


def latest_year(mart: DataFrame) -> Column:
    """The default slice year (the largest) as a scalar subquery, evaluated by
    Spark at run time; on a partitioned mart it still prunes partitions."""
    return mart.select(F.max(F.col("year").cast("int"))).scalar()


def year_slice(mart: DataFrame, year: int | None = None) -> DataFrame:
    """One year of a mart, the latest by default; the whole mart when it has no
    ``year`` column (P13, T10)."""
    if "year" not in mart.columns:
        return mart
    target = F.lit(year) if year is not None else latest_year(mart)
    return mart.where(F.col("year").cast("int") == target)


def metric_catalog(mart: DataFrame) -> DataFrame:
    """Long form of a mart: one row per (key, metric) with the metric's display
    label (P15, P16). Metrics are discovered from the columns at plan time."""
    keys = [k for k in MART_KEYS if k in mart.columns]
    metrics = metrics_of(mart.columns)
    if not metrics:
        raise ValueError("the mart has no metric columns")
    long = mart.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        keys, metrics, "metric", "value"
    )
    labels = F.create_map(*[x for m in metrics for x in (F.lit(m), F.lit(label_of(m)))])
    return long.withColumn("label", labels[F.col("metric")])


def national_mean(
    mart: DataFrame,
    metric: str,
    year: int | None = None,
    labelled: bool = True,
    digits: int | None = None,
) -> DataFrame:
    """Unweighted mean of the city values per country for one year.

    Rows without a country are left out; NaN counts as missing; a country whose
    values are all missing keeps a NULL mean (N7, N8). The value column is named
    after the metric's label when ``labelled``.
    """
    value = F.avg(nan_to_null(metric))
    if digits is not None:
        value = F.round(value, digits)
    name = label_of(metric) if labelled else metric
    return (
        year_slice(mart, year)
        .where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(value.alias(name))
    )


def national_compass(mart: DataFrame, year: int | None = None, digits: int | None = None) -> DataFrame:
    """National mean wind direction with its arrow glyph (T7, F10). The glyph is
    taken from the unrounded mean; ``digits`` only rounds the shown value."""
    label = label_of(WIND_DIR)
    view = national_mean(mart, WIND_DIR, year, labelled=True)
    view = view.withColumn("Arrow", compass_glyph(F.col(label)))
    if digits is not None:
        view = view.withColumn(label, F.round(F.col(label), digits))
    return view


def with_compass(df: DataFrame, metric: str = WIND_DIR) -> DataFrame:
    """Sector index, glyph-and-name and glyph of an angle column."""
    from nimbusmart.functions.scalar import compass_index

    return df.withColumns(
        {
            "sector": compass_index(metric),
            "Direction": compass_name(metric),
            "Arrow": compass_glyph(metric),
        }
    )


def compass_view(mart: DataFrame, year: int | None = None, n: int = 30, metric: str = WIND_DIR) -> DataFrame:
    """First ``n`` cities of the year slice that have a wind direction, with the
    direction and a ``"city direction"`` label (T8, L3, F11)."""
    _require_city(mart, "compass_view")
    sample = (
        year_slice(mart, year)
        .dropna(subset=[metric])
        .orderBy(*_ordered(mart, VIEW_ORDER))
        .limit(n)
    )
    # One projection over the limit (not two stacked ones) keeps the plan a
    # top-k (TakeOrderedAndProject) instead of a global sort.
    direction = compass_name(metric)
    return sample.select(
        "*", direction.alias("Direction"), F.concat(F.col("city_name"), F.lit(" "), direction).alias("Label")
    )


def top_cities(mart: DataFrame, metric: str, year: int | None = None, n: int = 15) -> DataFrame:
    """The ``n`` cities with the largest value of ``metric`` in a year, missing
    values last, ties broken by name (T9, L2). Planned as a top-k
    (``TakeOrderedAndProject``), never a full sort."""
    _require_city(mart, "top_cities")
    ranked = year_slice(mart, year).orderBy(
        nan_to_null(metric).desc_nulls_last(), *_ordered(mart, VIEW_ORDER)
    )
    return ranked.limit(n).select("city_name", "country", metric)
