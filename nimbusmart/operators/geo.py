"""Geo dimension and the bronze feed.

The weather side is the large one and is never broadcast or collected. The geo
side (cities joined to countries) is broadcast only after a bounded check of
its size in bytes; past the bound the join stays a shuffle join and AQE's skew-join
handling splits hot city keys. The join of the two dimension tables needs no
such check: no fact data takes part in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.functions.metrics import TECHNICAL_COLUMNS
from nimbusmart.functions.scalar import tolerant_year

# A dimension is broadcast only when its rows take at most this many bytes.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
_FIELD_BYTES = 8


def broadcastable(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the rows of ``df`` provably take at most ``max_bytes``.

    One job reads at most as many rows as could fit at 8 bytes a field, adds up
    what they take (8 bytes a field and the length of every string), and stops.
    """
    if max_bytes <= 0:
        return False
    fixed = _FIELD_BYTES * (len(df.columns) + 1)
    most = max_bytes // fixed + 1
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    size = sum(texts, F.lit(fixed)).cast("long")
    row = df.limit(most).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return row["n"] < most and row["bytes"] <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` provably takes at most ``max_bytes``;
    above the bound ``df`` is returned as is and Spark plans a shuffle join."""
    return F.broadcast(df) if broadcastable(df, max_bytes) else df


def geo_dimension(cities: DataFrame, countries: DataFrame) -> DataFrame:
    """cities ⟕ countries USING iso3, after removing the clashing country
    columns from the right side (J1, J3). Columns: iso3, cities..., region.

    Both sides are dimension tables, so the join strategy is left to Spark:
    a static broadcast of a small scan, or a shuffle join that AQE turns into
    a broadcast once the measured shuffle output is small. No fact data is
    shuffled either way.
    """
    return cities.join(countries.drop("country", "iso2"), on="iso3", how="left")


def feed_bronze(
    weather: DataFrame,
    cities: DataFrame,
    countries: DataFrame,
    max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Daily weather ⟕ geo on the bare city name, technical columns dropped,
    ``year`` derived from ``date`` (T2).

    Homonym cities fan out (one weather row per matching geo row, N5); unmatched
    cities keep NULL country/region (N6). The geo side is broadcast only after a
    bounded probe proves its size, so the weather side is never shuffled
    for this join; above the bound it is a shuffle join with AQE skew splitting.
    """
    geo = bounded_broadcast(geo_dimension(cities, countries), max_broadcast_bytes)
    joined = weather.join(geo, on="city_name", how="left").drop(*TECHNICAL_COLUMNS)
    return joined.withColumn("year", tolerant_year(joined, "date"))


def fanout_report(geo: DataFrame, key: str = "city_name") -> DataFrame:
    """Keys that match more than one geo row, with how many."""
    return (
        geo.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("geo_rows"))
        .where(F.col("geo_rows") > 1)
    )
