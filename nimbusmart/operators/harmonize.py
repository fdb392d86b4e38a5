"""Harmonise unlike feeds to one schema and unite them by name.

A mapping spec says, for each target column, where its value comes from: a
source column name (``"a.b"`` reaches into structs), a ``Column`` expression,
or ``None`` for a typed NULL. Applying a spec is one ``select`` that also casts
every column to the target type, so the union never depends on type widening
(under ANSI, int ∪ string widens to bigint and fails at run time).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.functions.scalar import composite_id

Spec = Mapping[str, "Column | str | None"]

# --- fixed values: the shared restaurant schema of the two county feeds -----
RESTAURANT_SCHEMA = T.StructType(
    [
        T.StructField("county", T.StringType()),
        T.StructField("datasetId", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("address1", T.StringType()),
        T.StructField("address2", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("tel", T.StringType()),
        T.StructField("dateStart", T.StringType()),
        T.StructField("dateEnd", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("geoX", T.DoubleType()),
        T.StructField("geoY", T.DoubleType()),
        T.StructField("id", T.StringType()),
    ]
)
# Composite id parts, in order.
RESTAURANT_ID_PARTS = ["state", "county", "datasetId"]
# ---------------------------------------------------------------------------


def _source(value: Column | str | None) -> Column:
    if value is None:
        return F.lit(None)
    if isinstance(value, str):
        return F.col(value)
    return value


def harmonize(df: DataFrame, spec: Spec, schema: T.StructType | None = None) -> DataFrame:
    """Project ``df`` onto the spec's target columns, in schema order when a
    schema is given, each cast to its target type. Targets of the schema that
    the spec leaves out become typed NULLs."""
    if schema is None:
        return df.select(*[_source(v).alias(k) for k, v in spec.items()])
    unknown = set(spec) - set(schema.names)
    if unknown:
        raise ValueError(f"spec targets not in schema: {sorted(unknown)}")
    return df.select(
        *[_source(spec.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def union_all_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union matched by column name."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def harmonize_restaurants(df: DataFrame, spec: Spec, county: str) -> DataFrame:
    """One county feed onto the shared restaurant schema, with its county name
    and ``state_county_datasetId`` id (U3)."""
    full = dict(spec)
    full["county"] = F.lit(county)
    out = harmonize(df, {k: v for k, v in full.items() if k != "id"}, RESTAURANT_SCHEMA)
    return out.withColumn("id", composite_id(*RESTAURANT_ID_PARTS))
