"""Weather roles over the driver's TPC-H-like tables.

The reference reads daily weather, cities and countries that are not in its
tree; these builders derive inputs of the same shape from ``lineitem``,
``supplier``, ``nation`` and ``region`` so every stage runs over whole tables.
The mapping deliberately contains the cases the pipeline must handle:
unmatched cities (suppliers divisible by 10), homonym cities (suppliers = 1 mod
25 appear under a second nation), NULL dates (orders divisible by 97), NULL
snow depth, and full-row duplicates (orders divisible by 50 appear twice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusmart.operators.inspect import ensure_parallelism


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations: one row per lineitem, plus a duplicate of some."""
    li = ensure_parallelism(table(spark, sf_dir, "lineitem"))
    # One scan: the planted duplicates are a second copy of the same row made
    # by explode, not a second read of lineitem (the SQL form below unions a
    # filtered re-read; both give the same bag of rows). A copy stays in the
    # partition of its original, so the partial dedupe folds it map-side.
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.lit(2)).otherwise(F.lit(1))
    rows = li.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    qty, line = F.col("l_quantity"), F.col("l_linenumber")
    return rows.select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("city_name"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit(None)).otherwise(F.col("l_shipdate")).alias("date"),
        F.col("l_orderkey").alias("station_id"),
        qty.alias("avg_temp_c"),
        (line - 5).cast("double").alias("min_temp_c"),
        (qty + line).alias("max_temp_c"),
        F.col("l_extendedprice").alias("precipitation_mm"),
        F.when(F.col("l_returnflag") == "R", qty).alias("snow_depth_mm"),
        ((F.col("l_partkey") * 7) % 360).cast("double").alias("avg_wind_dir_deg"),
        (F.col("l_orderkey") % 90).cast("double").alias("avg_wind_speed_kmh"),
        (F.col("l_orderkey") % 150).cast("double").alias("peak_wind_gust_kmh"),
        (1000 + line).cast("double").alias("avg_sea_level_pres_hpa"),
        (line * 60).cast("double").alias("sunshine_total_min"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """city_name, country, iso3, iso2 — suppliers as cities of a nation."""
    sup = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    home = sup.where(F.col("s_suppkey") % 10 != 0).select(
        "s_name", F.col("s_nationkey").alias("k")
    )
    twins = sup.where(F.col("s_suppkey") % 25 == 1).select(
        "s_name", ((F.col("s_nationkey") + 1) % 25).alias("k")
    )
    return home.unionByName(twins).join(nation, F.col("k") == F.col("n_nationkey")).select(
        F.col("s_name").alias("city_name"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").alias("iso3"),
        F.col("n_nationkey").alias("iso2"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country, iso2, iso3, region — nations with their region name."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_name").alias("country"),
        F.col("n_nationkey").alias("iso2"),
        F.col("n_nationkey").alias("iso3"),
        F.col("r_name").alias("region"),
    )


# Same roles as DuckDB SQL, for the oracle side of the correctness check.
ROLE_CTES = """
weather as (
  select concat('Supplier#', lpad(cast(l_suppkey as varchar), 9, '0')) as city_name,
         case when l_orderkey % 97 = 0 then null else l_shipdate end as date,
         l_orderkey as station_id,
         l_quantity as avg_temp_c,
         cast(l_linenumber - 5 as double) as min_temp_c,
         l_quantity + l_linenumber as max_temp_c,
         l_extendedprice as precipitation_mm,
         case when l_returnflag = 'R' then l_quantity end as snow_depth_mm,
         cast((l_partkey * 7) % 360 as double) as avg_wind_dir_deg,
         cast(l_orderkey % 90 as double) as avg_wind_speed_kmh,
         cast(l_orderkey % 150 as double) as peak_wind_gust_kmh,
         cast(1000 + l_linenumber as double) as avg_sea_level_pres_hpa,
         cast(l_linenumber * 60 as double) as sunshine_total_min
  from (select * from lineitem union all select * from lineitem where l_orderkey % 50 = 0) l
),
cities as (
  select s_name as city_name, n_name as country, n_nationkey as iso3, n_nationkey as iso2
  from (select s_name, s_nationkey as k from supplier where s_suppkey % 10 <> 0
        union all
        select s_name, (s_nationkey + 1) % 25 as k from supplier where s_suppkey % 25 = 1) s
  join nation on k = n_nationkey
),
countries as (
  select n_name as country, n_nationkey as iso2, n_nationkey as iso3, r_name as region
  from nation left join region on n_regionkey = r_regionkey
),
geo as (
  select c.iso3, c.city_name, c.country, c.iso2, k.region
  from cities c left join countries k on c.iso3 = k.iso3
),
bronze as (
  select w.city_name, w.date, avg_temp_c, min_temp_c, max_temp_c, precipitation_mm, snow_depth_mm,
         avg_wind_dir_deg, avg_wind_speed_kmh, peak_wind_gust_kmh, avg_sea_level_pres_hpa,
         sunshine_total_min, g.country, g.region, cast(year(w.date) as int) as year
  from weather w left join geo g on w.city_name = g.city_name
),
silver as (
  select distinct * from bronze where date is not null and city_name is not null and year is not null
)
"""
