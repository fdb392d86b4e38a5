"""The ETL stages over the fixture roles, as lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusmart.functions.metrics import MART_KEYS, MARTS
from nimbusmart.operators.curate import cast_metrics, curate, is_complete
from nimbusmart.operators.geo import feed_bronze, geo_dimension
from nimbusmart.operators.marts import build_mart
from nimbusmart.operators.serving import open_mart
from nimbusmart.plans import roles
from nimbusmart.plans.pipeline import run_pipeline
from nimbusmart.plans.reuse import reused


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_dimension(roles.cities(spark, sf_dir), roles.countries(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_bronze(
        roles.weather(spark, sf_dir), roles.cities(spark, sf_dir), roles.countries(spark, sf_dir)
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(bronze(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str, name: str = "dm_risks") -> DataFrame:
    """One mart, from the weather tables on."""
    return build_mart(silver(spark, sf_dir), MARTS[name])


INPUTS = ("lineitem", "supplier", "nation", "region")


def written_layers(spark: SparkSession, sf_dir: str, max_age: float | None = None) -> str:
    """The folder of the written pipeline over ``sf_dir``: bronze, silver, gold and,
    in ``counts``, the rows that each write counted.

    It is written under the shared folder of ``spark.checkpoint.dir`` and used again
    as long as the input files stay the same, and for ``max_age`` seconds at most.
    """

    def build(base: str) -> None:
        res = run_pipeline(
            spark, roles.weather(spark, sf_dir), roles.cities(spark, sf_dir), roles.countries(spark, sf_dir), base
        )
        spark.createDataFrame(list(res.rows.items()), "stage string, n long").write.parquet(f"{base}/counts")

    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in INPUTS]
    return reused(spark, "layers", inputs, build, max_age)


def gold_registry(spark: SparkSession, sf_dir: str, max_age: float | None = None) -> dict[str, str]:
    """Where the written marts of ``sf_dir`` are: name -> Parquet path."""
    base = written_layers(spark, sf_dir, max_age)
    return {name: f"{base}/gold/{name}" for name in MARTS}


def written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stage, n): the rows of every layer and mart, as counted by its write."""
    return spark.read.parquet(f"{written_layers(spark, sf_dir)}/counts")


def served_mart(spark: SparkSession, sf_dir: str, name: str = "dm_risks") -> DataFrame:
    """A written mart, opened by name as the serving layer and the views do."""
    return open_mart(spark, name, gold_registry(spark, sf_dir))


def stage_counts(weather: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """(stage, n): rows of weather, bronze, silver and the risk mart, in one
    pass over the chain.

    Counting each stage on its own scans the fact table once per stage and
    runs the silver dedupe again for every stage after it. Here bronze is
    grouped once by all its columns, which is the silver dedupe, keeping each
    distinct row's number of copies. A second, small grouping by (mart keys,
    complete) then yields bronze (all copies), silver (complete distinct rows)
    and the mart (complete key groups). Weather is counted by its own scan,
    which needs no shuffle: the geo join may repeat a weather row, so bronze
    cannot give it. Both groupings aggregate partially before their exchange.
    """
    bronze = cast_metrics(feed_bronze(weather, cities, countries))
    keys = [k for k in MART_KEYS if k in bronze.columns]
    rows = bronze.groupBy(*bronze.columns).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = rows.groupBy(*keys, is_complete(rows).alias("_complete")).agg(
        F.sum("_copies").alias("_bronze"), F.count(F.lit(1)).alias("_distinct")
    )
    complete = F.col("_complete")
    totals = per_key.agg(
        F.coalesce(F.sum("_bronze"), F.lit(0)).alias("bronze"),
        F.coalesce(F.sum(F.when(complete, F.col("_distinct"))), F.lit(0)).alias("silver"),
        F.count_if(complete).alias("dm_risks"),
    )
    weather_n = weather.agg(F.count(F.lit(1)).alias("n")).select(F.lit("weather").alias("stage"), "n")
    return weather_n.unionByName(
        totals.unpivot([], ["bronze", "silver", "dm_risks"], "stage", "n").select("stage", "n")
    )
