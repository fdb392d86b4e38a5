"""The batch ETL as written stages: bronze -> silver (+ catalog table) -> gold
(T1–T4).

Each stage reads what the previous one wrote, so a lost executor costs at most
the stage in flight and lineage never grows across stages. Row counts are taken
with ``observe`` during the writes instead of extra count jobs. Gold scans and
shuffles silver once: the risk mart (a superset of the other two) is written
first and the tourism and agriculture marts are projections of the written risk
mart.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nimbusmart.functions.metrics import MARTS, RISK_RULES
from nimbusmart.operators.curate import HOT_COPIES, copies_sketch, curate_by_year, hot_hashes
from nimbusmart.operators.geo import feed_bronze
from nimbusmart.operators.marts import build_mart, project_mart
from nimbusmart.operators.serving import has_rows
from nimbusmart.session import check_output, estimate_row_bytes, sized_shuffles, spread_shuffles
from nimbusmart.sinks.files import save_partitioned_table, write_partitioned_parquet
from nimbusmart.sources.catalog import register_parquet_table
from nimbusmart.sources.files import folder_bytes, partition_bytes, read_parquet

log = logging.getLogger(__name__)

MartSink = Callable[[str, DataFrame], None]


@dataclass
class PipelineResult:
    paths: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    shuffle_partitions: int | None = None


def _write_counted(df: DataFrame, path: str, name: str, **options) -> int:
    """Write year-partitioned Parquet and return the rows written, counted in
    the write job itself (no extra count job)."""
    return _write_observed(df, path, name, **options)[0]


def _write_observed(
    df: DataFrame, path: str, name: str, observed: Mapping[str, Column] | None = None, laid_out: bool = False
) -> tuple[int, dict]:
    """The rows written, and all that was observed on them."""
    obs = Observation(name)
    write_partitioned_parquet(df, path, "year", observation=obs, observed=observed, laid_out=laid_out)
    rows = int(obs.get["rows"])
    if rows == 0:
        # A partitioned write of no rows leaves no data file, so the next stage
        # could not read the layer's schema back (N13: an empty layer must
        # flow on). One empty file carries it; ``limit(0)`` reads nothing.
        cols = [c for c in df.columns if c != "year"] + ["year"]
        df.select(*cols).limit(0).write.mode("append").parquet(path)
    return rows, obs.get


def load_reference(
    spark: SparkSession, csv_path: str, sink: Callable[[DataFrame], None] | None = None, schema=None
) -> DataFrame:
    """Reference CSV (header, inferred or given types) -> optional sink."""
    from nimbusmart.sources.files import read_csv

    df = read_csv(spark, csv_path, schema=schema)
    if sink is not None:
        sink(df)
    return df


def run_bronze(weather: DataFrame, cities: DataFrame, countries: DataFrame, out: str) -> int:
    """Weather ⟕ geo -> year-partitioned Parquet; returns the rows written."""
    return write_bronze(weather, cities, countries, out)[0]


def write_bronze(weather: DataFrame, cities: DataFrame, countries: DataFrame, out: str) -> tuple[int, list[int]]:
    """:func:`run_bronze`, which also returns the hashes of the rows that have very
    many copies, sketched during the write, for the layout of silver."""
    df = feed_bronze(weather, cities, countries)
    rows, seen = _write_observed(df, out, "bronze", {"copies": copies_sketch(df)})
    return rows, hot_hashes(seen["copies"], rows)


# Bytes of a year that one silver task takes: as Parquet, and as rows in memory, which
# the distinct holds in about twice that.
SILVER_PART_BYTES = 128 * 1024 * 1024
SILVER_ROW_BYTES = 64 * 1024 * 1024


def silver_layout(
    spark: SparkSession, bronze_path: str, target_bytes: int = SILVER_PART_BYTES, row_bytes: int = SILVER_ROW_BYTES
) -> dict[int, int]:
    """year -> number of parts, by the size of the year's bronze folder and by its
    rows: how far Parquet shrinks them says nothing about their size in a task.

    The rows are counted by the footers, as only the folder's column is read.
    """
    sizes = partition_bytes(spark, bronze_path, "year")
    parts = {int(y): -(-n // target_bytes) for y, n in sizes.items() if y.lstrip("-").isdigit() and n}
    bronze = read_parquet(spark, bronze_path)
    one = estimate_row_bytes(bronze.schema)
    for year, rows in bronze.groupBy(F.col("year").try_cast("int")).count().collect():
        if year is not None:
            parts[year] = max(parts.get(year, 1), -(-rows * one // row_bytes))
    return parts


def find_hot_rows(bronze: DataFrame) -> list[int]:
    """:func:`write_bronze`'s hashes, for a bronze that someone else wrote: one scan
    without a shuffle, and none if the footers say that there are too few rows."""
    if bronze.count() <= HOT_COPIES:
        return []
    seen = bronze.agg(F.count(F.lit(1)).alias("rows"), copies_sketch(bronze).alias("copies")).first()
    return hot_hashes(seen["copies"], seen["rows"])


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    out: str,
    table: str | None = None,
    copy_table: bool = False,
    hot: Iterable[int] | None = None,
) -> int:
    """Bronze -> curated silver Parquet; returns the rows written.

    The rows move once: the exchange of the distinct is also the layout by year
    (see ``curate_by_year``). ``hot`` names rows with very many copies by their
    hash, if the caller knows them; else one pass over bronze looks for them.

    With ``table`` the written folder is also a partitioned catalog table. By
    default the table is registered over the written files (metadata only);
    ``copy_table`` instead saves a managed copy from the written files, as the
    reference job does, which doubles the silver I/O and storage.
    """
    check_output(out, bronze_path)
    bronze = read_parquet(spark, bronze_path)
    hot = find_hot_rows(bronze) if hot is None else hot
    parts = silver_layout(spark, bronze_path)
    with spread_shuffles(spark, sum(parts.values()), folder_bytes(spark, bronze_path)):
        rows = _write_counted(curate_by_year(bronze, parts, hot), out, "silver", laid_out=True)
    if table is not None:
        if copy_table:
            save_partitioned_table(read_parquet(spark, out), table, "year")
        else:
            register_parquet_table(spark, table, out)
    return rows


def run_gold(
    spark: SparkSession,
    silver_path: str,
    out_base: str,
    sink: MartSink | None = None,
) -> dict[str, int]:
    """Silver -> the three marts. An empty silver only logs a warning (N13);
    a sink failure is logged and re-raised."""
    check_output(out_base, silver_path)
    silver = read_parquet(spark, silver_path)
    if not has_rows(silver):
        log.warning("silver at %s is empty; marts will be empty", silver_path)
    risk_path = f"{out_base}/dm_risks"
    rows = {"dm_risks": _write_counted(build_mart(silver, RISK_RULES), risk_path, "dm_risks")}
    written = read_parquet(spark, risk_path)
    for name, rules in MARTS.items():
        if name != "dm_risks":
            rows[name] = _write_counted(project_mart(written, rules), f"{out_base}/{name}", name)
        if sink is not None:
            try:
                sink(name, read_parquet(spark, f"{out_base}/{name}"))
            except Exception:
                log.exception("writing mart %s to its sink failed", name)
                raise
    return rows


def run_pipeline(
    spark: SparkSession,
    weather: DataFrame,
    cities: DataFrame,
    countries: DataFrame,
    base: str,
    silver_table: str | None = None,
    sink: MartSink | None = None,
    size_shuffles: bool = True,
) -> PipelineResult:
    """load -> bronze -> silver -> gold under ``base``. With ``size_shuffles``
    the silver and gold jobs run with shuffle partitions sized for bronze."""
    res = PipelineResult()
    res.paths["bronze"] = f"{base}/bronze/weather_daily"
    res.paths["silver"] = f"{base}/silver/weather_curated"
    res.paths["gold"] = f"{base}/gold"
    res.rows["bronze"], hot = write_bronze(weather, cities, countries, res.paths["bronze"])
    if size_shuffles:
        # The silver dedupe shuffles about all of bronze; size its partitions
        # from the rows just written so that none of them spills.
        bronze_bytes = res.rows["bronze"] * estimate_row_bytes(read_parquet(spark, res.paths["bronze"]).schema)
        with sized_shuffles(spark, bronze_bytes) as n:
            res.shuffle_partitions = n
            _silver_and_gold(spark, res, silver_table, sink, hot)
    else:
        _silver_and_gold(spark, res, silver_table, sink, hot)
    return res


def _silver_and_gold(spark, res: PipelineResult, silver_table, sink, hot) -> None:
    res.rows["silver"] = run_silver(spark, res.paths["bronze"], res.paths["silver"], silver_table, hot=hot)
    res.rows.update(run_gold(spark, res.paths["silver"], res.paths["gold"], sink))
