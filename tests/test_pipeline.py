"""The written pipeline and the streaming bronze feed."""

import os

from helpers import SF_SMALL, canonical
from nimbusmart.functions.metrics import AGRI_RULES, TOURISM_RULES
from nimbusmart.operators.marts import project_mart
from nimbusmart.operators.serving import read_mart
from nimbusmart.plans import roles, stages
from nimbusmart.plans.pipeline import run_pipeline
from nimbusmart.plans.queries import rounded
from nimbusmart.sources.files import read_parquet


TB = 1024 ** 4


def files(folder):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(folder) for n in names)


def same(a, b):
    assert canonical(a.columns, a.collect()) == canonical(b.columns, b.collect())


def test_pipeline_writes_all_layers(spark, tmp_path):
    base = str(tmp_path / "lake")
    w, c, k = roles.weather(spark, SF_SMALL), roles.cities(spark, SF_SMALL), roles.countries(spark, SF_SMALL)
    res = run_pipeline(spark, w, c, k, base, silver_table="default.weather_silver_test")
    bronze = read_parquet(spark, res.paths["bronze"])
    silver = read_parquet(spark, res.paths["silver"])
    assert res.rows["bronze"] == bronze.count() == stages.bronze(spark, SF_SMALL).count()
    assert res.rows["silver"] == silver.count() == stages.silver(spark, SF_SMALL).count()
    same(silver, stages.silver(spark, SF_SMALL).select(*silver.columns))
    risk = read_parquet(spark, f"{res.paths['gold']}/dm_risks")
    want = stages.mart(spark, SF_SMALL).select(*risk.columns)
    same(rounded(risk), rounded(want))          # the last bits depend on the order of addition
    tourism = read_parquet(spark, f"{res.paths['gold']}/dm_tourism")
    same(tourism, project_mart(risk, TOURISM_RULES).select(*tourism.columns))
    agri = read_parquet(spark, f"{res.paths['gold']}/dm_agriculture")
    assert set(agri.columns) == {"year", "country", "region", "city_name"} | {m for m, _ in AGRI_RULES}
    assert spark.catalog.tableExists("default.weather_silver_test")
    registry = {"dm_risks": f"{res.paths['gold']}/dm_risks"}
    assert read_mart(spark, "dm_risks", year=1998, registry=registry).count() <= 100


def test_streaming_bronze_equals_batch(spark, tmp_path):
    from nimbusmart.streaming.incremental import read_bronze_stream, start_bronze_stream

    weather = roles.weather(spark, SF_SMALL)
    src = str(tmp_path / "incoming")
    weather.write.parquet(src)
    out = str(tmp_path / "bronze_stream")
    q = start_bronze_stream(spark, src, weather.schema, roles.cities(spark, SF_SMALL),
                            roles.countries(spark, SF_SMALL), out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    streamed = read_bronze_stream(spark, out)
    batch = stages.bronze(spark, SF_SMALL)
    same(streamed, batch.select(*streamed.columns))


def test_silver_table_is_registered_not_copied(spark, tmp_path):
    from nimbusmart.plans.pipeline import run_bronze, run_silver

    w, c, k = roles.weather(spark, SF_SMALL), roles.cities(spark, SF_SMALL), roles.countries(spark, SF_SMALL)
    run_bronze(w, c, k, str(tmp_path / "b"))
    n = run_silver(spark, str(tmp_path / "b"), str(tmp_path / "s"), table="default.silver_registered")
    t = spark.table("default.silver_registered")
    assert t.count() == n
    loc = [r.data_type for r in spark.sql("DESCRIBE EXTENDED default.silver_registered").collect()
           if r.col_name == "Location"][0]
    assert loc.rstrip("/").endswith("/s")
    parts = spark.sql("SHOW PARTITIONS default.silver_registered").collect()
    assert len(parts) == t.select("year").distinct().count()


def test_bronze_rows_are_weather_plus_fanout_excess(spark, duck):
    """Property: every weather row appears once per matching geo row, and once
    when nothing matches (left join)."""
    from pyspark.sql import functions as F

    weather = roles.weather(spark, SF_SMALL)
    geo_rows = stages.geo(spark, SF_SMALL).groupBy("city_name").agg(F.count(F.lit(1)).alias("k"))
    expected = (weather.join(geo_rows, "city_name", "left")
                .agg(F.sum(F.coalesce(F.col("k"), F.lit(1)))).first()[0])
    assert stages.bronze(spark, SF_SMALL).count() == expected


def test_checkpoint_dir_is_reused(spark):
    from nimbusmart.session import checkpoint_dir, scratch_path

    a = checkpoint_dir(spark)
    assert checkpoint_dir(spark) == a
    assert scratch_path(spark, "x").startswith(a + "/scratch/x-")


def test_shuffle_sizing():
    from nimbusmart.session import MAX_SHUFFLE_BLOCKS, map_split_bytes_for, shuffle_partitions_for

    assert shuffle_partitions_for(100 * TB) == 65_536                     # 1.6 GB each
    assert shuffle_partitions_for(TB) == 4096 and shuffle_partitions_for(10) == 8
    for size in (10, TB, 100 * TB, 1000 * TB):
        maps = -(-size // map_split_bytes_for(size))
        assert maps * shuffle_partitions_for(size) <= MAX_SHUFFLE_BLOCKS
    assert map_split_bytes_for(TB) == 128 * 1024 ** 2 and map_split_bytes_for(100 * TB) > 1024 ** 3


def test_checkpoint_folder_has_to_be_set_on_a_cluster(spark):
    import types

    import pytest

    from nimbusmart.session import checkpoint_dir

    def fake(master, configured=None):
        conf = types.SimpleNamespace(get=lambda k, d=None: configured)
        sc = types.SimpleNamespace(getCheckpointDir=lambda: None, master=master, getConf=lambda: conf, setCheckpointDir=lambda p: None)
        return types.SimpleNamespace(sparkContext=sc, conf=conf)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            checkpoint_dir(fake(master))
        assert checkpoint_dir(fake(master, "hdfs://nn/ckpt/")) == "hdfs://nn/ckpt"
    assert "nimbusmart-ckpt-" in checkpoint_dir(fake("local[4]"))


def naive_counts(weather, cities, countries):
    from nimbusmart.operators.curate import curate
    from nimbusmart.operators.geo import feed_bronze
    from nimbusmart.operators.marts import build_mart

    bronze = feed_bronze(weather, cities, countries)
    silver = curate(bronze)
    return {"weather": weather.count(), "bronze": bronze.count(), "silver": silver.count(),
            "dm_risks": build_mart(silver).count()}


def test_stage_counts_equal_counting_each_stage(spark):
    w, c, k = roles.weather(spark, SF_SMALL), roles.cities(spark, SF_SMALL), roles.countries(spark, SF_SMALL)
    got = {r.stage: r.n for r in stages.stage_counts(w, c, k).collect()}
    assert got == naive_counts(w, c, k)


def test_stage_counts_with_copies_homonyms_and_missing_keys(spark):
    from pyspark.sql import functions as F

    weather = spark.createDataFrame(
        [("Paris", "2020-01-01", 1.0), ("Paris", "2020-01-01", 1.0), ("Paris", "2020-01-02", 1.0),
         ("Springfield", "2020-01-01", 2.0), ("Springfield", "2020-01-01", 2.0), ("Atlantis", None, 3.0),
         (None, "2021-05-05", 4.0), ("Atlantis", "2021-05-05", float("nan")),
         ("Atlantis", "2021-05-05", float("nan"))],
        "city_name string, date string, avg_temp_c double").withColumn("date", F.to_date("date"))
    cities = spark.createDataFrame(
        [("Paris", "France", "FRA", "FR"), ("Springfield", "USA", "USA", "US"),
         ("Springfield", "Canada", "CAN", "CA"), ("Springfield", "Canada", "CAN", "CA")],
        "city_name string, country string, iso3 string, iso2 string")
    countries = spark.createDataFrame(
        [("France", "FR", "FRA", "Europe"), ("USA", "US", "USA", None), ("Canada", "CA", "CAN", "Americas")],
        "country string, iso2 string, iso3 string, region string")
    got = {r.stage: r.n for r in stages.stage_counts(weather, cities, countries).collect()}
    assert got == naive_counts(weather, cities, countries)
    assert got == {"weather": 9, "bronze": 13, "silver": 5, "dm_risks": 4}
    empty = weather.limit(0)
    assert {r.stage: r.n for r in stages.stage_counts(empty, cities, countries).collect()} == {
        "weather": 0, "bronze": 0, "silver": 0, "dm_risks": 0}


def test_stages_refuse_to_overwrite_their_input(spark, tmp_path):
    import pytest

    from nimbusmart.plans.pipeline import run_gold, run_silver
    from nimbusmart.session import check_output

    lake = str(tmp_path / "lake")
    with pytest.raises(ValueError):
        run_silver(spark, f"{lake}/bronze", f"{lake}/bronze/")          # same folder
    with pytest.raises(ValueError):
        run_gold(spark, f"{lake}/silver", f"file:{lake}")                # gold around silver
    with pytest.raises(ValueError):
        check_output(f"{lake}/silver/year=2020", f"{lake}/silver")        # inside the input
    check_output(f"{lake}/silver2", f"{lake}/silver")                     # a sibling is fine


def test_empty_silver_only_warns(spark, tmp_path, caplog):
    import logging

    from nimbusmart.plans.pipeline import run_pipeline

    weather = roles.weather(spark, SF_SMALL).limit(0)
    with caplog.at_level(logging.WARNING, logger="nimbusmart.plans.pipeline"):
        res = run_pipeline(spark, weather, roles.cities(spark, SF_SMALL), roles.countries(spark, SF_SMALL),
                           str(tmp_path / "lake"))
    assert res.rows == {"bronze": 0, "silver": 0, "dm_risks": 0, "dm_tourism": 0, "dm_agriculture": 0}
    assert "empty" in caplog.text
    agri = read_parquet(spark, f"{res.paths['gold']}/dm_agriculture")
    assert agri.count() == 0 and {"year", "city_name", "avg_temp_c"} <= set(agri.columns)


def test_shuffles_sized_for_bronze_and_settings_restored(spark):
    from pyspark.sql import types as T

    from nimbusmart.session import estimate_row_bytes, sized_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with sized_shuffles(spark, 100 * TB) as n:
        assert n == 65_536 and spark.conf.get("spark.sql.shuffle.partitions") == "65536"
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) > 1024 ** 3
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with sized_shuffles(spark, 10) as n:
        assert n >= 8                                  # small data: never below the cores
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("s", T.StringType())])
    assert estimate_row_bytes(schema) == 8 + 8 + 8 + 32


def test_stream_drains_a_backlog_in_bounded_batches(spark, tmp_path):
    from nimbusmart.streaming.incremental import read_bronze_stream, start_bronze_stream

    weather = roles.weather(spark, SF_SMALL)
    src = str(tmp_path / "incoming")
    weather.repartition(6).write.parquet(src)                 # six files
    out = str(tmp_path / "bronze_stream")
    q = start_bronze_stream(spark, src, weather.schema, roles.cities(spark, SF_SMALL),
                            roles.countries(spark, SF_SMALL), out, checkpoint=str(tmp_path / "ckpt"),
                            max_files_per_trigger=2)
    q.awaitTermination(300)
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3
    streamed = read_bronze_stream(spark, out)
    same(streamed, stages.bronze(spark, SF_SMALL).select(*streamed.columns))
    assert files(out) <= 3 * len({r.year for r in streamed.select("year").distinct().collect()})  # a file a batch and year
