"""Physical-plan checks: broadcast, partial aggregation, pruning, top-k."""

from pyspark.sql import functions as F

from helpers import SF_SMALL
from nimbusmart.operators import replicate, views
from nimbusmart.plans import roles, stages
from nimbusmart.plans.profile import explain_text
from nimbusmart.sinks.files import write_partitioned_parquet
from nimbusmart.sources.files import read_parquet


def test_bronze_broadcasts_the_geo_side(spark):
    plan = explain_text(stages.bronze(spark, SF_SMALL))
    assert "BroadcastHashJoin LeftOuter" in plan
    assert "SortMergeJoin" not in plan


def test_scan_prunes_columns(spark):
    plan = explain_text(stages.mart(spark, SF_SMALL))
    lineitem_schemas = [l for l in plan.splitlines() if l.startswith("ReadSchema: struct<l_")]
    assert lineitem_schemas
    for s in lineitem_schemas:
        assert "l_tax" not in s and "l_discount" not in s


def test_dedupe_and_mart_aggregate_partially_before_shuffle(spark):
    plan = explain_text(stages.mart(spark, SF_SMALL))
    tree = plan.split("\n\n")[0]
    # partial dedupe -> exchange -> final dedupe + partial mart -> exchange -> final mart
    assert tree.count("HashAggregate") == 4
    grouped = [l for l in plan.splitlines()
               if l.startswith("Arguments: hashpartitioning(") and "ENSURE_REQUIREMENTS" in l]
    assert len(grouped) == 2


def test_year_slice_prunes_partitions(spark, tmp_path):
    mart = stages.mart(spark, SF_SMALL)
    path = write_partitioned_parquet(mart, str(tmp_path / "risk"))
    plan = explain_text(views.year_slice(read_parquet(spark, path), 1998))
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1998)" in plan


def test_latest_year_is_a_scalar_subquery(spark):
    plan = explain_text(views.year_slice(stages.mart(spark, SF_SMALL)))
    assert "Subquery" in plan


def test_top_cities_is_top_k(spark):
    plan = explain_text(views.top_cities(stages.mart(spark, SF_SMALL), "precipitation_mm", year=1998))
    assert "TakeOrderedAndProject" in plan


def test_replicate_is_one_scan(spark):
    plan = explain_text(replicate.replicate(roles.table(spark, SF_SMALL, "nation"), 61))
    assert "Union" not in plan and "Generate" in plan and "Exchange" not in plan
    assert plan.split("\n\n")[0].count("Scan parquet") == 1


def test_word_count_partial_aggregation(spark):
    from nimbusmart.operators.text import word_count

    plan = explain_text(word_count(roles.table(spark, SF_SMALL, "documents")))
    assert "partial_count" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_write_row_count_is_observed_above_the_exchange(spark):
    from pyspark.sql import Observation

    df = stages.bronze(spark, SF_SMALL).hint("rebalance", "year")
    tree = explain_text(df.observe(Observation("x"), F.count(F.lit(1)).alias("rows"))).split("\n\n")[0]
    lines = tree.splitlines()
    metrics = next(i for i, l in enumerate(lines) if "CollectMetrics" in l)
    exchange = next(i for i, l in enumerate(lines) if "- Exchange (" in l)
    assert metrics < exchange          # printed above = runs after the shuffle, in the result stage


def test_weather_role_reads_lineitem_once(spark):
    tree = explain_text(roles.weather(spark, SF_SMALL)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Union" not in tree and "Generate" in tree


def test_views_of_a_written_mart_prune_partitions_and_columns(spark):
    """The served mart is a scan of the written files: the year is a partition
    filter, only the view's columns are read, and no fact table is touched."""
    from nimbusmart.plans.queries import REGISTRY

    stages.gold_registry(spark, SF_SMALL)
    for name in ("year_slice", "serve_mart_year"):
        plan = explain_text(REGISTRY[name].fn(spark, SF_SMALL))
        assert "PartitionFilters: [isnotnull(year" in plan and "lineitem" not in plan
    plan = explain_text(REGISTRY["top_cities"].fn(spark, SF_SMALL))
    assert "lineitem" not in plan
    schema = next(l for l in plan.splitlines() if l.startswith("ReadSchema: struct<country"))
    assert "precipitation_mm" in schema and "avg_temp_c" not in schema


def test_building_a_view_runs_no_job_on_the_fact_table(spark):
    from nimbusmart.plans.queries import REGISTRY

    paths = stages.gold_registry(spark, SF_SMALL)
    assert stages.gold_registry(spark, SF_SMALL) == paths
    spark.sparkContext.setJobGroup("building-a-view", "no job may scan lineitem here")
    try:
        REGISTRY["national_mean"].fn(spark, SF_SMALL)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building-a-view")
    assert len(jobs) <= 1  # at most the listing of the mart's schema


def test_stage_counts_scan_the_fact_table_twice(spark):
    plan = explain_text(stages.stage_counts(
        roles.weather(spark, SF_SMALL), roles.cities(spark, SF_SMALL), roles.countries(spark, SF_SMALL)))
    scans = [l for l in plan.splitlines() if l.startswith("Location") and "lineitem.parquet" in l]
    assert len(scans) == 2          # weather count + the one pass over the chain
    tree = plan.split("\n\n")[0]
    assert "CartesianProduct" not in tree and "BroadcastNestedLoopJoin" not in tree


def test_phase_profile_times_the_action_not_the_plan(spark):
    from nimbusmart.plans.profile import Phases, run_action

    phases = Phases()
    with phases.phase("build"):
        df = stages.mart(spark, SF_SMALL)
    with phases.phase("action"):
        run_action(df)
    assert list(phases.timings) == ["build", "action"]
    assert phases.timings["action"] > 0 and phases.total() >= sum(phases.timings.values()) - 1e-3


def test_compass_sample_is_top_k(spark):
    plan = explain_text(views.compass_view(stages.mart(spark, SF_SMALL), year=1998))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_bronze_above_the_broadcast_bound_is_a_shuffle_join_with_equal_rows(spark):
    from helpers import canonical
    from nimbusmart.operators.geo import feed_bronze

    w, c, k = roles.weather(spark, SF_SMALL), roles.cities(spark, SF_SMALL), roles.countries(spark, SF_SMALL)
    small = feed_bronze(w, c, k)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = feed_bronze(w, c, k, max_broadcast_bytes=1)
        plan = explain_text(big)
        assert "SortMergeJoin LeftOuter" in plan and "BroadcastHashJoin LeftOuter" not in plan
        assert canonical(big.columns, big.collect()) == canonical(small.columns, small.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
