"""Golden micro-fixtures for the semantics that decide correctness."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.functions import scalar
from nimbusmart.functions.metrics import AGRI_RULES, RISK_RULES, TOURISM_RULES, label_of, metric_of
from nimbusmart.operators import curate, geo, harmonize, marts, replicate, serving, text, transforms, views

NAN = float("nan")


def brute_sector(deg):
    """Brute-force oracle: Python's round() is half-even."""
    if deg is None or math.isnan(deg):
        return None
    return int(round((deg % 360) / 45.0)) % 8


ANGLES = [0.0, 22.5, 22.6, 45.0, 67.5, 112.5, 157.5, 180.0, 202.5, 247.5, 337.5, 359.9, 360.0,
          -10.0, -22.5, 720.1, 1e6 + 0.5, None, NAN]


def test_compass_matches_brute_force(spark):
    df = spark.createDataFrame([(a,) for a in ANGLES], "deg double")
    rows = df.select("deg", scalar.compass_index("deg").alias("i"),
                     scalar.compass_name("deg").alias("name"),
                     scalar.compass_glyph("deg").alias("glyph")).collect()
    for r in rows:
        want = brute_sector(r["deg"])
        assert r["i"] == want, r
        if want is None:
            assert r["name"] == "" and r["glyph"] == ""
        else:
            assert r["name"] == scalar.COMPASS_LABELS[want]
            assert r["glyph"] == scalar.COMPASS_GLYPHS[want]


def test_half_even_at_22_5_is_north(spark):
    r = spark.range(1).select(scalar.compass_name(F.lit(22.5)).alias("d")).first()
    assert r["d"].endswith(" N")


def test_try_double_never_fails(spark):
    vals = ["1.5", "abc", "", None, "1e3", " 2 ", "27701-1"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(scalar.try_double("s")).collect()]
    assert got == [1.5, None, None, None, 1000.0, 2.0, None]


def test_split_and_array_items_out_of_range_are_null(spark):
    df = spark.createDataFrame([("Food - Restaurant", [1.0, 2.0]), ("Nothing", [3.0])],
                               "t string, g array<double>")
    got = df.select(scalar.split_item("t", " - ", 1).alias("x"),
                    scalar.array_item("g", 1).alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [("Restaurant", 2.0), (None, None)]


def test_composite_id_propagates_null(spark):
    df = spark.createDataFrame([("NC", "Wake", "1"), ("NC", None, "2")], "a string, b string, c string")
    got = [r[0] for r in df.select(scalar.composite_id("a", "b", "c")).collect()]
    assert got == ["NC_Wake_1", None]


def test_tolerant_year_on_text(spark):
    df = spark.createDataFrame([("2024-03-01",), ("garbage",), (None,)], "date string")
    got = [r[0] for r in df.select(scalar.tolerant_year(df, "date")).collect()]
    assert got == [2024, None, None]


def weather_rows(spark, rows):
    schema = ("city_name string, date string, station_id long, avg_temp_c string, "
              "precipitation_mm double, avg_wind_dir_deg double")
    return spark.createDataFrame(rows, schema)


def test_curate_casts_drops_and_dedupes(spark):
    df = weather_rows(spark, [
        ("Paris", "2020-01-01", 1, "1.5", 2.0, 10.0),
        ("Paris", "2020-01-01", 1, "1.5", 2.0, 10.0),      # duplicate
        ("Paris", None, 1, "2.5", 2.0, 10.0),               # no date
        ("Lyon", "2020-01-02", 2, "n/a", -0.0, NAN),        # bad text, -0.0, NaN
        ("Lyon", "2020-01-02", 2, "n/a", 0.0, NAN),         # same as above
    ]).withColumn("year", F.year(F.to_date("date")))
    out = curate.curate(df)
    assert out.schema["avg_temp_c"].dataType == T.DoubleType()
    rows = sorted(out.collect(), key=lambda r: r.city_name)
    assert len(rows) == 2
    assert rows[0].avg_temp_c is None
    # idempotent
    assert curate.curate(out).count() == 2


def test_cast_metrics_only_touches_present_columns(spark):
    df = spark.createDataFrame([("1", "x")], "avg_temp_c string, other string")
    out = curate.cast_metrics(df)
    assert out.schema["avg_temp_c"].dataType == T.DoubleType()
    assert out.schema["other"].dataType == T.StringType()


def silver_rows(spark):
    schema = ("year int, country string, region string, city_name string, avg_temp_c double, "
              "min_temp_c double, max_temp_c double, precipitation_mm double, snow_depth_mm double, "
              "avg_wind_dir_deg double, avg_wind_speed_kmh double, peak_wind_gust_kmh double, "
              "avg_sea_level_pres_hpa double, sunshine_total_min double")
    rows = [
        (2020, "FR", "EU", "Paris", 10.0, 1.0, 20.0, 5.0, None, 350.0, 10.0, 50.0, 1010.0, 60.0),
        (2020, "FR", "EU", "Paris", 20.0, -1.0, 25.0, 7.0, None, 10.0, 20.0, 70.0, 1020.0, 30.0),
        (2020, "FR", "EU", "Lyon", 15.0, 2.0, 18.0, 1.0, 3.0, 90.0, 5.0, 20.0, 1000.0, 10.0),
        (2020, None, None, "Nowhere", 99.0, 9.0, 99.0, 9.0, 9.0, 180.0, 9.0, 9.0, 999.0, 9.0),
        (2021, "DE", "EU", "Berlin", 5.0, -5.0, 10.0, 2.0, 1.0, 200.0, 30.0, 80.0, 1005.0, 40.0),
    ]
    return spark.createDataFrame(rows, schema)


def test_risk_mart_values(spark):
    m = {r.city_name: r for r in marts.build_mart(silver_rows(spark), RISK_RULES).collect()}
    p = m["Paris"]
    assert (p.avg_temp_c, p.min_temp_c, p.max_temp_c, p.precipitation_mm) == (15.0, -1.0, 25.0, 12.0)
    assert p.snow_depth_mm is None                  # all-NULL group -> NULL
    assert p.avg_wind_dir_deg == 180.0              # arithmetic mean of 350 and 10 (N10)
    assert m["Nowhere"].country is None             # unmatched city kept (N6)


def test_marts_lose_no_value(spark):
    """NaN propagates, large values count, and what is below a cent stays."""
    rows = [("nan", 1.0), ("nan", NAN), ("large", 1e17), ("large", 3.0), ("small", 0.004), ("small", 0.004), ("null", None)]
    df = spark.createDataFrame(rows, "city_name string, avg_temp_c double")
    total = {r.city_name: r.avg_temp_c for r in marts.build_mart(df, [("avg_temp_c", "sum")]).collect()}
    assert math.isnan(total["nan"]) and total["large"] == 1e17 + 3 and total["small"] == 0.008 and total["null"] is None
    mean = {r.city_name: r.avg_temp_c for r in marts.build_mart(df, [("avg_temp_c", "avg")]).collect()}
    assert math.isnan(mean["nan"]) and mean["small"] == 0.004 and mean["null"] is None


def test_marts_share_one_aggregate_and_project(spark):
    s = silver_rows(spark)
    built = marts.build_marts(s)
    for name, rules in [("dm_risks", RISK_RULES), ("dm_tourism", TOURISM_RULES), ("dm_agriculture", AGRI_RULES)]:
        direct = marts.build_mart(s, rules)
        assert built[name].columns == direct.columns
        assert sorted(built[name].collect(), key=repr) == sorted(direct.collect(), key=repr)


def test_mart_rules_on_missing_columns_are_skipped(spark):
    s = silver_rows(spark).drop("region", "snow_depth_mm")
    out = marts.build_mart(s, RISK_RULES)
    assert "region" not in out.columns and "snow_depth_mm" not in out.columns
    assert out.columns[:3] == ["year", "country", "city_name"]


def test_mart_errors(spark):
    s = silver_rows(spark)
    with pytest.raises(ValueError):
        marts.build_mart(s, [("avg_temp_c", "median")])
    with pytest.raises(ValueError):
        marts.build_mart(s.select("year", "country"), RISK_RULES)


def test_invariants_min_avg_max_and_sum(spark):
    s = silver_rows(spark)
    m = marts.build_mart(s, RISK_RULES)
    bad = m.where(~((F.col("min_temp_c") <= F.col("max_temp_c")))).count()
    assert bad == 0
    total_mart = m.agg(F.sum("precipitation_mm")).first()[0]
    total_silver = s.agg(F.sum("precipitation_mm")).first()[0]
    assert total_mart == total_silver


def test_national_mean_nan_null_and_missing_country(spark):
    mart = spark.createDataFrame(
        [(2020, "FR", "Paris", 10.0), (2020, "FR", "Lyon", NAN), (2020, "DE", "Berlin", None),
         (2020, None, "Nowhere", 50.0), (2019, "FR", "Paris", 99.0)],
        "year int, country string, city_name string, avg_temp_c double")
    out = {r[0]: r[1] for r in views.national_mean(mart, "avg_temp_c").collect()}
    assert out == {"FR": 10.0, "DE": None}
    assert views.national_mean(mart, "avg_temp_c").columns == ["country", label_of("avg_temp_c")]


def test_top_cities_missing_last_and_short_input(spark):
    mart = spark.createDataFrame(
        [(2020, "FR", "EU", "A", 1.0), (2020, "FR", "EU", "B", NAN), (2020, "FR", "EU", "C", None),
         (2020, "FR", "EU", "D", 5.0)],
        "year int, country string, region string, city_name string, precipitation_mm double")
    got = [r.city_name for r in views.top_cities(mart, "precipitation_mm", n=15).collect()]
    assert got[:2] == ["D", "A"] and sorted(got[2:]) == ["B", "C"]


def test_year_slice_default_and_without_year(spark):
    mart = silver_rows(spark)
    assert {r.year for r in views.year_slice(mart).collect()} == {2021}
    assert views.year_slice(mart.drop("year")).count() == 5
    b = views.year_bounds(mart).first()
    assert (b.min_year, b.max_year) == (2020, 2021)


def test_metric_catalog_and_labels(spark):
    mart = marts.build_mart(silver_rows(spark), AGRI_RULES)
    cat = views.metric_catalog(mart)
    assert cat.count() == mart.count() * 5
    assert {r.label for r in cat.select("label").distinct().collect()} == {label_of(m) for m, _ in AGRI_RULES}
    assert label_of("unknown_metric") == "unknown_metric"
    assert metric_of(label_of("precipitation_mm"), ["avg_temp_c", "precipitation_mm"]) == "precipitation_mm"


def test_compass_view_sample(spark):
    mart = silver_rows(spark).withColumn(
        "avg_wind_dir_deg", F.when(F.col("city_name") == "Lyon", F.lit(None)).otherwise(F.col("avg_wind_dir_deg")))
    rows = views.compass_view(mart, year=2020, n=30).collect()
    assert {r.city_name for r in rows} == {"Paris", "Nowhere"}
    for r in rows:
        assert r.Label == f"{r.city_name} {r.Direction}"


def test_serving_filters_and_not_found(spark):
    mart = silver_rows(spark)
    assert serving.serve(mart, year=2020, country="FR").count() == 3
    assert serving.serve(mart.drop("country"), year=2020, country="FR").count() == 4  # skipped filter
    assert serving.serve(mart, limit=2).count() == 2
    with pytest.raises(serving.MartNotFound):
        serving.open_mart(spark, "no_such_mart_anywhere")


def test_homonym_fanout_and_unmatched_city(spark):
    weather = spark.createDataFrame(
        [("Paris", "2020-01-01", 1.0), ("Springfield", "2020-01-01", 2.0), ("Atlantis", "2020-01-01", 3.0)],
        "city_name string, date string, avg_temp_c double").withColumn("date", F.to_date("date"))
    cities = spark.createDataFrame(
        [("Paris", "France", "FRA", "FR"), ("Springfield", "USA", "USA", "US"),
         ("Springfield", "Canada", "CAN", "CA")], "city_name string, country string, iso3 string, iso2 string")
    countries = spark.createDataFrame(
        [("France", "FR", "FRA", "Europe"), ("USA", "US", "USA", "Americas"), ("Canada", "CA", "CAN", "Americas")],
        "country string, iso2 string, iso3 string, region string")
    bronze = geo.feed_bronze(weather, cities, countries)
    assert set(bronze.columns) >= {"city_name", "date", "avg_temp_c", "country", "region", "year"}
    assert not {"iso2", "iso3"} & set(bronze.columns)
    rows = bronze.collect()
    assert len(rows) == 4                                           # Springfield twice
    assert [r.country for r in rows if r.city_name == "Atlantis"] == [None]
    report = {r.city_name: r.geo_rows for r in geo.fanout_report(geo.geo_dimension(cities, countries)).collect()}
    assert report == {"Springfield": 2}


def test_broadcast_bound_is_in_bytes(spark):
    assert geo.broadcastable(spark.range(10), max_bytes=1000)
    assert not geo.broadcastable(spark.range(100), max_bytes=1000)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 500).alias("t"))  # few rows, many bytes
    assert not geo.broadcastable(wide, max_bytes=1000) and geo.broadcastable(wide, max_bytes=10_000)
    assert not geo.broadcastable(spark.range(1), max_bytes=0)


def test_interval_midpoint_modes(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "lo double, hi double")
    assert transforms.interval_midpoint(df, "lo", "hi").first().avg == 2.0
    assert transforms.interval_midpoint(df, "lo", "hi", "noop").columns == ["lcl", "ucl"]
    assert transforms.interval_midpoint(df, "lo", "hi", "FULL").columns == ["lcl", "ucl"]
    with pytest.raises(ValueError):
        transforms.interval_midpoint(df, "lo", "hi", "other")


def test_rename_and_drop_ignore_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = transforms.drop_columns(transforms.rename_columns(df, {"a": "x", "zz": "y"}), "b", "nope")
    assert out.columns == ["x"]


def test_replicate_counts_and_copy_column(spark):
    df = spark.range(7)
    assert replicate.replicate(df, 61).count() == 7 * 61
    assert replicate.union_copies(df, 61).count() == 7 * 61
    copies = replicate.replicate(df, 3, "copy").groupBy("copy").count().collect()
    assert sorted((r["copy"], r["count"]) for r in copies) == [(0, 7), (1, 7), (2, 7)]


def test_word_count_separators(spark):
    df = spark.createDataFrame([("a b\tb\n\nc\r\fa  ",), ("A a",), (None,)], "text string")
    got = {r.word: r.n for r in text.word_count(df).collect()}
    assert got == {"a": 3, "b": 2, "c": 1, "A": 1}


def test_harmonized_union_of_unlike_types(spark):
    a = spark.createDataFrame([(27701, "x")], "zip int, name string")
    b = spark.createDataFrame([("27701-1", "y")], "zip string, name string")
    spec_a = {"zip": "zip", "name": "name", "state": F.lit("NC")}
    spec_b = {"zip": "zip", "name": "name", "state": F.lit("NC")}
    u = harmonize.union_all_by_name([
        harmonize.harmonize_restaurants(a, spec_a, "Wake"),
        harmonize.harmonize_restaurants(b, spec_b, "Durham")])
    assert u.columns == harmonize.RESTAURANT_SCHEMA.names
    assert sorted(r.zip for r in u.collect()) == ["27701", "27701-1"]
    with pytest.raises(ValueError):
        harmonize.harmonize(a, {"nope": "zip"}, harmonize.RESTAURANT_SCHEMA)


def test_skew_safe_left_join_equals_left_join(spark):
    from nimbusmart.operators.joins import hot_keys, skew_safe_left_join
    from helpers import canonical

    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4), ("a", 5)], "k string, l int")
    hot = [("a", i % 3) for i in range(300)]          # one hot key, many identical copies
    right = spark.createDataFrame(hot + [("b", 7), ("b", 8), (None, 9)], "k string, r int")
    want = left.join(right, "k", "left")
    assert hot_keys(right, "k") == ["a"] and hot_keys(right, "k", share=0.999) == []
    for got in (skew_safe_left_join(left, right, "k", salts=4), skew_safe_left_join(left, right, "k", hot=[]),
                skew_safe_left_join(left, right, "k", hot=["a", "b"], salts=3)):
        assert canonical(got.columns, got.collect()) == canonical(want.columns, want.collect())


def test_skew_safe_left_join_holds_one_key_with_very_many_copies(spark):
    from nimbusmart.operators.joins import skew_safe_left_join

    n = 20_000_000
    left = spark.createDataFrame([("a", 1), ("z", 2)], "k string, l int")
    right = spark.range(n).select(F.lit("a").alias("k"), F.lit(7).alias("r"))
    out = skew_safe_left_join(left, right, "k").groupBy("k", "l").agg(F.count("r").alias("n"))
    assert sorted(map(tuple, out.collect())) == [("a", 1, n), ("z", 2, 0)]


def test_year_of_text_dates(spark):
    """The leading date counts, whatever follows; the offset doesn't move it."""
    values = ["2024-03-01", "2024-03-01Tgarbage", "2024-03-01 xx", "2024-12-31T23:30:00-05:00", "2024-12-31 23:59:59", "no date", "", None]
    df = spark.createDataFrame([(v,) for v in values], "date string")
    got = [r[0] for r in df.select(scalar.tolerant_year(df, "date")).collect()]
    assert got == [2024, 2024, 2024, 2024, 2024, None, None, None]


def test_city_views_need_a_city_column(spark):
    mart = silver_rows(spark).drop("city_name")
    with pytest.raises(ValueError):
        views.top_cities(mart, "precipitation_mm")
    with pytest.raises(ValueError):
        views.compass_view(mart)
