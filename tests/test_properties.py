"""Property checks against a pure-Python brute force on random small inputs:
bronze fan-out, silver completeness and dedupe (NaN equal to NaN), mart groups,
and the average and sum of a metric."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from nimbusmart.operators.curate import curate
from nimbusmart.operators.geo import feed_bronze
from nimbusmart.operators.marts import build_mart
from nimbusmart.plans import stages

NAN = float("nan")
DATES = [dt.date(2020, 1, 1), dt.date(2020, 6, 1), dt.date(2021, 1, 1), None]
VALUES = [1.0, 2.5, 0.285, -0.125, 10.01, NAN, None]

weather_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C", None]), st.sampled_from(DATES),
              st.sampled_from(VALUES), st.sampled_from(VALUES)),
    max_size=14,
)
# cities: (city_name, country, iso3); the mart's country comes from here
city_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["Xland", "Yland", None]),
              st.sampled_from(["X", "Y", "Z"])),
    max_size=5,
)
# countries: (iso3, region); X appears twice (fan-out), Z not at all (no region)
COUNTRIES = [("X", "R1"), ("Y", None), ("X", "R2")]


def key(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def brute(weather, cities):
    geo = []
    for city, country, iso3 in cities:
        regions = [region for code, region in COUNTRIES if code == iso3]
        geo += [(city, country, r) for r in regions] or [(city, country, None)]
    bronze = []
    for city, date, temp, rain in weather:
        hits = [g for g in geo if city is not None and g[0] == city]
        for _, country, region in hits or [(None, None, None)]:
            year = date.year if date else None
            bronze.append((city, date, temp, rain, country, region, year))
    silver = {tuple(key(v) for v in r): r for r in bronze if r[0] is not None and r[1] is not None}
    groups = {}
    for r in silver.values():
        groups.setdefault((r[6], r[4], r[5], r[0]), []).append(r)
    marts = {}
    for g, rows in groups.items():
        temps = [r[2] for r in rows if r[2] is not None]  # NaN propagates
        rains = [r[3] for r in rows if r[3] is not None]
        marts[g] = (sum(temps) / len(temps) if temps else None, sum(rains) if rains else None)
    counts = {"weather": len(weather), "bronze": len(bronze), "silver": len(silver), "dm_risks": len(groups)}
    return counts, marts


@settings(max_examples=12, deadline=None, derandomize=True, phases=[Phase.explicit, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(weather=weather_rows, cities=city_rows)
def test_chain_matches_brute_force(spark, weather, cities):
    w = spark.createDataFrame(
        weather, "city_name string, date date, avg_temp_c double, precipitation_mm double"
    )
    c = spark.createDataFrame(
        [(city, country, iso3, iso3) for city, country, iso3 in cities],
        "city_name string, country string, iso3 string, iso2 string",
    )
    k = spark.createDataFrame(
        [(iso3, f"name of {iso3}", iso3, region) for iso3, region in COUNTRIES],
        "iso3 string, country string, iso2 string, region string",
    )
    want_counts, want_marts = brute(weather, cities)

    got_counts = {r.stage: r.n for r in stages.stage_counts(w, c, k).collect()}
    assert got_counts == want_counts

    mart = build_mart(curate(feed_bronze(w, c, k)), [("avg_temp_c", "avg"), ("precipitation_mm", "sum")])
    got = {(r.year, r.country, r.region, r.city_name): (r.avg_temp_c, r.precipitation_mm) for r in mart.collect()}
    assert got.keys() == want_marts.keys()
    for g, values in want_marts.items():
        for a, b in zip(got[g], values, strict=True):
            assert a == b if b is None else a == pytest.approx(b, rel=1e-12, abs=1e-9, nan_ok=True)
