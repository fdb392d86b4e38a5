"""Every registered query against its DuckDB oracle (sf0.001 for speed; the
driver and tools/check_oracle.py run the same pairs at sf0.01)."""

import pytest

import __spark_entry__ as entry_module
from helpers import SF_SMALL, canonical
from nimbusmart.plans import queries as registry

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 44
    assert QUERIES.keys() <= entry_module.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = canonical(df.columns, df.collect())
    rel = duck.sql(ORACLES[name])
    d_cols, d_rows = canonical(rel.columns, rel.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    first = df.schema
    assert df.count() > 0
    assert entry_module.entry(spark).schema == first


def test_json_records_keep_null_fields(spark):
    import json

    from nimbusmart.operators.serving import as_json_records, parse_json_records

    mart = spark.createDataFrame([(2020, None, 1.0), (2021, "France", None)], "year int, country string, v double")
    records = as_json_records(mart)
    assert [json.loads(r["json"]) for r in records.collect()] == [
        {"year": 2020, "country": None, "v": 1.0}, {"year": 2021, "country": "France", "v": None}]
    assert parse_json_records(records, mart.schema).collect() == mart.collect()


def test_bulk_read_has_no_cap(spark, tmp_path):
    from nimbusmart.operators.serving import read_mart

    n = 200_000
    spark.range(n).selectExpr("cast(2000 + id % 20 as int) as year", "cast(id as string) as city_name").write.parquet(f"{tmp_path}/m")
    assert read_mart(spark, "m", limit=None, registry={"m": f"{tmp_path}/m"}).count() == n
    assert read_mart(spark, "m", registry={"m": f"{tmp_path}/m"}).count() == 100
