"""Query registry: every implemented operator as a (spark, sf_dir) -> DataFrame
callable, with the DuckDB SQL that must give the same rows.

The driver runs each query at sf0.01 next to its SQL and compares row counts,
schemas and value hashes; column names are aliased identically on both sides.
Queries without SQL get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusmart.functions.metrics import AGRI_RULES, MART_KEYS, RISK_RULES, TOURISM_RULES
from nimbusmart.operators.marts import build_mart
from nimbusmart.plans import stages
from nimbusmart.plans.roles import ROLE_CTES

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    covers: str  # SURVEY inventory ids


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn

    return deco


def with_roles(select: str) -> str:
    return f"with {ROLE_CTES.strip()}\n{select}"


# Averages and sums are rounded on both sides of the comparison only: their last
# bits depend on the order in which rows are added.
DIGITS = 6


def rounded(mart: DataFrame, rules=RISK_RULES) -> DataFrame:
    names = {c for c, fn in rules if fn in ("avg", "sum")}
    return mart.select(*[F.round(c, DIGITS).alias(c) if c in names else F.col(c) for c in mart.columns])


def mart_sql(rules, source: str = "silver", keys: list[str] = MART_KEYS, digits: int | None = DIGITS) -> str:
    """DuckDB form of a mart."""
    inexact = ("avg", "sum") if digits is not None else ()
    exprs = [f"round({fn}({c}), {digits}) as {c}" if fn in inexact else f"{fn}({c}) as {c}" for c, fn in rules]
    k = ", ".join(keys)
    return f"select {k}, {', '.join(exprs)} from {source} group by {k}"


# --- ETL stages --------------------------------------------------------------


@register("geo_dimension", "J1 J3", with_roles("select iso3, city_name, country, iso2, region from geo"))
def q_geo_dimension(spark, sf_dir):
    return stages.geo(spark, sf_dir)


@register("feed_bronze", "T2 J2 P1 P5 F6 S1 K1", with_roles("select * from bronze"))
def q_feed_bronze(spark, sf_dir):
    return stages.bronze(spark, sf_dir)


@register("curate_silver", "T3 P10 P11 A9", with_roles("select * from silver"))
def q_curate_silver(spark, sf_dir):
    return stages.silver(spark, sf_dir)


@register("dm_risks", "A1 A2 A5 P7 T4", with_roles(mart_sql(RISK_RULES)))
def q_dm_risks(spark, sf_dir):
    return rounded(stages.mart(spark, sf_dir, "dm_risks"), RISK_RULES)


@register("dm_tourism", "A1 A3 A5 T4", with_roles(mart_sql(TOURISM_RULES)))
def q_dm_tourism(spark, sf_dir):
    return rounded(stages.mart(spark, sf_dir, "dm_tourism"), TOURISM_RULES)


@register("dm_agriculture", "A1 A4 A5 T4", with_roles(mart_sql(AGRI_RULES)))
def q_dm_agriculture(spark, sf_dir):
    return rounded(stages.mart(spark, sf_dir, "dm_agriculture"), AGRI_RULES)


_DROPPED = ["snow_depth_mm", "peak_wind_gust_kmh", "region"]


@register(
    "mart_missing_column",
    "A1",
    with_roles(
        mart_sql(
            [r for r in RISK_RULES if r[0] not in _DROPPED],
            keys=[k for k in MART_KEYS if k not in _DROPPED],
        )
    ),
)
def q_mart_missing_column(spark, sf_dir):
    return rounded(build_mart(stages.silver(spark, sf_dir).drop(*_DROPPED), RISK_RULES))


def queries() -> dict[str, QueryFn]:
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


# --- serving and views over the risk mart -------------------------------------

from nimbusmart.functions.metrics import METRIC_LABELS, label_of  # noqa: E402
from nimbusmart.functions.scalar import COMPASS_GLYPHS, COMPASS_LABELS  # noqa: E402
from nimbusmart.operators import serving, views  # noqa: E402

SERVE_YEAR = 1998
SERVE_COUNTRY = "NATION_5"


def served(spark, sf_dir, name: str = "dm_risks", rules=RISK_RULES) -> DataFrame:
    """A written mart, opened by name, as the views read it here."""
    return rounded(stages.served_mart(spark, sf_dir, name), rules)


_KEY_ORDER = ", ".join(f"{k} nulls last" for k in MART_KEYS)


def with_mart(select: str, rules=RISK_RULES, digits: int | None = DIGITS) -> str:
    return with_roles(f"select * from ({select}) q").replace(
        "\nselect * from (", f",\nm as ({mart_sql(rules, digits=digits)})\nselect * from (", 1
    )


def _latest(m: str = "m") -> str:
    return f"(select max(year) from {m})"


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def compass_sql(x: str, labels: list[str]) -> str:
    """DuckDB form of the half-even 45-degree sector lookup."""
    idx = f"(cast(round_even(((({x} % 360) + 360) % 360) / 45, 0) as integer) % 8)"
    return f"coalesce({_sql_list(labels)}[{idx} + 1], '')"


def _nan_null(x: str) -> str:
    return f"case when isnan({x}) then null else {x} end"


@register("serve_mart_year", "T5 S9 P12 L1", with_mart(
    f"select * from m where year = {SERVE_YEAR} order by {_KEY_ORDER} limit 100"))
def q_serve_mart_year(spark, sf_dir):
    """The API's read: the mart opened by name (a missing one raises
    ``MartNotFound``), optional year filter, default cap of 100 rows."""
    registry = stages.gold_registry(spark, sf_dir)
    return rounded(serving.read_mart(spark, "dm_risks", year=SERVE_YEAR, registry=registry))


@register("serve_mart_country_year", "T5 P12 L1", with_mart(
    f"select * from m where year = {SERVE_YEAR} and country = '{SERVE_COUNTRY}' "
    f"order by {_KEY_ORDER} limit 100", TOURISM_RULES))
def q_serve_mart_country_year(spark, sf_dir):
    mart = served(spark, sf_dir, "dm_tourism", TOURISM_RULES)
    return serving.serve(mart, year=SERVE_YEAR, country=SERVE_COUNTRY)


@register("serve_mart_bulk", "S10", with_mart("select * from m", AGRI_RULES))
def q_serve_mart_bulk(spark, sf_dir):
    """The dashboard's read: the whole mart, without a cap."""
    registry = stages.gold_registry(spark, sf_dir)
    return rounded(serving.read_mart(spark, "dm_agriculture", limit=None, registry=registry), AGRI_RULES)


@register("serve_mart_json", "K6", with_mart(f"select * from m where year = {SERVE_YEAR}"))
def q_serve_mart_json(spark, sf_dir):
    """JSON records of one year, parsed back with the mart's schema."""
    mart = serving.serve(served(spark, sf_dir), year=SERVE_YEAR, limit=None)
    return serving.parse_json_records(serving.as_json_records(mart), mart.schema)


@register("year_slice", "P13 T10", with_mart(f"select * from m where year = {_latest()}"))
def q_year_slice(spark, sf_dir):
    return views.year_slice(served(spark, sf_dir))


@register("mart_year_bounds", "A7 P17", with_mart(
    "select cast(min(year) as integer) as min_year, cast(max(year) as integer) as max_year from m"))
def q_mart_year_bounds(spark, sf_dir):
    return views.year_bounds(served(spark, sf_dir))


def _catalog_sql() -> str:
    keys = ", ".join(MART_KEYS)
    parts = [
        f"select {keys}, '{m}' as metric, cast({m} as double) as value, '{label_of(m)}' as label from m"
        for m, _ in RISK_RULES
    ]
    return " union all ".join(parts)


@register("metric_catalog", "P15 P16", with_mart(_catalog_sql()))
def q_metric_catalog(spark, sf_dir):
    return views.metric_catalog(served(spark, sf_dir))


NATIONAL_METRIC = "avg_temp_c"


@register("national_mean", "A6 T6 P16", with_mart(
    f'select country, round(avg({_nan_null(NATIONAL_METRIC)}), 6) as "{label_of(NATIONAL_METRIC)}" '
    f"from m where year = {_latest()} and country is not null group by country", digits=None))
def q_national_mean(spark, sf_dir):
    return views.national_mean(stages.served_mart(spark, sf_dir), NATIONAL_METRIC, digits=6)


_WIND_LABEL = METRIC_LABELS["avg_wind_dir_deg"]


@register("national_compass", "T7 F10", with_mart(
    f'select country, round(mean_dir, 6) as "{_WIND_LABEL}", {compass_sql("mean_dir", COMPASS_GLYPHS)} as "Arrow" '
    f"from (select country, avg({_nan_null('avg_wind_dir_deg')}) as mean_dir from m "
    f"where year = {_latest()} and country is not null group by country) n", digits=None))
def q_national_compass(spark, sf_dir):
    return views.national_compass(stages.served_mart(spark, sf_dir), digits=6)


@register("compass_sector", "F9 F10 F12", with_mart(
    "select year, country, region, city_name, avg_wind_dir_deg, "
    "cast(round_even((((avg_wind_dir_deg % 360) + 360) % 360) / 45, 0) as integer) % 8 as sector, "
    f'{compass_sql("avg_wind_dir_deg", COMPASS_LABELS)} as "Direction", '
    f'{compass_sql("avg_wind_dir_deg", COMPASS_GLYPHS)} as "Arrow" from m'))
def q_compass_sector(spark, sf_dir):
    mart = served(spark, sf_dir).select(*MART_KEYS, "avg_wind_dir_deg")
    return views.with_compass(mart)


@register("compass_sample", "T8 L3 P14 F11", with_mart(
    f'select *, {compass_sql("avg_wind_dir_deg", COMPASS_LABELS)} as "Direction", '
    f"city_name || ' ' || {compass_sql('avg_wind_dir_deg', COMPASS_LABELS)} as \"Label\" "
    f"from (select * from m where year = {_latest()} and avg_wind_dir_deg is not null "
    f"and not isnan(avg_wind_dir_deg) "
    f"order by country nulls last, region nulls last, city_name nulls last limit 30) s"))
def q_compass_sample(spark, sf_dir):
    return views.compass_view(served(spark, sf_dir))


TOP_METRIC = "precipitation_mm"


@register("top_cities", "T9 L2 P9", with_mart(
    f"select city_name, country, {TOP_METRIC} from m where year = {_latest()} "
    f"order by {_nan_null(TOP_METRIC)} desc nulls last, country nulls last, region nulls last, "
    f"city_name nulls last limit 15"))
def q_top_cities(spark, sf_dir):
    return views.top_cities(served(spark, sf_dir), TOP_METRIC)


# --- exercise-sheet operators over whole driver tables -------------------------

from nimbusmart.functions.scalar import array_item, composite_id, split_item  # noqa: E402
from nimbusmart.operators import harmonize, replicate, text, transforms  # noqa: E402
from nimbusmart.operators.curate import cast_metrics  # noqa: E402
from nimbusmart.operators.geo import fanout_report  # noqa: E402
from nimbusmart.plans.roles import table  # noqa: E402


@register("scan_parquet", "S1", "select * from events")
def q_scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "events")


@register("preview", "L4", "select * from orders order by o_orderkey limit 20")
def q_preview(spark, sf_dir):
    from nimbusmart.operators.inspect import preview

    return preview(table(spark, sf_dir, "orders"), 20, order_by=["o_orderkey"])


@register("text_dates", "F6 N4",
          "select o_orderkey, case when o_orderkey % 4 = 3 then null else cast(year(o_orderdate) as integer) end as year "
          "from orders")
def q_text_dates(spark, sf_dir):
    """The year of dates that arrive as text: plain, with a suffix, with a time
    and an offset, and text that holds no date."""
    from nimbusmart.functions.scalar import tolerant_year

    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    late = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-12-31T23:30:00-05:00"))
    kind = F.col("o_orderkey") % 4
    text = F.when(kind == 0, day).when(kind == 1, F.concat(day, F.lit("Tgarbage"))).when(kind == 2, late)
    dated = table(spark, sf_dir, "orders").select("o_orderkey", text.otherwise("no date").alias("date"))
    return dated.select("o_orderkey", tolerant_year(dated, "date").alias("year"))


@register("row_count", "A8", "select count(*) as n from lineitem")
def q_row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@register("pipeline_counts", "A8 T2 T3 T4", with_roles(
    "select 'weather' as stage, count(*) as n from weather union all "
    "select 'bronze', count(*) from bronze union all "
    "select 'silver', count(*) from silver union all "
    f"select 'dm_risks', count(*) from ({mart_sql(RISK_RULES)}) m"))
def q_pipeline_counts(spark, sf_dir):
    from nimbusmart.plans import roles

    return stages.stage_counts(
        roles.weather(spark, sf_dir), roles.cities(spark, sf_dir), roles.countries(spark, sf_dir)
    )


@register("rename_drop", "P4 P5",
          "select s_suppkey as datasetId, s_name as name, s_nationkey from supplier")
def q_rename_drop(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    out = transforms.rename_columns(sup, {"s_suppkey": "datasetId", "s_name": "name", "s_phone": "tel"})
    return transforms.drop_columns(out, "s_acctbal", "OBJECTID")


@register("interval_midpoint", "P6 P18 F8",
          "select l_orderkey, l_linenumber, l_discount as lcl, l_tax as ucl, "
          "(l_discount + l_tax) / 2 as avg, l_discount as lcl2, l_tax as ucl2 from lineitem")
def q_interval_midpoint(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return transforms.interval_midpoint(li, "l_discount", "l_tax")


@register("composite_id", "F1 F2 P2",
          "select c_custkey, c_mktsegment || '_' || 'Wake' || '_' || cast(c_custkey as varchar) as id "
          "from customer")
def q_composite_id(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return cust.select("c_custkey", composite_id("c_mktsegment", F.lit("Wake"), "c_custkey").alias("id"))


@register("split_item", "F3 N3",
          "select o_orderkey, string_split(o_orderpriority, '-')[2] as priority_name, "
          "string_split(o_orderpriority, '-')[6] as missing_item from orders")
def q_split_item(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        split_item("o_orderpriority", "-", 1).alias("priority_name"),
        split_item("o_orderpriority", "-", 5).alias("missing_item"),
    )


@register("array_item", "F4",
          "select vec_id, cast(embedding[1] as double) as geoX, cast(embedding[2] as double) as geoY, "
          "cast(embedding[100001] as double) as beyond from embeddings")
def q_array_item(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        array_item("embedding", 0).cast("double").alias("geoX"),
        array_item("embedding", 1).cast("double").alias("geoY"),
        array_item("embedding", 100000).cast("double").alias("beyond"),
    )


@register("numeric_try_cast", "P10 F7 N1",
          "select l_orderkey, l_linenumber, try_cast(cast(l_quantity as varchar) as double) as avg_temp_c, "
          "try_cast(cast(l_linenumber as varchar) || '.5' as double) as min_temp_c, "
          "try_cast(l_returnflag as double) as snow_depth_mm from lineitem")
def q_numeric_try_cast(spark, sf_dir):
    from nimbusmart.operators.inspect import ensure_parallelism

    # text -> double parsing is the CPU-heavy part: spread an under-split scan
    li = ensure_parallelism(table(spark, sf_dir, "lineitem")).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("string").alias("avg_temp_c"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")).alias("min_temp_c"),
        F.col("l_returnflag").alias("snow_depth_mm"),
    )
    return cast_metrics(li)


@register("union_positional", "U1",
          "select c_custkey, c_name, c_acctbal from customer union all "
          "select s_suppkey, s_name, s_acctbal from supplier")
def q_union_positional(spark, sf_dir):
    """Bag union by position: the second frame's columns take the first's names."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return cust.union(sup)


REPLICAS = 61


@register("union_replicate", "U1",
          f"select n_nationkey, n_name, n_regionkey from nation, range({REPLICAS})")
def q_union_replicate(spark, sf_dir):
    return replicate.replicate(table(spark, sf_dir, "nation"), REPLICAS)


def _restaurant_sql(county: str, src: str, key: str, parts: dict[str, str]) -> str:
    """DuckDB form of one harmonised feed; columns left out are NULL."""
    cols = []
    for f in harmonize.RESTAURANT_SCHEMA.fields[1:-1]:
        kind = "double" if f.name in ("geoX", "geoY") else "varchar"
        cols.append(f"cast({parts.get(f.name, 'null')} as {kind}) as {f.name}")
    return (
        f"select '{county}' as county, {', '.join(cols)}, "
        f"cast({parts['state']} as varchar) || '_{county}_' || cast({key} as varchar) as id from {src}"
    )


# The first feed's zip is a number, the second's a text such as "27701-1" (N2).
_WAKE_SQL = {
    "datasetId": "o_orderkey", "name": "o_orderpriority", "address1": "o_orderpriority", "address2": "o_orderstatus", "city": "'Raleigh'",
    "state": "o_orderstatus", "zip": "o_custkey", "tel": "'919-' || o_custkey", "dateStart": "strftime(o_orderdate, '%Y-%m-%d')",
    "type": "o_orderpriority", "geoX": "o_totalprice", "geoY": "o_custkey",
}
_DURHAM_SQL = {
    "datasetId": "c_custkey", "name": "c_name", "address1": "c_mktsegment", "address2": "c_name", "city": "'Durham'", "state": "c_nationkey",
    "zip": "c_custkey || '-' || c_nationkey", "tel": "'919-' || c_custkey", "dateStart": "'2011-02-02'", "dateEnd": "'2020-12-31'", "type": "c_mktsegment",
    "geoX": "c_acctbal", "geoY": "c_nationkey",
}


@register("union_by_name", "U2 U3 P2 P3 N2",
          _restaurant_sql("Wake", "orders", "o_orderkey", _WAKE_SQL) + " union all "
          + _restaurant_sql("Durham", "customer", "c_custkey", _DURHAM_SQL))
def q_union_by_name(spark, sf_dir):
    wake = harmonize.harmonize_restaurants(
        table(spark, sf_dir, "orders"),
        {"datasetId": "o_orderkey", "name": "o_orderpriority", "address1": "o_orderpriority", "address2": "o_orderstatus",
         "city": F.lit("Raleigh"), "state": "o_orderstatus", "zip": "o_custkey",
         "tel": F.concat(F.lit("919-"), F.col("o_custkey").cast("string")),
         "dateStart": F.date_format("o_orderdate", "yyyy-MM-dd"), "dateEnd": None, "type": "o_orderpriority",
         "geoX": "o_totalprice", "geoY": "o_custkey"},
        "Wake",
    )
    durham = harmonize.harmonize_restaurants(
        table(spark, sf_dir, "customer"),
        {"datasetId": "c_custkey", "name": "c_name", "address1": "c_mktsegment", "address2": "c_name",
         "city": F.lit("Durham"), "state": "c_nationkey",
         "zip": F.concat(F.col("c_custkey").cast("string"), F.lit("-"), F.col("c_nationkey").cast("string")),
         "tel": F.concat(F.lit("919-"), F.col("c_custkey").cast("string")), "dateStart": F.lit("2011-02-02"), "dateEnd": F.lit("2020-12-31"), "type": "c_mktsegment",
         "geoX": "c_acctbal", "geoY": "c_nationkey"},
        "Durham",
    )
    return harmonize.union_all_by_name([wake, durham])


@register("word_count", "A10 S8 K5",
          "select word, count(*) as n from (select unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) "
          "as word from documents) t where word <> '' group by word")
def q_word_count(spark, sf_dir):
    from nimbusmart.operators.inspect import ensure_parallelism

    counts = text.word_count(ensure_parallelism(table(spark, sf_dir, "documents")))
    return text.read_counts(spark, text.write_counts(counts, scratch_path(spark, "word-count")))


@register("join_fanout", "J2 N5",
          "select d.p_name, p.p_partkey, p.p_brand from (select distinct p_name from part) d "
          "left join part p on d.p_name = p.p_name")
def q_join_fanout(spark, sf_dir):
    from nimbusmart.operators.joins import skew_safe_left_join

    part = table(spark, sf_dir, "part")
    names = part.select("p_name").distinct()
    return skew_safe_left_join(names, part.select("p_name", "p_partkey", "p_brand"), "p_name")


@register("geo_fanout", "N5", with_roles(
    "select city_name, count(*) as geo_rows from geo where city_name is not null "
    "group by city_name having count(*) > 1"))
def q_geo_fanout(spark, sf_dir):
    return fanout_report(stages.geo(spark, sf_dir))


# --- source / sink round trips (written under the shared checkpoint folder) -----

from nimbusmart.session import scratch_path  # noqa: E402
from nimbusmart.sinks import files as sinks  # noqa: E402
from nimbusmart.sources import catalog, files as sources  # noqa: E402


def _scratch_db(spark) -> None:
    """A catalog database whose folder sits in the shared scratch location."""
    if not spark.catalog.databaseExists("nimbus_scratch"):
        catalog.create_database(spark, "nimbus_scratch", location=scratch_path(spark, "db"))


def _customer_csv(spark, sf_dir, header: bool = True) -> str:
    """customer as a folder of CSV files."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return sinks.write_csv(rows.repartition(4, "c_custkey"), scratch_path(spark, "customer-csv"), header=header)


@register("csv_header_infer", "S2 T1",
          "select cast(c_custkey as integer) as c_custkey, c_name, cast(c_nationkey as integer) as c_nationkey, c_acctbal from customer")
def q_csv_header_infer(spark, sf_dir):
    return sources.read_csv(spark, _customer_csv(spark, sf_dir))


_POSITIONAL = "cast(c_custkey as varchar) as _c0, c_name as _c1, cast(c_nationkey as varchar) as _c2 from customer"


@register("csv_positional", "S3", f"select {_POSITIONAL}")
def q_csv_positional(spark, sf_dir):
    path = _customer_csv(spark, sf_dir, header=False)
    return sources.read_csv_positional(spark, path).select("_c0", "_c1", "_c2")


@register("external_delimited", "S7 P8 C2",
          "select cast(c_custkey as integer) as NUM, rpad(c_name, 100, ' ') as NAME, cast(c_nationkey as integer) as NATION "
          "from customer")
def q_external_delimited(spark, sf_dir):
    _scratch_db(spark)
    return catalog.create_delimited_table(
        spark, "nimbus_scratch.customer_text", "NUM INT, NAME CHAR(100), NATION INT, BALANCE DOUBLE",
        _customer_csv(spark, sf_dir, header=False)
    ).select("NUM", "NAME", "NATION")


def _nested_customers(spark, sf_dir) -> str:
    """customer written as nested JSON documents shaped like the Durham feed."""
    c = table(spark, sf_dir, "customer")
    doc = c.select(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("premise_name"),
            F.col("c_nationkey").cast("string").alias("premise_state"),
            F.concat(F.col("c_mktsegment"), F.lit(" - "), F.col("c_name")).alias("type_description"),
            F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double")).alias("geolocation"),
        ).alias("fields"),
        F.col("c_custkey").cast("string").alias("recordid"),
    )
    return sinks.write_json(doc, scratch_path(spark, "customer-json"))


@register("json_nested", "S4 F3 F4 F5 U3",
          "select 'Durham' as county, cast(c_custkey as varchar) as datasetId, c_name as name, "
          "cast(null as varchar) as address1, cast(null as varchar) as address2, cast(null as varchar) as city, "
          "cast(c_nationkey as varchar) as state, cast(null as varchar) as zip, cast(null as varchar) as tel, "
          "cast(null as varchar) as dateStart, cast(null as varchar) as dateEnd, c_name as type, "
          "c_acctbal as geoX, cast(c_nationkey as double) as geoY, "
          "cast(c_nationkey as varchar) || '_Durham_' || cast(c_custkey as varchar) as id from customer")
def q_json_nested(spark, sf_dir):
    docs = sources.read_json(spark, _nested_customers(spark, sf_dir))
    spec = {
        "datasetId": "fields.id",
        "name": "fields.premise_name",
        "state": "fields.premise_state",
        "type": split_item("fields.type_description", " - ", 1),
        "geoX": array_item("fields.geolocation", 0),
        "geoY": array_item("fields.geolocation", 1),
    }
    return harmonize.harmonize_restaurants(docs, spec, "Durham")


def _orders_by_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.withColumn("year", F.year("o_orderdate").cast("int"))


@register("partitioned_roundtrip", "K1 S1 C4",
          "select *, cast(year(o_orderdate) as integer) as year from orders")
def q_partitioned_roundtrip(spark, sf_dir):
    path = sinks.write_partitioned_parquet(_orders_by_year(spark, sf_dir), scratch_path(spark, "orders-by-year"))
    return sources.read_parquet(spark, path)


def _saved_orders(spark, sf_dir):
    _scratch_db(spark)
    name = "nimbus_scratch.orders_by_year"
    sinks.save_partitioned_table(
        _orders_by_year(spark, sf_dir), name, path=scratch_path(spark, "orders-table")
    )
    return spark.table(name)


@register("saved_table_roundtrip", "K2 C2", "select *, cast(year(o_orderdate) as integer) as year from orders")
def q_saved_table_roundtrip(spark, sf_dir):
    return _saved_orders(spark, sf_dir)


PRUNED_YEAR = 1996


@register("saved_table_pruned", "K2 P12",
          f"select *, cast(year(o_orderdate) as integer) as year from orders where year(o_orderdate) = {PRUNED_YEAR}")
def q_saved_table_pruned(spark, sf_dir):
    """One partition of the saved table: the filter never opens the others."""
    return _saved_orders(spark, sf_dir).where(F.col("year") == PRUNED_YEAR)


@register("reference_load", "T1 S2", with_roles("select city_name, country, iso3, iso2 from cities"))
def q_reference_load(spark, sf_dir):
    from nimbusmart.plans import roles
    from nimbusmart.plans.pipeline import load_reference

    path = sinks.write_csv(roles.cities(spark, sf_dir), scratch_path(spark, "cities-csv"))
    return load_reference(spark, path)


@register("reference_load_countries", "T1 S2", with_roles("select country, iso2, iso3, region from countries"))
def q_reference_load_countries(spark, sf_dir):
    from nimbusmart.plans import roles
    from nimbusmart.plans.pipeline import load_reference

    path = sinks.write_csv(roles.countries(spark, sf_dir), scratch_path(spark, "countries-csv"))
    return load_reference(spark, path)


_UNDATED = 4  # every fourth order has no date


def _dated_orders(spark, sf_dir) -> DataFrame:
    """orders with the year of their date; some have none."""
    o = table(spark, sf_dir, "orders")
    dated = F.when(F.col("o_orderkey") % _UNDATED != _UNDATED - 1, F.col("o_orderdate"))
    return o.select("o_orderkey", "o_custkey", "o_totalprice", F.year(dated).cast("int").alias("year"))


_DATED_SQL = (
    f"select o_orderkey, o_custkey, o_totalprice, case when o_orderkey % {_UNDATED} <> {_UNDATED - 1} "
    "then cast(year(o_orderdate) as integer) end as year from orders"
)
GONE_YEAR, AGAIN_YEAR = 1995, 1997


@register("partitioned_overwrite", "K1 N15",
          f"select o_orderkey, o_custkey, o_totalprice * 2 as o_totalprice, year from ({_DATED_SQL}) o "
          f"where year is distinct from {GONE_YEAR}")
def q_partitioned_overwrite(spark, sf_dir):
    """A second write replaces the whole dataset: its NULL partition, and a year
    that the second one lacks."""
    path = scratch_path(spark, "orders-overwritten")
    orders = _dated_orders(spark, sf_dir)
    sinks.write_partitioned_parquet(orders, path)
    second = orders.where(~F.col("year").eqNullSafe(GONE_YEAR)).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.write_partitioned_parquet(second, path)
    return sources.read_parquet(spark, path)


@register("partitioned_replace", "K1",
          "select o_orderkey, o_custkey, case when year is null or year = " + str(AGAIN_YEAR) +
          f" then -o_totalprice else o_totalprice end as o_totalprice, year from ({_DATED_SQL}) o")
def q_partitioned_replace(spark, sf_dir):
    """A dynamic overwrite replaces the partitions it writes, here one year and the
    NULL partition, and leaves the others."""
    path = scratch_path(spark, "orders-replaced")
    orders = _dated_orders(spark, sf_dir)
    sinks.write_partitioned_parquet(orders, path)
    again = orders.where(F.col("year").isNull() | (F.col("year") == AGAIN_YEAR))
    again = again.withColumn("o_totalprice", -F.col("o_totalprice"))
    sinks.write_partitioned_parquet(again, path, dynamic_overwrite=True)
    return sources.read_parquet(spark, path)


@register("table_partitions", "K2 C1", f"select distinct year from ({_DATED_SQL}) o")
def q_table_partitions(spark, sf_dir):
    """The partitions of a saved table, from the catalog; no file is opened."""
    _scratch_db(spark)
    name = "nimbus_scratch.orders_dated"
    sinks.save_partitioned_table(_dated_orders(spark, sf_dir), name, path=scratch_path(spark, "orders-dated"))
    return catalog.list_partitions(spark, name)


def _messy_customers(spark, sf_dir) -> str:
    """customer as delimited text with its header line among the rows, cells that
    are no numbers, empty cells and rows that end early."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    num = F.when(key % 7 == 0, F.lit("n/a")).otherwise(key.cast("string"))
    balance = F.when(key % 11 == 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))
    line = F.concat_ws(",", num, "c_name", F.when(key % 13 != 0, balance))
    header = spark.createDataFrame([("NUM,NAME,NATION",)], "value string")
    path = scratch_path(spark, "customer-text")
    c.select(line.alias("value")).unionAll(header).write.text(path)
    return path


_NUM_CELL = "case when c_custkey % 7 = 0 then {} else {} end"
_NATION_CELL = "case when c_custkey % 13 = 0 or c_custkey % 11 = 0 then null else {} end"


@register("external_bad_cells", "S7 N1",
          f"select {_NUM_CELL.format('null', 'cast(c_custkey as integer)')} as NUM, rpad(c_name, 100, ' ') as NAME, "
          f"{_NATION_CELL.format('cast(c_nationkey as integer)')} as NATION from customer "
          "union all select null, rpad('NAME', 100, ' '), null")
def q_external_bad_cells(spark, sf_dir):
    """Text typed by DDL: what does not parse is NULL, the header line's cells too."""
    _scratch_db(spark)
    return catalog.create_delimited_table(
        spark, "nimbus_scratch.customer_messy", "NUM INT, NAME CHAR(100), NATION INT", _messy_customers(spark, sf_dir)
    )


@register("csv_positional_header", "S3",
          f"select {_NUM_CELL.format(chr(39) + 'n/a' + chr(39), 'cast(c_custkey as varchar)')} as _c0, c_name as _c1, "
          f"{_NATION_CELL.format('cast(c_nationkey as varchar)')} as _c2 from customer union all select 'NUM', 'NAME', 'NATION'")
def q_csv_positional_header(spark, sf_dir):
    """By position, the header line is a row like the others."""
    return sources.read_csv_positional(spark, _messy_customers(spark, sf_dir), n_columns=3)


@register("write_counts", "A8 T2 T3 T4", with_roles(
    "select 'bronze' as stage, count(*) as n from bronze union all select 'silver', count(*) from silver union all "
    + " union all ".join(f"select '{name}', count(*) from ({mart_sql(rules)}) {name}" for name, rules in
                         (("dm_risks", RISK_RULES), ("dm_tourism", TOURISM_RULES), ("dm_agriculture", AGRI_RULES)))))
def q_write_counts(spark, sf_dir):
    """What the writes of the pipeline counted themselves, a row a stage."""
    return stages.written_counts(spark, sf_dir)


def _mode_sql(mode: str, bounds: bool) -> str:
    more = "(l_discount + l_tax) / 2 as avg, l_discount as lcl2, l_tax as ucl2" if bounds else "null as avg, null as lcl2, null as ucl2"
    return f"select '{mode}' as mode, l_orderkey, l_linenumber, l_discount as lcl, l_tax as ucl, {more} from lineitem"


@register("interval_midpoint_modes", "P18 P5 P6 F8",
          " union all ".join([_mode_sql("", True), _mode_sql("noop", False), _mode_sql("full", False)]))
def q_interval_midpoint_modes(spark, sf_dir):
    """The chain in its three modes; a mode that leaves columns out has NULL there."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    made = [transforms.interval_midpoint(li, "l_discount", "l_tax", m).withColumn("mode", F.lit(m)) for m in ("", "noop", "full")]
    return harmonize.union_all_by_name(made, allow_missing=True)


_SPARK_TYPES = "case {} when 'BIGINT' then 'long' when 'INTEGER' then 'integer' when 'DOUBLE' then 'double' " \
               "when 'VARCHAR' then 'string' when 'DATE' then 'date' when 'TIMESTAMP' then 'timestamp_ntz' else {} end"
_LINEITEM = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
             "l_linestatus l_shipdate").split()


def _schema_sql() -> str:
    kind = lambda c: _SPARK_TYPES.format(f"typeof(any_value({c}))", f"typeof(any_value({c}))")
    return " union all ".join(
        f"select {i} as position, '{c}' as name, {kind(c)} as type, true as nullable, count(*) as n_rows, "
        f"count({c}) as n_values from lineitem" for i, c in enumerate(_LINEITEM)
    )


@register("schema_export", "K4 C7", _schema_sql())
def q_schema_export(spark, sf_dir):
    """A table's schema JSON as rows, with the values that each column holds."""
    return sinks.schema_rows(table(spark, sf_dir, "lineitem").select(*_LINEITEM))
