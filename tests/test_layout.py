"""Silver in one move, replaced partitions, counts of writes, reuse of written results."""

import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, canonical
from nimbusmart.functions.metrics import METRIC_COLUMNS
from nimbusmart.operators import curate as C
from nimbusmart.plans import pipeline, roles, stages
from nimbusmart.plans.profile import explain_text
from nimbusmart.plans.reuse import input_stamp, reused
from nimbusmart.session import estimate_row_bytes, spread_shuffles
from nimbusmart.sinks.files import save_partitioned_table, schema_rows, write_partitioned_parquet
from nimbusmart.sources.catalog import create_delimited_table, list_partitions
from nimbusmart.sources.files import partition_bytes, read_csv_positional, read_parquet


def same(a, b):
    assert canonical(a.columns, a.collect()) == canonical(b.columns, b.collect())


def exchanges(df):
    return explain_text(df).split("\n\n")[0].count("Exchange")


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "bronze")
    inputs = [f(spark, SF_SMALL) for f in (roles.weather, roles.cities, roles.countries)]
    rows, hot = pipeline.write_bronze(*inputs, path)
    assert rows == read_parquet(spark, path).count() and hot == []
    return path


def test_silver_is_one_shuffle_of_the_rows(spark, bronze):
    df = read_parquet(spark, bronze)
    silver = C.curate_by_year(df, pipeline.silver_layout(spark, bronze))
    assert exchanges(silver) == 1
    tree = explain_text(silver).split("\n\n")[0]
    # Both halves of the distinct lie above the one exchange, by year.
    assert tree.index("HashAggregate") < tree.index("Exchange") and "REPARTITION_BY_COL" in explain_text(silver)
    same(silver, C.curate(df).select(*silver.columns))


def test_silver_write_adds_no_exchange(spark, bronze, tmp_path, monkeypatch):
    seen = []
    write = pipeline.write_partitioned_parquet
    monkeypatch.setattr(pipeline, "write_partitioned_parquet", lambda df, *a, **k: (seen.append((df, k["laid_out"])), write(df, *a, **k)))
    out = str(tmp_path / "silver")
    rows = pipeline.run_silver(spark, bronze, out)
    (df, laid_out), = seen
    assert laid_out and exchanges(df) == 1 and rows == read_parquet(spark, out).count()


def test_parts_spread_a_year_and_copies_stay_together(spark, bronze):
    df = read_parquet(spark, bronze)
    years = [r["year"] for r in df.select("year").distinct().collect() if r["year"] is not None]
    silver = C.curate_by_year(df, {y: 5 for y in years})
    same(silver, C.curate(df).select(*silver.columns))


@pytest.fixture(scope="module")
def crowded(spark, bronze, tmp_path_factory):
    """bronze and 5000 copies of one of its rows; the row's hash."""
    path = str(tmp_path_factory.mktemp("layout") / "crowded")
    df = read_parquet(spark, bronze)
    row = spark.createDataFrame(C.curate(df).limit(1).collect(), df.schema)
    df.unionByName(row.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("n")).write.parquet(path)
    return read_parquet(spark, path), [row.select(C.row_hash(row)).first()[0]]


def test_hot_rows_take_the_plain_distinct(spark, bronze, crowded):
    df, (copies, hot) = read_parquet(spark, bronze), crowded
    silver = C.curate_by_year(copies, {}, hot)
    assert exchanges(silver) == 2  # the second one holds what a partial aggregate leaves of the hot rows
    same(silver, C.curate(df).select(*silver.columns))


def test_hot_rows_are_found_in_the_write_and_afterwards(spark, crowded, tmp_path, monkeypatch):
    copies, want = crowded
    monkeypatch.setattr(C, "HOT_COPIES", 1000)
    monkeypatch.setattr(pipeline, "HOT_COPIES", 1000)
    assert pipeline.find_hot_rows(copies) == want
    monkeypatch.setattr(pipeline, "feed_bronze", lambda *_: copies)
    assert pipeline.write_bronze(None, None, None, str(tmp_path / "b")) == (copies.count(), want)
    assert C.hot_hashes([{"item": 1, "count": 10**7}, {"item": None, "count": 10**9}], 10**8) == [1]
    assert C.hot_hashes(None, 0) == [] and C.hot_hashes([{"item": 1, "count": 10**7}], 10**11) == []


def test_layout_of_years_by_size(spark, bronze):
    sizes = partition_bytes(spark, bronze, "year")
    assert "__HIVE_DEFAULT_PARTITION__" in sizes and all(n > 0 for n in sizes.values())
    parts = pipeline.silver_layout(spark, bronze, target_bytes=1000)
    assert all(parts[int(y)] == -(-n // 1000) for y, n in sizes.items() if y.isdigit()) and len(parts) == len(sizes) - 1


@pytest.fixture(scope="module")
def dense(spark, tmp_path_factory):
    """A bronze of 3 million rows of two years that Parquet shrinks to little; its rows' size in memory."""
    path = str(tmp_path_factory.mktemp("layout") / "dense")
    i = F.col("id")
    cols = {"city_name": F.lit("Bourg"), "date": F.make_date(F.lit(2000) + i % 3 % 2, F.lit(1), F.lit(1)).cast("timestamp")}
    cols |= {c: (i % 1500 if c == "avg_temp_c" else F.floor(i / 1500) if c == "min_temp_c" else F.lit(1)).cast("double") for c in METRIC_COLUMNS}
    cols |= {"country": F.lit("Pays"), "region": F.lit("R"), "year": F.lit(2000) + (i % 3 % 2).cast("int")}
    rows = spark.range(3_000_000).select(*[c.alias(k) for k, c in cols.items()])
    write_partitioned_parquet(rows, path)
    return path, 2_000_000 * estimate_row_bytes(read_parquet(spark, path).schema)


def test_layout_of_years_by_rows(spark, dense):
    path, size = dense  # of the larger year, 2000
    sizes = partition_bytes(spark, path, "year")
    assert sizes["2000"] * 3 < size / 20 and sizes["2000"] < pipeline.SILVER_PART_BYTES
    parts = pipeline.silver_layout(spark, path)
    assert parts == {2000: -(-size // pipeline.SILVER_ROW_BYTES), 2001: -(-size // 2 // pipeline.SILVER_ROW_BYTES)}
    assert parts[2000] > 4


def test_layout_of_a_bronze_without_folders_of_years(spark, tmp_path):
    path = str(tmp_path / "flat")
    years = [2000] * 5 + [2001] + [None] * 3
    spark.createDataFrame([(f"c{i}", y) for i, y in enumerate(years)], "city_name string, year int").write.parquet(path)
    assert pipeline.silver_layout(spark, path, row_bytes=2 * 56) == {2000: 3, 2001: 1}


def test_a_silver_task_takes_few_parts(spark, dense, tmp_path):
    """The rows that one task writes stay near a part's, whatever the session's number of shuffle partitions."""
    path, _ = dense
    out = str(tmp_path / "silver")
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.shuffle.partitions")
    assert pipeline.run_silver(spark, path, out, hot=[]) == 3_000_000
    assert before == (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"
    tasks = {}
    for at, _, names in os.walk(out):
        for name in names:
            if name.endswith(".parquet"):
                n = pq.ParquetFile(f"{at}/{name}").metadata.num_rows
                tasks[name.split("-")[1]] = tasks.get(name.split("-")[1], 0) + n
    part = pipeline.SILVER_ROW_BYTES // estimate_row_bytes(read_parquet(spark, path).schema)
    assert sum(tasks.values()) == 3_000_000 and max(tasks.values()) < 3 * part < 1_000_000
    silver = read_parquet(spark, out)
    assert silver.distinct().count() == 3_000_000
    assert silver.exceptAll(read_parquet(spark, path).select(*silver.columns)).isEmpty()


def test_written_row_groups_are_bounded_by_rows(spark, dense):
    path, _ = dense
    files = [f"{at}/{name}" for at, _, names in os.walk(path) for name in names if name.endswith(".parquet")]
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)) <= 250_000


def test_more_years_than_open_files_are_all_written(spark, tmp_path):
    from nimbusmart.sinks import files

    rows = spark.range(0, 3000, 1, 1).select("id", (F.col("id") % 60).cast("int").alias("year"))
    write_partitioned_parquet(rows, str(tmp_path / "many"), laid_out=True)
    assert files.MAX_OPEN_FILES < 60 and len([x for x in os.listdir(tmp_path / "many") if x.startswith("year=")]) == 60
    same(read_parquet(spark, str(tmp_path / "many")), rows)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_spread_shuffles_are_bounded(spark):
    with spread_shuffles(spark, 10) as n:
        assert n == 160 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    with spread_shuffles(spark, 10**6, 10**13) as n:
        assert n == 65536 and 10**13 / int(spark.conf.get("spark.sql.files.maxPartitionBytes")) <= 65536
    with spread_shuffles(spark, 0) as n:
        assert n == 1


def test_null_partition_and_second_write(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 2000), (2, 2001), (3, None)], "id int, year int")
    write_partitioned_parquet(df, path)
    assert {"year=2000", "year=2001", "year=__HIVE_DEFAULT_PARTITION__"} <= set(os.listdir(path))
    write_partitioned_parquet(df.where("id <> 2"), path)
    assert sorted(read_parquet(spark, path).collect(), key=str) == sorted(df.where("id <> 2").collect(), key=str)
    assert "year=2001" not in os.listdir(path)
    write_partitioned_parquet(spark.createDataFrame([(9, None)], "id int, year int"), path, dynamic_overwrite=True)
    assert {(r["id"], r["year"]) for r in read_parquet(spark, path).collect()} == {(1, 2000), (9, None)}


def test_partition_listing_reads_no_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000, "a b"), (2, None, "c=d/e+f"), (3, 2001, None)], "id int, year int, part string")
    save_partitioned_table(df, "default.listed", ["year", "part"], path=str(tmp_path / "t"))
    listed = list_partitions(spark, "default.listed")
    assert {tuple(r) for r in listed.collect()} == {(2000, "a b"), (None, "c=d/e+f"), (2001, None)}
    assert listed.schema["year"].dataType.simpleString() == "int"
    assert "Scan" not in explain_text(listed)
    spark.sql("drop table default.listed")


def test_header_line_and_bad_cells(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("NUM,NAME\n1,x\nno,y\n\n3")
    t = create_delimited_table(spark, "default.messy", "NUM INT, NAME CHAR(5)", str(tmp_path / "t"))
    assert [tuple(r) for r in t.collect()] == [(None, "NAME "), (1, "x    "), (None, "y    "), (3, None)]
    spark.sql("drop table default.messy")
    rows = read_csv_positional(spark, str(tmp_path / "t"), n_columns=2).collect()
    assert [tuple(r) for r in rows] == [("NUM", "NAME"), ("1", "x"), ("no", "y"), ("3", None)]


def test_schema_rows_count_values_in_one_scan(spark):
    df = spark.createDataFrame([(1, None, [1]), (2, "b", None)], "`a.b` int, s string, l array<int>")
    got = {(r["position"], r["name"], r["nullable"], r["n_rows"], r["n_values"]) for r in schema_rows(df).collect()}
    assert got == {(0, "a.b", True, 2, 2), (1, "s", True, 2, 1), (2, "l", True, 2, 1)}
    types = {r["name"]: r["type"] for r in schema_rows(df).collect()}
    assert types["a.b"] == "integer" and '"elementType":"integer"' in types["l"].replace(" ", "")


def test_write_counts_are_those_of_the_layers(spark):
    got = {r["stage"]: r["n"] for r in stages.written_counts(spark, SF_SMALL).collect()}
    base = stages.written_layers(spark, SF_SMALL)
    assert got["silver"] == read_parquet(spark, f"{base}/silver/weather_curated").count()
    assert all(got[name] == read_parquet(spark, path).count() for name, path in stages.gold_registry(spark, SF_SMALL).items())


def test_written_layers_follow_their_input(spark, tmp_path):
    sf = str(tmp_path / "sf")
    os.mkdir(sf)
    for t in stages.INPUTS:
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", f"{sf}/{t}.parquet")  # without the mode: the tables are read-only
    first = stages.gold_registry(spark, sf)
    assert stages.gold_registry(spark, sf) == first and stages.gold_registry(spark, sf, max_age=3600) == first
    n = read_parquet(spark, first["dm_risks"]).count()
    rows = pq.read_table(f"{sf}/lineitem.parquet")
    pq.write_table(rows.slice(0, rows.num_rows // 2), f"{sf}/lineitem.parquet")
    second = stages.gold_registry(spark, sf)
    assert second != first
    assert 0 < read_parquet(spark, second["dm_risks"]).count() <= n == read_parquet(spark, first["dm_risks"]).count()


def test_results_end_by_time_and_broken_builds_do_not_count(spark, tmp_path):
    source = tmp_path / "in"
    spark.range(10).write.parquet(str(source))
    built = []

    def build(folder):
        built.append(folder)
        if len(built) == 1:
            raise RuntimeError("broke off")
        spark.read.parquet(str(source)).write.parquet(f"{folder}/copy")

    with pytest.raises(RuntimeError):
        reused(spark, "test-reuse", [str(source)], build)
    kept = reused(spark, "test-reuse", [str(source)], build)
    assert reused(spark, "test-reuse", [str(source)], build) == kept == built[1] and len(built) == 2
    assert reused(spark, "test-reuse", [str(source)], build, max_age=0) == built[2] != kept
    stamp = input_stamp(spark, str(source))
    spark.range(3).write.mode("append").parquet(str(source))  # a folder of files
    assert input_stamp(spark, str(source)) != stamp
    reused(spark, "test-reuse", [str(source)], build)
    assert len(built) == 4
