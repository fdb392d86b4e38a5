"""Sources, sinks and catalog surface, with the golden breweries rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusmart.sinks import files as sinks
from nimbusmart.sources import catalog, files, rows

# Golden rows printed by the reference for its breweries file (first lines).
BREWERIES = [
    ",name,city,state,id",
    "0,NorthGate Brewing ,Minneapolis,MN,0",
    "1,Against the Grain Brewery,Louisville,KY,1",
    "2,Jack's Abby Craft Lagers,Framingham,MA,2",
]


def write_lines(tmp_path, name, lines):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part-0.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_positional_csv_keeps_header_as_row(spark, tmp_path):
    path = write_lines(tmp_path, "breweries", BREWERIES)
    df = files.read_csv_positional(spark, path)
    assert df.columns == ["_c0", "_c1", "_c2", "_c3", "_c4"]
    got = df.collect()
    assert tuple(got[0]) == (None, "name", "city", "state", "id")
    assert tuple(got[1]) == ("0", "NorthGate Brewing ", "Minneapolis", "MN", "0")


def test_delimited_table_types_and_char_padding(spark, tmp_path):
    path = write_lines(tmp_path, "breweries_tbl", BREWERIES)
    catalog.create_database(spark, "openbeer_test", location=str(tmp_path / "db"))
    t = catalog.create_delimited_table(
        spark, "openbeer_test.breweries",
        "NUM INT, NAME CHAR(100), CITY CHAR(100), STATE CHAR(100), ID INT", path)
    names = [r.NAME for r in t.select("NAME").collect()]
    assert names[0] == "name".ljust(100)
    assert names[1] == "NorthGate Brewing ".ljust(100)
    assert t.first().NUM is None
    assert "openbeer_test" in catalog.list_databases(spark)
    assert catalog.table_exists(spark, "openbeer_test.breweries")


def test_csv_explicit_schema_keeps_codes(spark, tmp_path):
    path = write_lines(tmp_path, "codes", ["code,n", "007,1"])
    inferred = files.read_csv(spark, path).first()
    typed = files.read_csv(spark, path, schema="code string, n int").first()
    assert inferred.code == 7 and typed.code == "007"


def test_inline_rows(spark):
    df = rows.from_rows(spark, [["Jean"], ["Liz"], ["Pierre"], ["Lauric"]],
                        T.StructType([T.StructField("name", T.StringType(), True)]))
    assert [r.name for r in df.collect()] == ["Jean", "Liz", "Pierre", "Lauric"]


def test_schema_json_roundtrip(spark):
    df = spark.createDataFrame([(1, [1.0], ("a",))], "id long, g array<double>, s struct<x:string>")
    text = sinks.schema_json(df)
    assert sinks.schema_from_json(text) == df.schema


def test_nested_json_read(spark, tmp_path):
    path = str(tmp_path / "docs")
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(
        '{"fields": {"id": 7, "premise_name": "Bar", "geolocation": [35.9, -78.9]}, "recordid": "r"}\n')
    df = files.read_json(spark, path)
    r = df.select(F.col("fields.premise_name").alias("n"), F.get("fields.geolocation", 1).alias("y")).first()
    assert (r.n, r.y) == ("Bar", -78.9)


def test_partitioned_parquet_roundtrip_with_null_year(spark, tmp_path):
    df = spark.createDataFrame([(1, 2020), (2, None), (3, 2021)], "v int, year int")
    out = sinks.write_partitioned_parquet(df, str(tmp_path / "p"))
    back = files.read_parquet(spark, out)
    assert back.columns == ["v", "year"]
    assert sorted((r.v, r.year) for r in back.collect()) == [(1, 2020), (2, None), (3, 2021)]
    assert (tmp_path / "p" / "year=__HIVE_DEFAULT_PARTITION__").exists()


def test_saved_table_partitions(spark):
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "v int, year int")
    sinks.save_partitioned_table(df, "default.silver_test")
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS default.silver_test").collect()]
    assert sorted(parts) == ["year=2020", "year=2021"]


def test_text_and_word_count_input(spark, tmp_path):
    path = write_lines(tmp_path, "readme", ["hello world", "hello"])
    from nimbusmart.operators.text import word_count

    got = {r.word: r.n for r in word_count(files.read_text(spark, path), "value").collect()}
    assert got == {"hello": 2, "world": 1}


def test_word_count_output_directory_round_trip(spark, tmp_path):
    from nimbusmart.operators.text import read_counts, word_count, write_counts

    texts = ['say "hi", \\n a,b c\u00e9 "', "a,b  \t\n\r\fé\u00a0x  say", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = word_count(df)
    back = read_counts(spark, write_counts(counts, str(tmp_path / "out")))
    assert sorted(back.collect()) == sorted(counts.collect())
    assert dict(back.collect())["a,b"] == 2


def test_inspection_helpers(spark):
    import pytest

    from nimbusmart.operators import inspect

    df = spark.range(100).repartition(4)
    assert inspect.partition_count(df) == 4
    assert inspect.rows_per_partition(df).agg(F.sum("rows")).first()[0] == 100
    assert inspect.preview(df, 5).count() == 5
    assert "id: long" in inspect.schema_tree(df)
    assert len(inspect.bounded_collect(df, 100)) == 100
    with pytest.raises(inspect.TooManyRows):
        inspect.bounded_collect(df, 99)


def test_ensure_parallelism_only_spreads_small_scans(spark):
    from nimbusmart.operators import inspect

    one = spark.range(10).coalesce(1)
    assert inspect.partition_count(inspect.ensure_parallelism(one, 4)) == 4
    many = spark.range(100).repartition(8)
    assert inspect.ensure_parallelism(many, 4) is many


def test_jdbc_options_without_a_database():
    import pytest

    from nimbusmart.sinks.jdbc import jdbc_write_options
    from nimbusmart.sources.jdbc import jdbc_read_options

    opts = jdbc_read_options("jdbc:x://h/db", "cities", {"user": "u"}, partition_column="id",
                             lower_bound=1, upper_bound=1000, num_partitions=16)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "16" and opts["user"] == "u"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000" and opts["dbtable"] == "cities"
    assert "partitionColumn" not in jdbc_read_options("jdbc:x://h/db", "cities")
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x://h/db", "cities", partition_column="id", num_partitions=4)
    w = jdbc_write_options("jdbc:x://h/db", "dm_risks", {"password": "p"}, truncate=True, num_partitions=8)
    assert w == {"url": "jdbc:x://h/db", "dbtable": "dm_risks", "batchsize": "10000", "truncate": "true",
                 "numPartitions": "8", "password": "p"}
