import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.errors import CatalogError, OptionError, TypeMismatch
from siltstone.plans.prune import Filter
from siltstone.sources.catalog import Catalog
from siltstone.sources.document import Document
from siltstone.sources.options import ServerConfig, TableOptions, parse_bool, parse_list
from siltstone.sources.files import check_one_kind, split_s3
from siltstone.sources.table import ParquetTable
from tests import fixtures

ALL = {"one": "int8", "two": "int8[]", "three": "text", "four": "timestamp", "five": "date", "six": "bool", "seven": "float8"}


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    made = {f.__name__: f(folder) for f in (fixtures.example1, fixtures.example2, fixtures.example3, fixtures.example4, fixtures.ftcol, fixtures.case_sensitive)}
    return made | {"part1": fixtures.part(folder, 1), "part2": fixtures.part(folder, 2)}


def table(spark, data, *names, columns=ALL, **options):
    return ParquetTable(spark, "t", columns, {"filename": " ".join(f'"{data[n]}"' for n in names)} | options)


# -- options -----------------------------------------------------------------------------------------------------------


def test_booleans_and_lists():
    assert [parse_bool(x) for x in ("true", "ON", "1", "off", "False", "0")] == [True] * 3 + [False] * 3
    for bad in ("t", "f", "yes", ""):
        with pytest.raises(OptionError):
            parse_bool(bad)
    assert parse_list('a "b c"  "d""e"') == ["a", "b c", 'd"e']
    for bad in ('"C 1 c2', '"C 1", c2', 'a"b'):
        with pytest.raises(OptionError):
            parse_list(bad)


def test_options_are_validated(spark, data):
    for bad in ({}, {"filename": "a", "some_option": "1"}, {"filename": "a", "dirname": "b"}, {"dirname": "b", "schemaless": "t"}, {"dirname": "b", "compression_type": "gzip"}, {"dirname": "b", "max_open_files": "x"}):
        with pytest.raises(OptionError):
            TableOptions.parse(bad)
    assert TableOptions.parse({"dirname": "x", "use_minio": "true", "compression_type": "ZSTD"}).compression_type == "zstd"
    with pytest.raises(CatalogError):
        ParquetTable(spark, "t", ALL, {"filename": "/nonexistent.parquet"})
    with pytest.raises(OptionError):
        check_one_kind(["/a", "s3://b/c"])
    with pytest.raises(OptionError):
        ParquetTable(spark, "t", {"a": ("int4", {"wrong_column_name": "b"})}, {"dirname": "x"})
    assert split_s3("s3://bucket/a/b.parquet") == ("bucket", "a/b.parquet")


def test_server_settings():
    server = ServerConfig.from_options("s", {"use_minio": "true", "endpoint": "host:9000"})
    server.map_user({"user": "u", "password": "p"})
    assert server.hadoop_conf("b") == {
        "fs.s3a.bucket.b.endpoint.region": "ap-northeast-1", "fs.s3a.bucket.b.connection.ssl.enabled": "false",
        "fs.s3a.bucket.b.endpoint": "http://host:9000", "fs.s3a.bucket.b.path.style.access": "true",
        "fs.s3a.bucket.b.access.key": "u", "fs.s3a.bucket.b.secret.key": "p",
    }
    with pytest.raises(OptionError):
        ServerConfig.from_options("s", {"user": "x"})
    with pytest.raises(OptionError):
        server.map_user({"use_minio": "true"})


# -- declared tables ---------------------------------------------------------------------------------------------------


def test_reads_all_types(spark, data):
    rows = table(spark, data, "example1").in_file_order().collect()
    assert [r.one for r in rows] == [1, 2, 3, 4, 5, 6]
    assert rows[1].two == [None, 5, 6] and rows[1].seven is None
    assert rows[5].four == dt.datetime(2018, 1, 6, 0, 0, 0, 10) and rows[5].five == dt.date(2018, 1, 6)
    assert [r.six for r in rows] == [True, False, True, False, False, False]


@pytest.mark.parametrize(
    ("column", "op", "value", "ids", "groups"),
    [
        ("one", "<", 1, [], []), ("one", "<=", 1, [1], [1]), ("one", ">", 6, [], []), ("one", ">=", 6, [6], [2]), ("one", "=", 2, [2], [1]),
        ("one", "=", 7, [], []), ("six", "=", True, [1, 3], [1]), ("six", "=", False, [2, 4, 5, 6], [1, 2]), ("seven", "<", 1.5, [1, 3], [1]),
        ("seven", "<=", 1.5, [1, 3, 4], [1, 2]), ("seven", "=", 1.5, [4], [2]), ("seven", ">", 1, [4, 6], [2]), ("seven", ">=", 1, [3, 4, 6], [1, 2]),
        ("five", "<", dt.date(2018, 1, 3), [1, 2], [1]), ("five", "<", "2018-01-01", [], []), ("four", ">", dt.datetime(2018, 1, 5), [5, 6], [2]),
    ],
)
def test_row_groups_are_skipped(spark, data, column, op, value, ids, groups):
    t = table(spark, data, "example1")
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    f = Filter(column, op, value)
    assert sorted(r.one for r in t.df([f]).collect()) == ids
    assert t.explain_scan([f]).files[0].groups == groups
    assert f.flipped().flipped() == f


def test_readers(spark, data):
    t = table(spark, data, "example1", "example2", sorted="one")
    assert t.explain_scan().reader == "Multifile" and t.explain_scan(ordered=True).reader == "Multifile Merge"
    assert t.explain_scan([Filter("one", ">", 6)]).reader == "Single File"
    assert t.explain_scan([Filter("one", ">", 60)]).reader == "Trivial"
    t.set_options(max_open_files="1")
    assert t.explain_scan(ordered=True).reader == "Caching Multifile Merge"
    assert "Row groups of example1.parquet: 1, 2" in t.explain_scan().text()


def test_files_keep_their_order_and_merge(spark, data):
    t = table(spark, data, "example2", "example1", sorted="one")
    assert [r.three for r in t.in_file_order().collect()] == ["eins", "zwei", "drei", "vier", "fünf", "foo", "bar", "baz", "uno", "dos", "tres"]
    assert [r.one for r in t.in_sorted_order().collect()] == [1, 1, 2, 3, 3, 4, 5, 5, 6, 7, 9]
    assert t.df().where("seven is not null").count() == 4  # example2 has no such column


def test_pushdown_and_pruning(spark, data):
    plan = table(spark, data, "example1").df().where("one > 4").select("three")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(one), GreaterThan(one,4)]" in plan and "ReadSchema: struct<one:bigint,three:string>" in plan


def test_column_mapping(spark, data):
    t = table(spark, data, "ftcol", columns={"c1": "int8", "c2": "int8", "c3": "text"})
    assert {r.c1 for r in t.df().collect()} == {None}
    t.set_column_options("c1", column_name="C 1")
    t.add_column("c4", "int4", column_name="C 1")
    assert [(r.c1, r.c4) for r in t.in_file_order().collect()] == [(1, 1), (2, 2), (3, 3)]
    t.drop_column("c4")
    t.set_column_options("c1", column_name="C2")  # exact case
    t.rename_column("c3", "name")
    assert {(r.c1, r.name) for r in t.df().collect()} == {(None, None)}
    t.set_column_options("c1", column_name="c2")
    t.set_column_options("c2", column_name="C 1")
    assert t.df().where("c2 = 3").collect()[0].c1 == 2


def test_case_matters(spark, data):
    t = table(spark, data, "case_sensitive", columns={"UPPER": "text", "upper": "text", "MiXiNg": "text"})
    assert [tuple(r) for r in t.in_file_order().collect()] == [("A", None, "Aa"), ("B", None, "Bb")]


def test_casts(spark, data):
    t = table(spark, data, "example1", columns={"one": "text", "five": "timestamp", "six": "int4", "seven": "numeric"})
    assert [tuple(r) for r in t.df().where("one = '3'").collect()] == [("3", dt.datetime(2018, 1, 3), 1, 1.0)]
    for bad in ({"one": "int8[]"}, {"two": "int8"}):
        with pytest.raises(TypeMismatch):
            table(spark, data, "example1", columns=bad).df()
    with pytest.raises(TypeMismatch):
        table(spark, data, "example1", columns={"one": "polygon"})


def test_nanoseconds(spark, tmp_path):
    path = fixtures.simple(tmp_path / "ns.parquet", {"t": pa.timestamp("ns")}, [(1_514_764_800_123_456_789,), (None,)])
    t = ParquetTable(spark, "t", {"t": "timestamp"}, {"filename": path})
    assert [r.t for r in t.in_file_order().collect()] == [dt.datetime(2018, 1, 1, 0, 0, 0, 123456), None]


def test_files_func_and_folders(spark, data, tmp_path):
    fixtures.example2(tmp_path)
    (tmp_path / "deep").mkdir()
    fixtures.example2(tmp_path / "deep")
    assert ParquetTable(spark, "t", ALL, {"dirname": str(tmp_path)}).df().count() == 10
    t = ParquetTable(spark, "t", ALL, {"files_func": lambda arg: [data[n] for n in arg], "files_func_arg": ["example1"]})
    assert t.df().count() == 6
    t.set_options(files_func_arg=["example1", "example2"])
    assert t.df().count() == 11
    t.set_options(files_func_arg=[])
    assert t.df().collect() == []


# -- documents ---------------------------------------------------------------------------------------------------------


def test_documents_as_text(spark, data):
    t = table(spark, data, "example1", columns={"cx": "int4", "v": "jsonb"}, schemaless="true")
    doc = Document(t)
    rows = doc.df().orderBy(doc.get("one")).select("cx", doc.json().alias("j")).collect()
    assert rows[1] == (None, '{"one": 2, "six": "f", "two": [null, 5, 6], "five": "2018-01-02", "four": "2018-01-02 00:00:00", "seven": null, "three": "bar"}')
    assert rows[2].j.startswith('{"one": 3, "six": "t"') and '"seven": 1,' in rows[2].j
    assert '"four": "2018-01-06 00:00:00.00001"' in rows[5].j
    assert [r[0] for r in table(spark, data, "example1", columns={"a": "int4"}, schemaless="true").df().select("a").distinct().collect()] == [None]


def test_document_access(spark, data):
    t = table(spark, data, "example1", columns={"v": "jsonb"}, schemaless="true")
    doc = Document(t)
    got = doc.df().select(doc.cast("int4", "one").alias("i"), doc.get("two", 1).alias("x"), doc.get("two", 9).alias("y"), doc.text("six").alias("s"), doc.text("nope").alias("n")).orderBy("i").collect()
    assert [tuple(r) for r in got][:2] == [(1, 2, None, "t", None), (2, 5, None, "f", None)]
    plan = doc.df().select(doc.get("one"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<one:bigint>" in plan


def test_maps_and_keys(spark, data):
    t = table(spark, data, "example3", columns={"v": "jsonb"}, schemaless="true")
    doc = Document(t)
    got = doc.df().select(doc.get("one", "1").alias("a"), doc.get("two", "2018-01-01").alias("b"), doc.text("two").alias("c")).collect()
    assert [tuple(r) for r in got] == [("foo", 10, '{"2018-01-01": 10, "2018-01-02": 15}'), (None, None, '{"2018-01-03": 20, "2018-01-04": 25}')]
    assert doc.df().where(doc.has("one", "1")).count() == 1 and doc.df([Filter("one", "?", 10)]).count() == 0
    assert t.explain_scan([Filter("one", "?", 10)]).reader == "Trivial"
    declared = table(spark, data, "example3", columns={"one": "jsonb", "three": "int2"})
    assert [r.one for r in declared.in_file_order().collect()][0] == {1: "foo", 2: "bar", 3: "baz"}


def test_files_of_different_columns(spark, data):
    t = table(spark, data, "example1", "example4", columns={"v": "jsonb"}, schemaless="true", sorted="one")
    doc = Document(t)
    assert doc.df().where(doc.has("jsonb_col")).count() == 2 and doc.df().count() == 8
    texts = [r[0] for r in doc.df().where(doc.has("jsonb_col")).select(doc.json()).collect()]
    assert sorted(texts)[0] == '{"array_col": [1, 2], "jsonb_col": {"1": "a"}}'
    assert [f.groups for f in t.explain_scan([Filter("", "?", "jsonb_col")]).files] == [[], [1]]
    assert t.in_sorted_order().count() == 8
    t.set_options(sorted="not_a_col")
    with pytest.raises(OptionError):
        t.in_sorted_order()


# -- catalog -----------------------------------------------------------------------------------------------------------


def test_import_of_schemas(spark, data, tmp_path):
    fixtures.example1(tmp_path)
    fixtures.example2(tmp_path)
    (tmp_path / "readme").write_text("no table")
    catalog = Catalog(spark)
    assert catalog.import_foreign_schema(str(tmp_path), options={"sorted": "one"}) == ["example1", "example2"]
    assert Catalog(spark).import_foreign_schema(str(tmp_path), limit_to=["example2", "x"]) == ["example2"]
    assert Catalog(spark).import_foreign_schema(str(tmp_path), except_=["example2"]) == ["example1"]
    assert [(c.name, c.type_name) for c in catalog.table("example1").columns] == list(ALL.items())
    catalog.import_parquet("both", lambda arg: [data[n] for n in arg], ["example1", "example2"], {"key_columns": "one"})
    assert catalog.table("both").key_names() == ["one"]
    catalog.import_parquet_explicit("some", ["one", "six"], ["int8", "bool"], lambda arg: [data["example2"]])
    assert catalog.sql("SELECT count(*) AS n FROM both b JOIN some s ON b.one = s.one WHERE s.six").collect()[0].n == 5
    with pytest.raises(OptionError):
        catalog.import_parquet_explicit("bad", ["one"], [], lambda arg: [])
    with pytest.raises(CatalogError):
        catalog.create_table("some", ALL, dirname="x")
    catalog.create_view("v", "SELECT * FROM some")
    assert catalog.table("v") is catalog.table("some")
    assert catalog.sql("SELECT one FROM v WHERE one < :most", {"most": 4}).count() == 2
    assert catalog.analyze("some").collect()[0].rows == 5
    catalog.drop_table("some")
    with pytest.raises(CatalogError):
        catalog.drop_table("some")


def test_partitions(spark, data):
    catalog = Catalog(spark)
    columns = {"id": "int4", "date": "timestamp", "num": "int4"}
    for n in (1, 2):
        catalog.create_table(f"p{n}", columns, filename=f'"{data[f"part{n}"]}"', sorted="id date")
    t = catalog.create_partitioned("p", "date", [("p1", "2018-01-01", "2018-02-01"), ("p2", "2018-02-01", "2018-03-01")])
    assert t.df().where("id = 1").count() == 4
    one = t.df().where(F.col("date") == F.lit("2018-01-01").cast("timestamp_ntz"))
    assert [r.num for r in one.collect()] == [10]
    assert "part2" not in one._jdf.queryExecution().optimizedPlan().toString()


def test_connections(spark):
    catalog = Catalog(spark)
    catalog.create_server("s1", use_minio="true")
    catalog.create_server("s2")
    with pytest.raises(OptionError):
        catalog.create_server("s3", wrong="1")
    with pytest.raises(CatalogError):
        catalog.disconnect("unknown")
    assert catalog.disconnect("s1") is True
    assert sorted(map(tuple, catalog.get_connections().collect())) == [("s1", False), ("s2", True)]
    assert catalog.disconnect_all() is True and catalog.disconnect_all() is False
    catalog.connect("s1", "b")
    assert catalog.version()


def test_new_files_as_a_stream(spark, tmp_path):
    from siltstone.streaming.folders import stream

    (tmp_path / "in").mkdir()
    fixtures.example1(tmp_path / "in")
    t = ParquetTable(spark, "t", {"id": ("int4", {"column_name": "one"}), "seven": "float8", "nope": "text"}, {"dirname": str(tmp_path / "in")})

    def drain():
        q = stream(t).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert drain() == 6
    fixtures.example2(tmp_path / "in")
    assert drain() == 11


def test_views_are_found_by_the_parse(spark, data):
    catalog = Catalog(spark)
    catalog.create_table("t", {"u": ("int8", {"column_name": "one"})}, filename=data["example1"])
    catalog.create_view("u", "SELECT u FROM t")  # its own name is a column
    assert [r.u for r in catalog.sql("SELECT u, 'v' AS s FROM u WHERE u < 3").collect()] == [1, 2]
    catalog.create_view("a", "SELECT * FROM b")
    catalog.create_view("b", "SELECT * FROM a")
    with pytest.raises(CatalogError, match="leads back"):
        catalog.sql("SELECT * FROM a")
    assert catalog.sql("SELECT 'a' AS b").collect()[0].b == "a"
    assert catalog.sql("WITH t AS (SELECT 7 AS u) SELECT * FROM t").collect()[0].u == 7


def test_many_files_are_surveyed_in_tasks(spark, tmp_path):
    import time

    import pyarrow.parquet as pq

    for i in range(1500):
        pq.write_table(pa.table({"x": [i], **({"y": [1]} if i % 2 else {})}), tmp_path / f"{i:04d}.parquet")
    spark.range(1).count()
    start = time.monotonic()
    paths = [str(tmp_path / f"{i:04d}.parquet") for i in range(1500)]
    table = ParquetTable(spark, "t", {"x": "int8", "y": "int8"}, {"filename": paths})
    df = table.df([Filter("x", ">=", 1490)])
    assert time.monotonic() - start < 20
    assert sorted(r.x for r in df.collect()) == list(range(1490, 1500)) and len(df.inputFiles()) == 10
