import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltstone.errors import ModifyError, UnsupportedOperation
from siltstone.operators.modify import Modifier
from siltstone.sources.catalog import Catalog
from siltstone.sources.document import Document
from siltstone.sources.table import ParquetTable
from tests import fixtures

KEYED = {"id": ("int8", {"key": "true"}), "a": "text"}


@pytest.fixture
def files(tmp_path):
    for n, rows in enumerate([[(0, "a"), (1, "b")], [(2, "c"), (3, "d")], [(4, "e"), (5, "f")]], 1):
        fixtures.simple(tmp_path / f"t{n}.parquet", {"id": pa.int64(), "a": pa.string()}, rows)
    fixtures.simple(tmp_path / "t4.parquet", {"id": pa.int64(), "b": pa.string()}, [(6, "g"), (7, "h")])
    return tmp_path


def names(folder, n):
    return pq.read_table(folder / f"t{n}.parquet").to_pylist()


def test_insert_goes_to_the_first_file_that_fits(spark, files):
    t = ParquetTable(spark, "t", {"id": "int8", "a": "text", "b": "text"}, {"filename": " ".join(f'"{files}/t{n}.parquet"' for n in (1, 2, 3, 4))})
    m = Modifier(t)
    m.insert([{"id": 10, "a": "x"}, {"id": 11, "b": "y"}, {"id": 12}])
    assert names(files, 1) == [{"id": 0, "a": "a"}, {"id": 1, "a": "b"}, {"id": 10, "a": "x"}, {"id": 12, "a": None}]
    assert names(files, 4)[-1] == {"id": 11, "b": "y"}
    with pytest.raises(ModifyError, match="has the columns of this row"):
        m.insert([{"id": 13, "a": "x", "b": "y"}])
    m.insert(t.df().where("id < 2").select((F.col("id") + 100).alias("id"), "a"))  # reads what it changes
    assert [r["id"] for r in names(files, 1)] == [0, 1, 10, 12, 100, 101]
    with pytest.raises(UnsupportedOperation):
        m.insert([{"id": 1}], returning="*")


def test_update_and_delete_by_key(spark, files):
    t = ParquetTable(spark, "t", KEYED, {"filename": " ".join(f'"{files}/t{n}.parquet"' for n in (1, 2, 3))})
    before = (files / "t3.parquet").stat().st_mtime_ns
    m = Modifier(t)
    m.update({"a": F.concat("a", F.lit("!"))}, F.col("id").between(1, 2))
    m.delete(F.col("id") == 3)
    assert names(files, 1) == [{"id": 0, "a": "a"}, {"id": 1, "a": "b!"}] and names(files, 2) == [{"id": 2, "a": "c!"}]
    assert (files / "t3.parquet").stat().st_mtime_ns == before
    m.update({"id": 9, "a": None}, F.col("id") == 5)
    assert names(files, 3) == [{"id": 4, "a": "e"}, {"id": 9, "a": None}]
    with pytest.raises(ModifyError, match="has a null"):
        m.update({"id": None}, F.col("id") == 9)
    with pytest.raises(ModifyError, match="has a null"):
        m.insert([{"a": "x"}])
    m.delete()
    assert t.df().count() == 0
    m.insert([{"id": 1, "a": "again"}])
    assert [tuple(r) for r in t.df().collect()] == [(1, "again")]


def test_keys_are_required_and_typed(spark, tmp_path):
    path = fixtures.simple(tmp_path / "f.parquet", {"id": pa.list_(pa.int64()), "b": pa.bool_(), "a": pa.string()}, [([1], True, "x")])
    for columns, match in (({"a": "text"}, "has no key"), ({"id": ("int8[]", {"key": "true"})}, "told apart"), ({"b": ("bool", {"key": "on"})}, "told apart")):
        with pytest.raises(ModifyError, match=match):
            Modifier(ParquetTable(spark, "t", columns, {"filename": f'"{path}"', "key_columns": "a"})).delete()


def test_repeated_keys_change_first_matches(spark, tmp_path):
    path = fixtures.simple(tmp_path / "f.parquet", {"id": pa.int64(), "a": pa.string()}, [(1, "x"), (1, "y"), (1, "z"), (None, "n")])
    t = ParquetTable(spark, "t", KEYED, {"filename": f'"{path}"'})
    Modifier(t).delete(F.col("a") == "z")  # one hit of key 1 takes its first row
    assert [r.a for r in t.in_file_order().collect()] == ["y", "z", "n"]
    Modifier(t).delete()
    assert [r.a for r in t.df().collect()] == ["n"]  # a null key never matches


def test_sources_of_updates_and_deletes(spark, files):
    t = ParquetTable(spark, "t", KEYED, {"dirname": str(files)})
    source = spark.createDataFrame([(0, "new0"), (4, "new4"), (4, "new4"), (99, "no")], "k long, v string")
    Modifier(t).update({"a": F.col("v")}, source=source, on=F.col("id") == F.col("k"))
    assert {(r.id, r.a) for r in t.df().where("id in (0, 1, 4)").collect()} == {(0, "new0"), (1, "b"), (4, "new4")}
    Modifier(t).delete(source=source, on=F.col("id") == F.col("k"))
    assert sorted(r.id for r in t.df().collect()) == [1, 2, 3, 5, 6, 7]


def test_new_files_and_selectors(spark, tmp_path):
    (tmp_path / "d").mkdir()
    t = ParquetTable(spark, "ft", {"c1": "int4", "c2": "text"}, {"dirname": str(tmp_path / "d")})
    Modifier(t).insert([{"c1": 1, "c2": "a"}, {"c1": 2}])
    (made,) = t.files()
    assert made.rpartition("/")[2].startswith("ft-") and t.df().count() == 2
    t.set_options(insert_file_selector=lambda row, folder: F.concat(F.lit(folder + "/"), F.col("c2"), F.lit(".parquet")))
    Modifier(t).insert([{"c1": 3, "c2": "p"}, {"c1": 4, "c2": "q"}, {"c1": 5, "c2": "p"}])
    assert [f.rpartition("/")[2] for f in t.files()][-2:] == ["p.parquet", "q.parquet"] and t.df().count() == 5
    t.set_options(insert_file_selector="concat(dirname, '/', c2, '.parquet')")
    t.add_column("c3", "int4")
    with pytest.raises(ModifyError, match="schema"):
        Modifier(t).insert([{"c1": 6, "c2": "p", "c3": 1}])


def test_sorted_files_stay_sorted(spark, tmp_path):
    path = fixtures.ftcol(tmp_path)
    t = ParquetTable(spark, "t", {"c1": ("int8", {"column_name": "C 1", "key": "1"}), "c2": "int8", "c3": "text"}, {"filename": f'"{path}"', "sorted": "c1"})
    Modifier(t).insert([{"c1": 0, "c3": "first"}, {"c1": 9, "c3": "last"}, {"c1": 2, "c3": "tie"}])
    assert [r["C 1"] for r in pq.read_table(path).to_pylist()] == [0, 1, 2, 2, 3, 9]
    Modifier(t).update({"c1": 7}, F.col("c1") == 1)
    assert [r["C 1"] for r in pq.read_table(path).to_pylist()] == [0, 2, 2, 3, 7, 9]
    t.set_options(sorted="c3")
    with pytest.raises(ModifyError, match="not supported"):
        Modifier(t).insert([{"c1": 1}])
    t.set_options(sorted="c2 c1")
    with pytest.raises(ModifyError, match="table's order"):
        Modifier(t).insert([{"c1": 1}])


def test_compression(spark, tmp_path):
    path = fixtures.simple(tmp_path / "f.parquet", {"id": pa.int64(), "a": pa.string()}, [(1, "x")], compression="zstd")
    codec = lambda p: pq.ParquetFile(p).metadata.row_group(0).column(0).compression
    t = ParquetTable(spark, "t", KEYED, {"filename": f'"{path}"'})
    Modifier(t).insert([{"id": 2}])
    assert codec(path) == "ZSTD"
    t.set_options(compression_type="snappy")
    Modifier(t).insert([{"id": 3}])
    assert codec(path) == "SNAPPY"
    t.set_column_options("a", compression_type="UNCOMPRESSED")
    Modifier(t).insert([{"id": 4}])
    assert codec(path) == "UNCOMPRESSED" and t.df().count() == 4


def test_defaults_and_generated_columns(spark, tmp_path):
    path = fixtures.simple(tmp_path / "f.parquet", {"id": pa.int64(), "a": pa.int64(), "b": pa.int64()}, [(1, 5, 10)])
    t = ParquetTable(spark, "t", {"id": ("int8", {"key": "true"})}, {"filename": f'"{path}"'})
    t.add_column("a", "int8", default=7)
    t.add_column("b", "int8", generated="a * 2")
    m = Modifier(t)
    m.insert([{"id": 2}, {"id": 3}])
    m.update({"a": F.col("a") + 1}, F.col("id") <= 2)
    assert sorted(map(tuple, t.df().collect())) == [(1, 6, 12), (2, 8, 16), (3, 7, 14)]
    with pytest.raises(ModifyError):
        m.update({"b": 1})


def test_nested_values(spark, tmp_path):
    kinds = {"id": pa.int32(), "m": pa.map_(pa.string(), pa.int32()), "l": pa.list_(pa.float64())}
    path = fixtures.simple(tmp_path / "f.parquet", kinds, [(1, [("a", 1)], [1.5])])
    t = ParquetTable(spark, "t", {"id": ("int4", {"key": "true"}), "m": "jsonb", "l": "float8[]"}, {"filename": f'"{path}"'})
    rows = spark.createDataFrame([(2, {"b": None, "c": 3}, [None, 2.0])], "id int, m map<string,int>, l array<double>")
    Modifier(t).insert(rows)
    assert [tuple(r) for r in t.in_file_order().collect()][1] == (2, {"b": None, "c": 3}, [None, 2.0])


def test_documents(spark, tmp_path):
    path = fixtures.example2(tmp_path)
    t = ParquetTable(spark, "t", {"v": "jsonb"}, {"dirname": str(tmp_path), "schemaless": "true", "key_columns": "three"})
    doc = Document(t)
    copy = doc.df().select(doc.json().alias("j")).collect()
    m = Modifier(t)
    m.delete(doc.cast("int4", "one") == 1)
    m.update({"one": F.lit(70)}, doc.get("three") == "vier")
    assert sorted(r["one"] for r in pq.read_table(path).to_pylist()) == [3, 5, 9, 70]
    m.delete()
    m.insert(spark.createDataFrame([(r.j,) for r in copy], "j string"))
    again = Document(t)
    assert sorted(r[0] for r in again.df().select(again.json()).collect()) == sorted(r.j for r in copy)
    m.insert([{"three": "x", "extra": [1, 2], "flag": True, "sub": {"k": "v"}}])
    more = Document(t)
    assert len(t.files()) == 2 and {r[0] for r in more.df().where(more.has("extra")).select(more.json()).collect()} == {'{"sub": {"k": "v"}, "flag": "t", "extra": [1, 2], "three": "x"}'}
    with pytest.raises(ModifyError, match="has a null"):
        m.insert([{"one": 1}])


def test_by_catalog_and_partition(spark, tmp_path):
    catalog = Catalog(spark)
    columns = {"id": ("int4", {"key": "true"}), "date": "timestamp", "num": "int4"}
    for n in (1, 2):
        catalog.create_table(f"p{n}", columns, filename=f'"{fixtures.part(tmp_path, n)}"')
    catalog.create_partitioned("p", "date", [("p1", "2018-01-01", "2018-02-01"), ("p2", "2018-02-01", "2018-03-01")])
    catalog.create_view("v1", "SELECT * FROM p1")
    catalog.insert("v1", [{"id": 5, "date": dt.datetime(2018, 1, 9), "num": 1}])
    catalog.insert("p", [{"id": 6, "date": dt.datetime(2018, 2, 9), "num": 2}])
    catalog.update("p", {"num": 0}, F.col("id") >= 5)
    catalog.delete("p", F.col("id") == 2)
    assert catalog.table("p1").df().count() == 3 and catalog.table("p2").df().count() == 3
    assert {(r.id, r.num) for r in catalog.sql("SELECT * FROM p WHERE id >= 5").collect()} == {(5, 0), (6, 0)}
    (tmp_path / "ds").mkdir()
    catalog.create_table("ds", {"a": "int4"}, dirname=str(tmp_path / "ds"))
    catalog.create_datasource("ds")
    assert catalog.table("ds").df().count() == 0 and len(catalog.table("ds").files()) == 1
    catalog.drop_datasource("ds")
    assert catalog.table("ds").files() == []


def test_a_failing_rename_keeps_the_old_file(spark, files, monkeypatch):
    from siltstone.sources.files import Store

    t = ParquetTable(spark, "t", KEYED, {"filename": [f"{files}/t1.parquet"]})
    before = names(files, 1)

    def broken(self, source, target):
        raise OSError("no rename")

    monkeypatch.setattr(Store, "replace", broken)
    with pytest.raises(OSError):
        Modifier(t).update({"a": F.lit("z")}, F.col("id") == 1)
    assert names(files, 1) == before and not [p for p in files.iterdir() if p.name.startswith(".silt")]
    monkeypatch.undo()
    store = Store(spark)
    with pytest.raises(Exception):
        store.replace(f"{files}/none.parquet", f"{files}/t1.parquet")
    assert names(files, 1) == before
    Modifier(t).update({"a": F.lit("z")}, F.col("id") == 1)
    assert names(files, 1)[1] == {"id": 1, "a": "z"}


def test_a_large_insert_makes_several_files(spark, tmp_path):
    folder = tmp_path / "it's (a) folder"
    t = ParquetTable(spark, "t", KEYED, {"dirname": str(folder), "sorted": "id"})
    folder.mkdir()
    rows = spark.range(100).selectExpr("100 - id AS id", "'x' AS a")
    Modifier(t, rows_per_file=30).insert(rows)
    found = sorted(folder.glob("*.parquet"))
    assert len(found) == 4 and t.df().count() == 100
    for path in found:
        ids = pq.read_table(path)["id"].to_pylist()
        assert ids == sorted(ids) and 10 <= len(ids) <= 40
    Modifier(t, rows_per_file=30).insert([{"id": 500, "a": "y"}])
    assert len(sorted(folder.glob("*.parquet"))) == 4 and t.df().count() == 101
    named = ParquetTable(spark, "t", KEYED, {"dirname": str(folder), "insert_file_selector": "concat(dirname, '/', a, '.parquet')"})
    Modifier(named).insert([{"id": 1, "a": "z"}])
    assert (folder / "z.parquet").exists()


def test_order_is_checked_across_splits(spark, tmp_path):
    path = fixtures.write(tmp_path / "x.parquet", [pa.table([[1, 2, 3]], names=["id"]), pa.table([[2, 5, 6]], names=["id"])])
    t = ParquetTable(spark, "t", {"id": ("int8", {"key": "true"})}, {"filename": [path], "sorted": "id"})
    for size in ("1", "100m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        with pytest.raises(ModifyError, match="table's order"):
            Modifier(t).insert([{"id": 4}])
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_keep_the_order_of_a_long_list_of_files(spark, tmp_path):
    paths = [fixtures.simple(tmp_path / f"{'zyx'[i % 3]} {i}.parquet", {"id": pa.int64(), "a": pa.string()}, [(i, "v")]) for i in range(12)]
    t = ParquetTable(spark, "t", KEYED, {"filename": paths})
    assert [r.id for r in t.in_file_order().collect()] == list(range(12))
    assert "CASE WHEN" not in t.in_file_order()._jdf.queryExecution().optimizedPlan().toString()
