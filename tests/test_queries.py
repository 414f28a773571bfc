"""Each query against its DuckDB SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from siltstone.functions import compat
from siltstone.plans.queries import QUERIES, SQL, declared


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return "NULL" if value is None else str(value)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rel = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted([plain(r[i]) for i in at] for r in rel.fetchall())


def test_plans_push_down(spark, sf_dir):
    plan = QUERIES["filter_rowgroup_int"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    plan = QUERIES["doc_cast_filter"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_null_order_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "k int, v int")
    assert [r.k for r in compat.ordered(df, "v").collect()] == [3, 2, 1]
    assert [r.k for r in compat.ordered(df, "v desc").collect()] == [1, 2, 3]
    assert [r.k for r in compat.ordered(df, "v", nulls="first").collect()] == [1, 3, 2]


def test_compat_functions(spark):
    df = spark.createDataFrame([(7, -2, [1, None, 3], 5), (-7, 2, [], -42)], "a int, b int, l array<int>, n int")
    F = compat.F
    got = df.select(
        compat.int_div(F.col("a"), F.col("b")), compat.subscript(F.col("l"), 3), compat.any_of(F.col("a"), F.array(F.lit(7))), compat.to_char_padded(F.col("n"), 4)
    ).collect()
    assert [tuple(r) for r in got] == [(-3, 3, True, "0005"), (-3, None, False, "-0042")]
    agg = df.union(df).groupBy().agg(compat.array_agg(F.col("a")), compat.array_agg(F.when(F.col("a") > 0, F.col("a")), nulls_last=False), compat.array_agg(F.col("a"), F.col("b"), descending=True))
    assert [list(x) for x in agg.collect()[0]] == [[-7, -7, 7, 7], [None, None, 7, 7], [-7, -7, 7, 7]]
    assert [r[0] for r in compat.generate_series(spark, 5, 1, -2).collect()] == [5, 3, 1]


def test_folder_tables(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    assert declared(spark, str(tmp_path), "orders").df().count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()


def test_positions_follow_the_whole_order(spark, sf_dir):
    df = spark.range(0, 5000, 1, 7).selectExpr("id", "IF(id % 3 = 0, NULL, id % 11) AS v")
    got = compat.with_position(compat.ordered(df, "v", "id desc")).collect()
    want = sorted(((r.v is None, r.v or 0, -r.id) for r in df.collect()))
    assert [(r.v is None, r.v or 0, -r.id) for r in sorted(got, key=lambda r: r.pos)] == want
    assert sorted(r.pos for r in got) == list(range(5000))
    assert compat.with_position(compat.ordered(df.limit(0), "v")).collect() == []
    whole = QUERIES["nulls_order_all"](spark, sf_dir).collect()
    assert any(r.quality is None for r in whole) and len(whole) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_sorted_scan_returns_every_row(spark, sf_dir):
    got = QUERIES["sorted_scan_all"](spark, sf_dir).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()))
    keys = [(r.l_orderkey, r.l_linenumber, r.l_quantity) for r in got]
    assert keys == sorted(keys) and len(keys) > 200
