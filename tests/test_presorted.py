from siltstone.plans.queries import QUERIES, SQL
from siltstone.plans.presorted import read_presorted, save_presorted
from siltstone.session import table


def test_joins_and_groups_without_shuffle(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    save_presorted(orders, "orders_sorted", ["o_orderkey"], 4)
    save_presorted(lines, "lines_sorted", ["l_orderkey"], 4)
    o, n = read_presorted(spark, "orders_sorted"), read_presorted(spark, "lines_sorted")
    joined = o.join(n.hint("merge"), o.o_orderkey == n.l_orderkey).groupBy("o_orderkey").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    assert joined.count() == lines.select("l_orderkey").distinct().count()
    spark.sql("DROP TABLE orders_sorted")
    spark.sql("DROP TABLE lines_sorted")


def test_presorted_queries_neither_shuffle_nor_sort(spark, sf_dir):
    for name in ("join_merge_sorted", "group_presorted"):
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort [" not in plan, plan
    assert "SortMergeJoin" in QUERIES["join_merge_sorted"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_partitions_are_left_out(spark, sf_dir):
    for name in ("part_prune", "part_prune_sql"):
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2, name


def test_copies_beside_files_that_no_catalog_knows(spark, sf_dir):
    """A session that is gone leaves its copies in the warehouse, whole or not."""
    for name, source, key in (("group_presorted", "lineitem", "l_orderkey"), ("join_merge_sorted", "orders", "o_orderkey")):
        QUERIES[name](spark, sf_dir)
        for copy in [t.name for t in spark.catalog.listTables() if t.name.startswith(f"presorted_{source}_")]:
            spark.sql(f"DROP TABLE `{copy}`")
            left = f"{spark.conf.get('spark.sql.warehouse.dir')}/{copy}"
            spark.range(5).withColumnRenamed("id", key).write.mode("overwrite").parquet(left)
    got = sorted(map(tuple, QUERIES["group_presorted"](spark, sf_dir).collect()))
    lines = table(spark, sf_dir, "lineitem")
    lines.createOrReplaceTempView("lineitem")
    assert got == sorted(map(tuple, spark.sql(SQL["group_presorted"]).collect())) and len(got) > 5
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    got = sorted(map(tuple, QUERIES["join_merge_sorted"](spark, sf_dir).collect()))
    assert got == sorted(map(tuple, spark.sql(SQL["join_merge_sorted"]).collect())) and got
    assert spark.read.parquet(left).count() == 5
