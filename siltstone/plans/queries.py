"""Queries over the driver's tables, one for each capability, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
import io
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions import compat
from siltstone.operators.modify import Modifier
from siltstone.plans.prune import Filter
from siltstone.session import configure, shared_folder, table
from siltstone.sources.catalog import Catalog
from siltstone.sources.document import Document
from siltstone.sources.files import Store
from siltstone.sources.table import ParquetTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Declared columns of the driver's tables.
COLUMNS: dict[str, dict[str, str]] = {
    "region": {"r_regionkey": "int4", "r_name": "text"},
    "nation": {"n_nationkey": "int4", "n_name": "text", "n_regionkey": "int4"},
    "customer": {"c_custkey": "int8", "c_name": "text", "c_nationkey": "int4", "c_acctbal": "float8", "c_mktsegment": "text"},
    "supplier": {"s_suppkey": "int8", "s_name": "text", "s_nationkey": "int4", "s_acctbal": "float8"},
    "part": {"p_partkey": "int8", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "int4", "p_retailprice": "float8"},
    "orders": {"o_orderkey": "int8", "o_custkey": "int8", "o_orderstatus": "text", "o_totalprice": "float8", "o_orderdate": "timestamp", "o_orderpriority": "text"},
    "lineitem": {
        "l_orderkey": "int8", "l_partkey": "int8", "l_suppkey": "int8", "l_linenumber": "int4", "l_quantity": "float8", "l_extendedprice": "float8",
        "l_discount": "float8", "l_tax": "float8", "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "timestamp",
    },
    "events": {"event_id": "int8", "ts": "timestamp", "user_id": "int8", "event_type": "text", "value": "float8", "props": "text"},
    "embeddings": {"vec_id": "int8", "embedding": "float4[]", "label": "int4"},
    "documents": {"doc_id": "int8", "text": "text", "lang": "text", "source": "text", "n_chars": "int8"},
    "labels": {"doc_id": "int8", "quality": "int4", "toxic": "int4"},
}


def declared(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, object] | None = None, **options: object) -> ParquetTable:
    """One of the driver's tables as a table of this engine; one file each, or a folder of files of one schema."""
    path = f"{sf_dir}/{name}.parquet"
    where = {"filename": [path]} if Store(spark).is_file(path) else {"dirname": path}
    return ParquetTable(spark, name, columns or COLUMNS[name], where | options, uniform_files=True)


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        SQL[name or f.__name__] = sql
        return f

    return register


def same_sql(name: str, sql: str, oracle: str | None = None, *tables: str) -> None:
    """A query given as Spark SQL over declared tables; where DuckDB spells it otherwise, `oracle`."""
    names = tables or tuple(t for t in COLUMNS if t in sql)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        catalog = Catalog(spark)
        catalog.tables.update({t: declared(spark, sf_dir, t) for t in names})
        return catalog.sql(sql)

    QUERIES[name], SQL[name] = run, oracle or sql


# -- scans and predicates ----------------------------------------------------------------------------------------------


@query("SELECT r_regionkey, r_name FROM region")
def scan_project_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared(spark, sf_dir, "region").df()


@query("SELECT n_nationkey AS id, n_name AS name, CAST(NULL AS BIGINT) AS missing, CAST(n_nationkey AS VARCHAR) AS again FROM nation")
def scan_column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """column_name, a column that no file has, two columns of one file column, a cast on read."""
    columns = {
        "id": ("int4", {"column_name": "n_nationkey"}), "name": ("text", {"column_name": "n_name"}),
        "missing": "int8", "again": ("text", {"column_name": "n_nationkey"}),
    }
    return declared(spark, sf_dir, "nation", columns).df()


@query(
    "SELECT c_custkey AS key, c_nationkey AS nationkey, c_acctbal AS acctbal, 'c' AS kind FROM customer"
    " UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, 's' FROM supplier"
)
def scan_multi_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of files with different columns: the present ones say which file a row is from."""
    paths = [f"{sf_dir}/customer.parquet", f"{sf_dir}/supplier.parquet"]
    columns = {
        "ck": ("int8", {"column_name": "c_custkey"}), "cn": ("int4", {"column_name": "c_nationkey"}), "ca": ("float8", {"column_name": "c_acctbal"}),
        "sk": ("int8", {"column_name": "s_suppkey"}), "sn": ("int4", {"column_name": "s_nationkey"}), "sa": ("float8", {"column_name": "s_acctbal"}),
    }
    df = ParquetTable(spark, "both", columns, {"files_func": lambda arg: arg, "files_func_arg": paths}).df()
    kind = F.when(F.col("ck").isNotNull(), "c").otherwise("s").alias("kind")
    return df.select(F.coalesce("ck", "sk").alias("key"), F.coalesce("cn", "sn").alias("nationkey"), F.coalesce("ca", "sa").alias("acctbal"), kind)


@query("SELECT count(*) AS n FROM lineitem")
def scan_count_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared(spark, sf_dir, "lineitem").df().agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey <= 1000 AND o_orderkey > 10")
def filter_rowgroup_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = [Filter("o_orderkey", "<=", 1000), Filter("o_orderkey", ">", 10)]
    return declared(spark, sf_dir, "orders").df(filters).select("o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.09 AND l_quantity < 5")
def filter_rowgroup_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = [Filter("l_discount", ">=", 0.09), Filter("l_quantity", "<", 5.0)]
    return declared(spark, sf_dir, "lineitem").df(filters).select("l_orderkey", "l_linenumber", "l_discount")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderpriority = '1-URGENT'")
def filter_rowgroup_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = declared(spark, sf_dir, "orders").df()
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    return df.where(early & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_orderdate")


@query("SELECT doc_id, quality FROM labels WHERE CAST(toxic AS BOOLEAN)")
def filter_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column read as another type than the file's."""
    columns = {"doc_id": "int8", "quality": "int4", "toxic": "bool"}
    return declared(spark, sf_dir, "labels", columns).df().where("toxic").select("doc_id", "quality")


@query("SELECT c_custkey FROM customer WHERE c_custkey < 0")
def filter_all_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared(spark, sf_dir, "customer").df([Filter("c_custkey", "<", 0)]).select("c_custkey")


same_sql(
    "null_predicates",
    "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    " WHERE l.quality IS NULL OR l.quality IS DISTINCT FROM 1",
)
same_sql(
    "predicates_between_in_like",
    "SELECT p_partkey, p_name FROM part WHERE p_size BETWEEN 5 AND 20 AND p_brand IN ('Brand#1', 'Brand#11', 'Brand#12', 'Brand#2', 'Brand#13')"
    " AND p_name LIKE '%a%'",
)
same_sql(
    "predicate_any_array",
    "SELECT n_nationkey, n_name FROM nation WHERE array_contains(array(1, 3, 5), n_regionkey)",
    "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = ANY([1, 3, 5])",
)
same_sql(
    "case_when",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS state,"
    " CASE WHEN o_totalprice > 200000 THEN CASE WHEN o_orderpriority LIKE '1%' THEN 2 ELSE 1 END ELSE 0 END AS size FROM orders",
)
same_sql(
    "arithmetic",
    "SELECT l_orderkey, l_linenumber, l_orderkey % 7 AS m, mod(l_partkey, 5) AS m2, l_orderkey div 3 AS d, l_returnflag || '-' || l_linestatus AS f,"
    " abs(l_discount - 0.05) AS a, sqrt(l_quantity) AS s, least(l_discount, l_tax) AS le FROM lineitem WHERE l_linenumber = 1",
    "SELECT l_orderkey, l_linenumber, l_orderkey % 7 AS m, l_partkey % 5 AS m2, l_orderkey // 3 AS d, l_returnflag || '-' || l_linestatus AS f,"
    " abs(l_discount - 0.05) AS a, sqrt(l_quantity) AS s, least(l_discount, l_tax) AS le FROM lineitem WHERE l_linenumber = 1",
)
same_sql(
    "string_functions",
    "SELECT p_partkey, upper(p_name) AS u, char_length(p_name) AS n, repeat(p_brand, 2) AS r, lpad(CAST(p_size AS STRING), 5, '0') AS padded FROM part",
    "SELECT p_partkey, upper(p_name) AS u, CAST(length(p_name) AS INTEGER) AS n, repeat(p_brand, 2) AS r, lpad(CAST(p_size AS VARCHAR), 5, '0') AS padded FROM part",
)
same_sql(
    "date_functions",
    "SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS d, coalesce(event_type, 'none') AS t FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-05'",
    "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, coalesce(event_type, 'none') AS t FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-05'",
)
same_sql("collation", "SELECT c_custkey FROM customer WHERE c_name COLLATE UTF8_BINARY >= 'Customer#000000100'", "SELECT c_custkey FROM customer WHERE c_name >= 'Customer#000000100'")
same_sql("constant_false", "SELECT c_custkey FROM customer WHERE 1 = 0")


@query("SELECT 'orders' AS tableoid, o_orderkey AS key, CAST(row_number() OVER () - 1 AS BIGINT) AS pos FROM orders WHERE o_orderkey IS NOT NULL")
def system_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's name and a row's place in its file."""
    df = declared(spark, sf_dir, "orders").df(positions=True)
    return df.select(F.lit("orders").alias("tableoid"), F.col("o_orderkey").alias("key"), F.col("__row").alias("pos"))


# -- joins -------------------------------------------------------------------------------------------------------------

same_sql(
    "join_inner",
    "SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment = 'BUILDING'",
)
same_sql(
    "join_threeway",
    "SELECT n.n_name, r.r_name, count(*) AS n FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"
    " JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY n.n_name, r.r_name",
    None, "customer", "nation", "region",
)
same_sql(
    "join_left",
    "SELECT c.c_custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_totalprice > 100000 GROUP BY c.c_custkey",
)
same_sql(
    "join_right",
    "SELECT n.n_name, s.s_name FROM supplier s RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey AND s.s_acctbal > 5000",
)
same_sql(
    "join_full",
    "SELECT a.c_custkey AS a, b.s_suppkey AS b FROM (SELECT c_custkey FROM customer WHERE c_custkey BETWEEN 50 AND 120) a"
    " FULL JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey BETWEEN 1 AND 80) b ON a.c_custkey = b.s_suppkey",
)
same_sql(
    "join_full_expression_key",
    "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a FULL JOIN nation b ON a.n_nationkey = b.n_nationkey + 1",
)
same_sql(
    "join_full_on_true",
    "SELECT a.r_name, b.n_name FROM region a FULL JOIN (SELECT n_name FROM nation WHERE n_nationkey < 4) b ON TRUE",
)
same_sql(
    "join_outer_on_where",
    "SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND c.c_custkey < 20"
    " WHERE o.o_totalprice IS NULL OR o.o_totalprice < 50000",
)
same_sql("join_cross", "SELECT r.r_name, n.n_name FROM region r CROSS JOIN nation n")
same_sql(
    "join_semi",
    "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')",
)
same_sql("join_anti", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice < 60000)")
same_sql(
    "join_theta",
    "SELECT a.r_name AS a, b.r_name AS b FROM region a JOIN region b ON a.r_regionkey < b.r_regionkey",
)
same_sql(
    "join_non_key_text",
    "SELECT a.s_suppkey AS a, b.c_custkey AS b FROM supplier a JOIN customer b ON substr(a.s_name, -3) = substr(b.c_name, -3) AND a.s_nationkey <> b.c_nationkey",
)
same_sql(
    "join_lateral",
    "SELECT n.n_name, x.top FROM nation n, LATERAL (SELECT max(s.s_acctbal) AS top FROM supplier s WHERE s.s_nationkey = n.n_nationkey) x",
)
same_sql(
    "join_self",
    "SELECT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_custkey < b.c_custkey AND a.c_mktsegment = b.c_mktsegment"
    " WHERE a.c_custkey < 200",
)
same_sql(
    "join_fiveway",
    "SELECT r.r_name, sum(l.l_quantity) AS q FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey"
    " JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name",
    None, "lineitem", "orders", "customer", "nation", "region",
)


def presorted(spark: SparkSession, sf_dir: str, name: str, key: str, buckets: int = 16) -> DataFrame:
    """One of the driver's tables as a copy dealt and sorted by its key, made at first use. Its name tells which files
    it was made from."""
    source = declared(spark, sf_dir, name, sorted=key)
    return source.presorted(f"presorted_{name}_{key}_{Store(spark).fingerprint(source.files())[:12]}", buckets)


@query("SELECT o.o_orderkey, l.l_linenumber FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE o.o_orderkey <= 2000")
def join_merge_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presorted tables joined by a merge: no shuffle and no sort."""
    o = presorted(spark, sf_dir, "orders", "o_orderkey").where("o_orderkey <= 2000")
    lines = presorted(spark, sf_dir, "lineitem", "l_orderkey")
    return o.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "l_linenumber")


@query("SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey")
def group_presorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by the key of a presorted table: no shuffle."""
    lines = presorted(spark, sf_dir, "lineitem", "l_orderkey")
    return lines.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


# -- aggregates --------------------------------------------------------------------------------------------------------

same_sql(
    "agg_basic",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS q, avg(l_extendedprice) AS a, min(l_discount) AS lo, max(l_tax) AS hi, stddev(l_quantity) AS sd"
    " FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS q, avg(l_extendedprice) AS a, min(l_discount) AS lo, max(l_tax) AS hi, stddev(l_quantity) AS sd"
    " FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus",
)
same_sql("agg_group_expression", "SELECT o_custkey % 10 AS k, count(*) AS n FROM orders GROUP BY 1")
same_sql("agg_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12 AND avg(o_totalprice) > 1000")
same_sql("agg_distinct_rows", "SELECT DISTINCT count(*) AS n FROM orders GROUP BY o_custkey")
same_sql(
    "agg_filter",
    "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, sum(o_totalprice) FILTER (WHERE o_totalprice < 100000) AS s FROM orders GROUP BY o_orderpriority",
)
same_sql(
    "agg_sum_distinct_filter",
    "SELECT sum(DISTINCT l_linenumber) FILTER (WHERE l_quantity > 10) AS s, count(DISTINCT l_suppkey) AS n FROM lineitem",
    "SELECT CAST(sum(DISTINCT l_linenumber) FILTER (WHERE l_quantity > 10) AS BIGINT) AS s, count(DISTINCT l_suppkey) AS n FROM lineitem",
)
for _name, _clause in {
    "agg_rollup": "ROLLUP (r_name, n_name)",
    "agg_cube": "CUBE (r_name, n_name)",
    "agg_grouping_sets": "GROUPING SETS ((r_name), (n_name), ())",
}.items():
    same_sql(
        _name,
        f"SELECT r_name, n_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY {_clause}",
        None, "nation", "region",
    )
same_sql(
    "agg_grouping_function",
    "SELECT n_regionkey, CAST(grouping(n_regionkey) AS INT) AS g, count(*) AS n FROM nation GROUP BY ROLLUP (n_regionkey)",
)
same_sql(
    "agg_percentile",
    "SELECT c_mktsegment, percentile_cont(0.25) WITHIN GROUP (ORDER BY c_acctbal) AS p FROM customer GROUP BY c_mktsegment",
)
same_sql("agg_over_union", "SELECT count(*) AS n, sum(k) AS s FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) u", "SELECT count(*) AS n, CAST(sum(k) AS BIGINT) AS s FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) u")
same_sql(
    "agg_scalar_subquery",
    "SELECT n_name, (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS n FROM nation n",
)


@query(
    "SELECT c_mktsegment, CAST(count(*) FILTER (WHERE c_acctbal < 1000) + 1 AS BIGINT) AS r FROM customer GROUP BY c_mktsegment"
)
def agg_hypothetical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = declared(spark, sf_dir, "customer").df()
    return df.groupBy("c_mktsegment").agg(compat.hypothetical_rank(1000, F.col("c_acctbal")).alias("r"))


@query(
    "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name DESC) AS names, string_agg(DISTINCT CAST(n_nationkey % 2 AS VARCHAR), ',' ORDER BY CAST(n_nationkey % 2 AS VARCHAR)) AS odd"
    " FROM nation GROUP BY n_regionkey"
)
def agg_array_agg_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = declared(spark, sf_dir, "nation").df()
    names = compat.array_agg(F.col("n_name"), descending=True)
    odd = compat.array_agg((F.col("n_nationkey") % 2).cast("string"), distinct=True)
    return df.groupBy("n_regionkey").agg(F.array_join(names, ",").alias("names"), F.array_join(odd, ",").alias("odd"))


@query("SELECT n_regionkey, min(least(n_nationkey, n_regionkey)) AS m FROM nation GROUP BY n_regionkey")
def agg_user_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = declared(spark, sf_dir, "nation").df()
    return df.groupBy("n_regionkey").agg(compat.least_agg([F.col("n_nationkey"), F.col("n_regionkey")]).alias("m"))


# -- windows, order, sets ----------------------------------------------------------------------------------------------

same_sql(
    "win_count",
    "SELECT o_custkey, count(*) AS n, count(*) OVER (PARTITION BY o_custkey % 5) AS w FROM orders GROUP BY o_custkey",
)


@query(
    "SELECT n_nationkey, array_to_string(array_agg(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC), ',') AS a FROM nation"
)
def win_array_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("n_regionkey").orderBy(F.desc("n_nationkey"))
    df = declared(spark, sf_dir, "nation").df()
    return df.select("n_nationkey", F.array_join(F.collect_list("n_nationkey").over(w).cast("array<string>"), ",").alias("a"))


@query(
    "SELECT n_nationkey, CAST(sum(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS s FROM nation"
)
def win_range_following(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    return declared(spark, sf_dir, "nation").df().select("n_nationkey", F.sum("n_nationkey").over(w).alias("s"))


same_sql(
    "win_rank",
    "SELECT o_orderkey, rank() OVER w AS r, dense_rank() OVER w AS d, lag(o_orderkey) OVER w AS p FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
    "SELECT o_orderkey, CAST(rank() OVER w AS INTEGER) AS r, CAST(dense_rank() OVER w AS INTEGER) AS d, lag(o_orderkey) OVER w AS p FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
)
same_sql(
    "topk_offset",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 100",
)


def _by_quality(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    d, lab = declared(spark, sf_dir, "documents").df(), declared(spark, sf_dir, "labels").df()
    return compat.with_position(compat.ordered(d.join(lab, "doc_id", "left").select("doc_id", "quality"), *keys))


@query(
    "SELECT CAST(row_number() OVER (ORDER BY l.quality ASC NULLS LAST, d.doc_id DESC) - 1 AS BIGINT) AS pos, d.doc_id, l.quality"
    " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
def nulls_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row in ascending order, nulls last by default, with its position."""
    return _by_quality(spark, sf_dir, "quality", "doc_id desc")


@query(
    "SELECT CAST(row_number() OVER (ORDER BY l.quality DESC NULLS FIRST, d.doc_id) - 1 AS BIGINT) AS pos, d.doc_id, l.quality"
    " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
def nulls_order_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row in descending order, nulls first by default, with its position."""
    return _by_quality(spark, sf_dir, "quality desc", "doc_id")


@query("SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS pos, o_orderkey, o_totalprice FROM orders")
def sorted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a table in the order of its sorted column, with its position."""
    t = declared(spark, sf_dir, "orders", sorted="o_orderkey")
    return compat.with_position(t.in_sorted_order().select("o_orderkey", "o_totalprice"))


@query(
    "SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity) - 1 AS BIGINT) AS pos, l_orderkey, l_linenumber, l_quantity FROM lineitem"
)
def sorted_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a table sorted by three columns, with its position; quantities put repeated keys in order."""
    t = declared(spark, sf_dir, "lineitem", sorted="l_orderkey l_linenumber l_quantity")
    return compat.with_position(t.in_sorted_order().select("l_orderkey", "l_linenumber", "l_quantity"))


same_sql("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
same_sql("union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
same_sql("intersect", "SELECT c_custkey AS k FROM customer INTERSECT SELECT s_suppkey FROM supplier")
same_sql("except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice < 60000")
same_sql(
    "cte",
    "WITH big AS (SELECT o_custkey, sum(o_totalprice) AS t FROM orders GROUP BY o_custkey), top AS (SELECT max(t) AS m FROM big)"
    " SELECT b.o_custkey, b.t FROM big b, top WHERE b.t > top.m * 0.8",
)
same_sql(
    "subquery_in",
    "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) AND s_acctbal > (SELECT avg(s_acctbal) FROM supplier)",
)
same_sql("values", "SELECT n.n_name, t.j FROM nation n JOIN (VALUES (1, 'a'), (2, 'b'), (30, 'c')) AS t(i, j) ON n.n_nationkey = t.i")


@query("SELECT o_orderkey FROM orders WHERE o_custkey = 7 AND o_totalprice > 1000")
def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = Catalog(spark)
    catalog.tables["orders"] = declared(spark, sf_dir, "orders")
    return catalog.sql("SELECT o_orderkey FROM orders WHERE o_custkey = :c AND o_totalprice > :p", {"c": 7, "p": 1000})


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")
def view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = Catalog(spark)
    catalog.tables["customer"] = declared(spark, sf_dir, "customer")
    catalog.create_view("rich", "SELECT * FROM customer WHERE c_acctbal > 0")
    return catalog.sql("SELECT c_mktsegment, count(*) AS n FROM rich GROUP BY c_mktsegment")


@query("SELECT CAST(i AS BIGINT) AS i, lpad(CAST(i AS VARCHAR), 5, '0') AS c FROM generate_series(1, 20) AS g(i)")
def generate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compat.generate_series(spark, 1, 20, name="i").select("i", compat.to_char_padded(F.col("i"), 5).alias("c"))


# -- documents ---------------------------------------------------------------------------------------------------------


def documents_of(spark: SparkSession, sf_dir: str, name: str) -> Document:
    return Document(declared(spark, sf_dir, name, {"v": "jsonb"}, schemaless="true"))


@query("SELECT o_orderkey AS k, CAST(o_orderstatus AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS nope FROM orders")
def doc_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = documents_of(spark, sf_dir, "orders")
    return doc.df().select(doc.get("o_orderkey").alias("k"), doc.text("o_orderstatus").alias("s"), doc.text("nope").alias("nope"))


@query("SELECT o_orderkey AS k FROM orders WHERE CAST(o_custkey AS INTEGER) = 11 AND o_totalprice > 1000")
def doc_cast_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = documents_of(spark, sf_dir, "orders")
    return doc.df().where((doc.cast("int4", "o_custkey") == 11) & (doc.cast("float8", "o_totalprice") > 1000)).select(doc.get("o_orderkey").alias("k"))


@query("SELECT vec_id AS k, embedding[2] AS x, embedding[1000] AS y FROM embeddings")
def doc_nested_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = documents_of(spark, sf_dir, "embeddings")
    return doc.df().select(doc.get("vec_id").alias("k"), doc.get("embedding", 1).alias("x"), doc.get("embedding", 999).alias("y"))


@query("SELECT s_suppkey AS k FROM supplier")
def doc_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of different columns; only those with the key have rows."""
    paths = [f"{sf_dir}/supplier.parquet", f"{sf_dir}/nation.parquet"]
    options = {"files_func": lambda arg: arg, "files_func_arg": paths, "schemaless": "true"}
    doc = Document(ParquetTable(spark, "mixed", {"v": "jsonb"}, options))
    return doc.df().where(doc.has("s_suppkey")).select(doc.get("s_suppkey").alias("k"))


@query('SELECT \'{"r_name": "\' || r_name || \'", "r_regionkey": \' || r_regionkey || \'}\' AS j FROM region')
def doc_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = documents_of(spark, sf_dir, "region")
    return doc.df().select(doc.json().alias("j"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) > 50")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = declared(spark, sf_dir, "events").df()
    return df.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k")).where("k > 50")


# -- changes: on a copy, whose rows are returned -----------------------------------------------------------------------


def scratch(spark: SparkSession) -> str:
    """A folder for copies that statements change, in the folder that all executors share."""
    return f"{shared_folder(spark)}/changes-{uuid.uuid4().hex}"


def copied(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, object], files: int = 1, **options: object) -> ParquetTable:
    folder = scratch(spark)
    table(spark, sf_dir, name).repartitionByRange(files, list(columns)[0]).write.parquet(folder)
    return ParquetTable(spark, name, columns, {"dirname": folder} | options)


SUPPLIER = COLUMNS["supplier"] | {"s_suppkey": ("int8", {"key": "true"})}


@query("SELECT * FROM supplier UNION ALL SELECT 100001, 'new', 3, CAST(NULL AS DOUBLE) UNION ALL SELECT s_suppkey + 200000, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_nationkey = 1")
def insert_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = copied(spark, sf_dir, "supplier", SUPPLIER, 2)
    m = Modifier(t)
    m.insert(t.df().where("s_nationkey = 1").withColumn("s_suppkey", F.col("s_suppkey") + 200000))
    m.insert([{"s_suppkey": 100001, "s_name": "new", "s_nationkey": 3}])
    return t.df()


@query("SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN upper(s_name) ELSE s_name END AS s_name, s_nationkey, CASE WHEN s_acctbal < 0 THEN s_acctbal * 2 ELSE s_acctbal END AS s_acctbal FROM supplier")
def update_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = copied(spark, sf_dir, "supplier", SUPPLIER, 2)
    Modifier(t).update({"s_name": F.upper("s_name"), "s_acctbal": F.col("s_acctbal") * 2}, F.col("s_acctbal") < 0)
    return t.df()


@query("SELECT s.* REPLACE (n.n_name AS s_name) FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE n.n_regionkey = 2 UNION ALL SELECT s.* FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE n.n_regionkey <> 2")
def update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = copied(spark, sf_dir, "supplier", SUPPLIER)
    nation = declared(spark, sf_dir, "nation").df()
    Modifier(t).update({"s_name": F.col("n_name")}, F.col("n_regionkey") == 2, source=nation, on=F.col("s_nationkey") == F.col("n_nationkey"))
    return t.df()


@query("SELECT * FROM supplier WHERE NOT (s_nationkey < 10)")
def delete_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = copied(spark, sf_dir, "supplier", SUPPLIER, 2)
    Modifier(t).delete(F.col("s_nationkey") < 10)
    return t.df()


@query("SELECT s.* FROM supplier s WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def delete_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = copied(spark, sf_dir, "supplier", SUPPLIER)
    nation = declared(spark, sf_dir, "nation").df().where("n_regionkey = 2")
    Modifier(t).delete(source=nation, on=F.col("s_nationkey") == F.col("n_nationkey"))
    return t.df()


@query(
    "SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS BIGINT) AS pos, s_suppkey FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT -5 UNION ALL SELECT 1000000) t"
)
def sorted_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows take their places in a sorted file."""
    t = copied(spark, sf_dir, "supplier", SUPPLIER, 1, sorted="s_suppkey")
    m = Modifier(t)
    m.delete(F.col("s_suppkey").isNotNull())
    m.insert(declared(spark, sf_dir, "supplier").df())
    m.insert([{"s_suppkey": 1000000}, {"s_suppkey": -5}])
    return t.df(positions=True).select(F.col("__row").alias("pos"), "s_suppkey")


BY_YEAR = "SELECT o_orderkey, o_orderdate FROM {} WHERE o_orderdate >= TIMESTAMP '1995-06-01' AND o_orderdate < TIMESTAMP '1996-03-01'"


def by_year(spark: SparkSession, sf_dir: str) -> Catalog:
    """Ranges of years over one table."""
    catalog = Catalog(spark)
    catalog.tables["orders"] = declared(spark, sf_dir, "orders")
    years = [(None, "1993-01-01"), *[(f"{y}-01-01", f"{y + 1}-01-01") for y in range(1993, 1999)], ("1999-01-01", None)]
    catalog.create_partitioned("by_year", "o_orderdate", [("orders", low, high) for low, high in years])
    return catalog


@query(BY_YEAR.format("orders"))
def part_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter leaves two of eight parts; the others aren't scanned."""
    filters = [Filter("o_orderdate", ">=", dt.datetime(1995, 6, 1)), Filter("o_orderdate", "<", dt.datetime(1996, 3, 1))]
    return by_year(spark, sf_dir).tables["by_year"].df(filters).select("o_orderkey", "o_orderdate")


@query(BY_YEAR.format("orders"))
def part_prune_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by SQL."""
    return by_year(spark, sf_dir).sql(BY_YEAR.format("by_year").replace("TIMESTAMP", "TIMESTAMP_NTZ"))


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def import_then_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = Catalog(spark)
    for name in ("nation", "region"):
        catalog.import_parquet(name, lambda arg: [f"{arg[0]}/{arg[1]}.parquet"], (sf_dir, name))
    return catalog.sql("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")


@query("SELECT CAST(count(*) AS BIGINT) AS rows, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer")
def analyze(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = declared(spark, sf_dir, "customer").statistics()
    return s.select("rows", F.col("c_acctbal_min").cast("double").alias("lo"), F.col("c_acctbal_max").cast("double").alias("hi"))


# -- capabilities that need files of their own ---------------------------------------------------------------------------


def files_of(spark: SparkSession, *parts: DataFrame, codec: str = "snappy") -> list[str]:
    """Each DataFrame as one file; their paths."""
    folder, store, out = scratch(spark), Store(spark), []
    for i, part in enumerate(parts):
        part.coalesce(1).write.option("compression", codec).parquet(f"{folder}/{i}")
        out += store.list_files(f"{folder}/{i}")
    return out


def arrow_file(spark: SparkSession, arrow_table) -> str:
    """A small file with types that Spark doesn't write."""
    import pyarrow.parquet as pq

    held, path = io.BytesIO(), f"{scratch(spark)}/x.parquet"
    pq.write_table(arrow_table, held)
    Store(spark).write_bytes(path, held.getvalue())
    return path


@query("SELECT n_nationkey + 2999999990 AS x FROM nation WHERE n_nationkey >= 20 OR n_nationkey + 2999999990 >= 3000000000")
def prune_unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsigned numbers, whose statistics look negative as signed ones."""
    import pyarrow as pa

    keys = [r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect()]
    path = arrow_file(spark, pa.table({"x": pa.array([k + 2_999_999_990 for k in keys], pa.uint32())}))
    return ParquetTable(spark, "t", {"x": "int8"}, {"filename": [path]}).df([Filter("x", ">=", 3_000_000_000)])


@query("SELECT CAST(trunc(s_acctbal) AS INTEGER) AS x FROM supplier WHERE trunc(s_acctbal) = (SELECT trunc(max(s_acctbal)) FROM supplier)")
def prune_cast_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions read as whole numbers: a file's greatest value isn't the greatest that is read."""
    most = int(table(spark, sf_dir, "supplier").agg(F.max("s_acctbal")).first()[0])
    columns = {"x": ("int4", {"column_name": "s_acctbal"})}
    return declared(spark, sf_dir, "supplier", columns).df([Filter("x", "=", most)])


@query("SELECT CAST(max(o_orderdate) AS DATE) AS d, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")
def prune_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times read as dates; the last of the day was after midnight."""
    orders = table(spark, sf_dir, "orders").withColumn("t", F.col("o_orderdate") + F.expr("INTERVAL 10 HOURS"))
    last = orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]
    t = ParquetTable(spark, "t", {"d": ("date", {"column_name": "t"})}, {"filename": files_of(spark, orders)})
    return t.df([Filter("d", "=", last)]).groupBy("d").agg(F.count("*").alias("n"))


@query("SELECT event_id AS k, value AS v FROM events WHERE event_type = 'click'")
def map_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose map has a key, and the value under it."""
    events = table(spark, sf_dir, "events").select("event_id", F.create_map("event_type", "value").alias("m"))
    doc = Document(ParquetTable(spark, "t", {"v": "jsonb"}, {"filename": files_of(spark, events), "schemaless": "true"}))
    return doc.df([Filter("m", "?", "click")]).select(doc.get("event_id").alias("k"), doc.get("m", "click").alias("v"))


@query("SELECT 'low' AS file, 1 AS groups UNION ALL SELECT 'high', 0")
def explain_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many row groups of each file a filter leaves."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    paths = files_of(spark, orders.where("o_orderkey < 100"), orders.where("o_orderkey >= 100"))
    plan = ParquetTable(spark, "t", {"o_orderkey": "int8"}, {"filename": paths}).explain_scan([Filter("o_orderkey", "<", 50)])
    return spark.createDataFrame([(name, len(f.groups)) for name, f in zip(("low", "high"), plan.files, strict=True)], "file string, groups int")


@query("SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS pos, n_nationkey AS k FROM (SELECT * FROM nation WHERE n_regionkey = 2 UNION ALL SELECT * FROM nation WHERE n_regionkey = 0) t")
def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows file by file, in the order of the list."""
    nation = table(spark, sf_dir, "nation")
    paths = files_of(spark, nation.where("n_regionkey = 2"), nation.where("n_regionkey = 0"))
    rows = ParquetTable(spark, "t", {"k": ("int4", {"column_name": "n_nationkey"})}, {"filename": paths}).in_file_order()
    return compat.with_position(rows)


@query("SELECT c AS codec, r_name FROM region, (VALUES ('gzip'), ('none'), ('snappy'), ('zstd')) v(c)")
def codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, out = table(spark, sf_dir, "region"), None
    for codec in ("gzip", "none", "snappy", "zstd"):
        t = ParquetTable(spark, "t", {"r_name": "text"}, {"filename": files_of(spark, region, codec=codec)})
        part = t.df().select(F.lit(codec).alias("codec"), "r_name")
        out = part if out is None else out.union(part)
    return out


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey < 50")
def empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without rows are left out."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey")
    paths = files_of(spark, supplier.limit(0), supplier, supplier.limit(0))
    return ParquetTable(spark, "t", {"s_suppkey": "int8"}, {"filename": paths}).df([Filter("s_suppkey", "<", 50)])


@query("SELECT 'zstd' AS codec, count(*) AS n FROM supplier UNION ALL SELECT 'snappy', 1")
def compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column's codec goes before the table's and before that of the file; a new file takes the table's."""
    from siltstone.sources.footers import read_footer

    columns = SUPPLIER | {"s_name": ("text", {"compression_type": "zstd"})}
    (path,) = files_of(spark, table(spark, sf_dir, "supplier"), codec="none")
    kept = ParquetTable(spark, "t", columns, {"filename": [path], "compression_type": "snappy"})
    Modifier(kept).update({"s_acctbal": F.col("s_acctbal")}, F.col("s_suppkey") == 1)
    fresh = ParquetTable(spark, "t", SUPPLIER, {"dirname": scratch(spark), "compression_type": "snappy"})
    Store(spark).make_folder(fresh.options.dirname)
    Modifier(fresh).insert([{"s_suppkey": 1}])
    rows = [(read_footer(spark, t.files()[0]).codec, t.df().count()) for t in (kept, fresh)]
    return spark.createDataFrame(rows, "codec string, n long")


@query("SELECT concat('r', n_regionkey, '.parquet') AS file, count(*) AS n, min(n_name) AS first FROM nation GROUP BY ALL")
def insert_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selector names the file of each new row."""
    options = {"dirname": scratch(spark), "insert_file_selector": "concat(dirname, '/r', n_regionkey, '.parquet')"}
    Store(spark).make_folder(options["dirname"])
    t = ParquetTable(spark, "t", COLUMNS["nation"], options)
    Modifier(t).insert(declared(spark, sf_dir, "nation").df())
    rows = t.df(positions=True).groupBy(F.substring_index("__file", "/", -1).alias("file"))
    return rows.agg(F.count("*").alias("n"), F.min("n_name").alias("first"))


@query("SELECT CAST(n_nationkey AS DOUBLE) AS k, n_name AS name, CAST(n_regionkey AS DOUBLE) AS second FROM nation UNION ALL SELECT 99, NULL, NULL")
def insert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents with a map and a list become a file's map and list."""
    folder = scratch(spark)
    Store(spark).make_folder(folder)
    t = ParquetTable(spark, "t", {"v": "jsonb"}, {"dirname": folder, "schemaless": "true", "key_columns": "k"})
    nation = declared(spark, sf_dir, "nation").df()
    row = F.struct(F.col("n_nationkey").alias("k"), F.create_map(F.lit("name"), "n_name").alias("m"), F.array(F.lit(1), "n_regionkey").alias("l"))
    Modifier(t).insert(nation.select(F.to_json(row)))
    Modifier(t).insert([{"k": 99}])
    doc = Document(t)
    return doc.df().select(doc.get("k").alias("k"), doc.get("m", "name").alias("name"), doc.get("l", 1).alias("second"))


@query("SELECT n_name AS a, CAST(n_nationkey AS BIGINT) AS b FROM nation")
def import_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns named by hand over the files of a function."""
    catalog = Catalog(spark)
    catalog.import_parquet_explicit("n", ["n_name", "n_nationkey"], ["text", "int8"], lambda arg: [f"{arg}/nation.parquet"], sf_dir)
    return catalog.sql("SELECT n_name AS a, n_nationkey AS b FROM n")


@query("SELECT count(*) AS tables, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM nation UNION ALL SELECT count(*) FROM region) t")
def import_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each file of a folder, but one."""
    folder = scratch(spark)
    for name in ("nation", "region", "supplier"):
        (path,) = files_of(spark, table(spark, sf_dir, name))
        Store(spark).make_folder(folder)
        Store(spark).replace(path, f"{folder}/{name}.parquet")
    catalog = Catalog(spark)
    made = catalog.import_foreign_schema(folder, except_=["supplier"])
    counts = catalog.sql(" UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in made))
    return counts.agg(F.count("*").alias("tables"), F.sum("n").alias("rows"))


@query("SELECT r_regionkey AS k, upper(CASE WHEN r_regionkey = 1 THEN 'changed' ELSE r_name END) AS loud, 'none' AS note FROM region")
def generated_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A default, and a column worked out again at each change."""
    folder = scratch(spark)
    Store(spark).make_folder(folder)
    t = ParquetTable(spark, "t", {"k": ("int4", {"key": "true"}), "name": "text"}, {"dirname": folder})
    t.add_column("loud", "text", generated="upper(name)")
    t.add_column("note", "text", default="none")
    region = declared(spark, sf_dir, "region").df()
    Modifier(t).insert(region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")))
    Modifier(t).update({"name": F.lit("changed")}, F.col("k") == 1)
    return t.df().select("k", "loud", "note")


@query("SELECT s_suppkey, CASE WHEN s_suppkey < 10 THEN 'x' ELSE s_name END AS s_name FROM supplier WHERE s_suppkey >= 5")
def change_through_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = Catalog(spark)
    catalog.tables["s"] = copied(spark, sf_dir, "supplier", SUPPLIER)
    catalog.create_view("all_of_s", "SELECT * FROM s")
    catalog.update("all_of_s", {"s_name": F.lit("x")}, F.col("s_suppkey") < 10)
    catalog.delete("all_of_s", F.col("s_suppkey") < 5)
    return catalog.sql("SELECT s_suppkey, s_name FROM all_of_s")


@query("SELECT v.n_name, w.r_name FROM nation v JOIN region w ON v.n_regionkey = w.r_regionkey WHERE v.n_nationkey > 5 AND w.r_regionkey < 3")
def join_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join of two views, one over the other's kind of name."""
    catalog = Catalog(spark)
    catalog.tables.update({t: declared(spark, sf_dir, t) for t in ("nation", "region")})
    catalog.create_view("late", "SELECT n_name, n_regionkey FROM nation WHERE n_nationkey > 5")
    catalog.create_view("low", "SELECT r_name, r_regionkey AS low FROM region WHERE r_regionkey < 3")
    return catalog.sql("SELECT n_name, r_name FROM late JOIN low ON n_regionkey = low")


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 <> 0")
def change_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT deals rows over parts by their range; UPDATE and DELETE reach all parts."""
    catalog, store = Catalog(spark), Store(spark)
    for name in ("low", "high"):
        folder = scratch(spark)
        store.make_folder(folder)
        catalog.create_table(name, SUPPLIER, dirname=folder)
    parts = catalog.create_partitioned("s", "s_suppkey", [("low", None, 40), ("high", 40, None)])
    schema = declared(spark, sf_dir, "supplier").df()
    parts.insert(schema)
    parts.update({"s_name": F.lit("gone")}, F.col("s_suppkey") % 7 == 0)
    parts.delete(F.col("s_name") == "gone")
    return parts.df().select("s_suppkey")


@query("SELECT 'made' AS step, 0 AS n UNION ALL SELECT 'filled', 1 UNION ALL SELECT 'dropped', 0")
def datasource(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty file is made for a table, filled, and dropped."""
    folder, catalog = scratch(spark), Catalog(spark)
    Store(spark).make_folder(folder)
    t = ParquetTable(spark, "t", {"k": "int4"}, {"dirname": folder})
    catalog.tables["t"] = t
    catalog.create_datasource("t")
    rows = [("made", t.df().count())]
    catalog.insert("t", [{"k": 1}])
    rows.append(("filled", t.df().count()))
    catalog.drop_datasource("t")
    rows.append(("dropped", len(t.files())))
    return spark.createDataFrame(rows, "step string, n int")


@query("SELECT c_mktsegment, CAST(sum(c_nationkey) % 97 AS BIGINT) AS u FROM customer WHERE c_nationkey * 2 > 10 GROUP BY c_mktsegment")
def user_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function and an aggregate of the user's own in SQL."""
    spark.udf.register("sum_97", F.pandas_udf(lambda x: int(x.sum()) % 97, "long", F.PandasUDFType.GROUPED_AGG))
    spark.udf.register("twice", F.pandas_udf(lambda x: x * 2, "long", F.PandasUDFType.SCALAR))
    catalog = Catalog(spark)
    catalog.tables["customer"] = declared(spark, sf_dir, "customer")
    # aggregates in Python take whole groups; here of one row a nation and segment
    return catalog.sql(
        "SELECT c_mktsegment, sum_97(s) AS u FROM (SELECT c_mktsegment, sum(c_nationkey) AS s FROM customer"
        " WHERE twice(c_nationkey) > 10 GROUP BY c_mktsegment, c_nationkey) GROUP BY c_mktsegment"
    )


same_sql("random", "SELECT count(*) AS n FROM orders WHERE rand() >= 0", "SELECT count(*) AS n FROM orders WHERE random() >= 0")
same_sql(
    "agg_outer_in_subquery",
    "WITH c AS (SELECT c_nationkey, count(*) AS m FROM customer GROUP BY c_nationkey)"
    " SELECT n_name, m, (SELECT count(*) FROM supplier s WHERE s.s_nationkey = c_nationkey AND s.s_suppkey > m) AS more FROM c JOIN nation ON n_nationkey = c_nationkey",
    "SELECT n_name, m, more FROM (SELECT c_nationkey, count(*) AS m, (SELECT count(*) FROM supplier s WHERE s.s_nationkey = c_nationkey AND s.s_suppkey > count(c_custkey)) AS more"
    " FROM customer c GROUP BY c_nationkey) x JOIN nation ON n_nationkey = c_nationkey",
    "customer", "nation", "supplier",
)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["agg_basic"](configure(spark), sf_dir)
