"""What the SQL dialect of the tables' users has and Spark SQL spells differently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import shared_folder


def ordered(df: DataFrame, *keys: str, nulls: str | None = None) -> DataFrame:
    """ORDER BY with the defaults nulls last for ascending and nulls first for descending keys ("name desc")."""
    out = []
    for key in keys:
        name, _, way = key.partition(" ")
        c, down = F.col(name), way.strip().lower() == "desc"
        last = nulls == "last" if nulls else not down
        out.append((c.desc_nulls_last() if last else c.desc_nulls_first()) if down else (c.asc_nulls_last() if last else c.asc_nulls_first()))
    return df.orderBy(*out)


def with_position(df: DataFrame, name: str = "pos") -> DataFrame:
    """df with the position of each row from 0, in the order that df has. Only a count a partition goes to the driver."""
    shared_folder(df.sparkSession)
    fixed = df.checkpoint(eager=True)  # partitions stay as they are from here on
    part, at = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    starts, total = {}, 0
    for p, n in sorted(fixed.groupBy(part.alias("p")).count().collect()):
        starts[p], total = total, total + n
    offset = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in starts.items() for x in pair]), part.cast("long")) if starts else F.lit(0)
    return fixed.select((at + offset).cast("long").alias(name), "*")


def array_agg(value: Column, order_by: Column | None = None, descending: bool = False, nulls_last: bool = True, distinct: bool = False) -> Column:
    """array_agg with an order inside; null values stay. Nulls of the order go last, or first on request."""
    key = value if order_by is None else order_by
    row = F.struct(key.alias("k"), value.alias("v"))
    rows = F.collect_set(row) if distinct else F.collect_list(row)

    def compare(a: Column, b: Column) -> Column:
        first, second = (F.lit(1), F.lit(-1)) if nulls_last else (F.lit(-1), F.lit(1))
        less, more = (F.lit(1), F.lit(-1)) if descending else (F.lit(-1), F.lit(1))
        return (
            F.when(a["k"].isNull() & b["k"].isNull(), 0)
            .when(a["k"].isNull(), first)
            .when(b["k"].isNull(), second)
            .when(a["k"] < b["k"], less)
            .when(a["k"] > b["k"], more)
            .otherwise(0)
        )

    return F.transform(F.array_sort(rows, compare), lambda x: x["v"])


def hypothetical_rank(value: object, *args: Column) -> Column:
    """rank(value) WITHIN GROUP (ORDER BY arg): the rank that a row of this value would have in its group."""
    return F.count_if(args[0] < F.lit(value)) + 1


def int_div(a: Column, b: Column) -> Column:
    """Division of integers, truncated towards zero."""
    return F.call_function("div", a, b)


def generate_series(spark, start: int, stop: int, step: int = 1, name: str = "generate_series") -> DataFrame:
    """Numbers from start to stop, both included."""
    end = stop + (1 if step > 0 else -1)
    return spark.range(start, end, step).withColumnRenamed("id", name)


def subscript(array: Column, index: int) -> Column:
    """array[index], counted from 1; null outside."""
    return F.try_element_at(array, F.lit(index)) if index > 0 else F.lit(None)


def any_of(value: Column, array: Column) -> Column:
    """value = ANY(array)."""
    return F.array_contains(array, value)


def least_agg(columns: Sequence[Column]) -> Column:
    """The least of all values of several columns over a group; nulls don't count."""
    return F.min(F.least(*columns) if len(columns) > 1 else columns[0])


def to_char_padded(value: Column, digits: int) -> Column:
    """to_char(value, 'FM000'): zeros in front up to so many digits."""
    return F.concat(F.when(value < 0, "-").otherwise(""), F.lpad(F.abs(value).cast("string"), digits, "0"))
