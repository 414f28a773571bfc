"""Small Parquet files with several row groups, maps, missing columns and odd names."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq

D = lambda day, month=1: dt.date(2018, month, day)
TS = lambda day, **more: dt.datetime(2018, 1, day) + dt.timedelta(**more)


def write(path, groups):
    """One row group for each table."""
    with pq.ParquetWriter(path, groups[0].schema, compression="snappy") as out:
        for g in groups:
            out.write_table(g)
    return str(path)


def example1(folder):
    kinds = [("one", pa.int64()), ("two", pa.list_(pa.int64())), ("three", pa.string()), ("four", pa.timestamp("us")), ("five", pa.date32()), ("six", pa.bool_()), ("seven", pa.float64())]
    schema = pa.schema(kinds)
    first = [[1, 2, 3], [[1, 2, 3], [None, 5, 6], [7, 8, 9]], ["foo", "bar", "baz"], [TS(1), TS(2), TS(3)], [D(1), D(2), D(3)], [True, False, True], [0.5, None, 1.0]]
    second = [
        [4, 5, 6], [[10, 11, 12], [13, 14, 15], [16, 17, 18]], ["uno", "dos", "tres"],
        [TS(4, seconds=10), TS(5, milliseconds=10), TS(6, microseconds=10)], [D(4), D(5), D(6)], [False, False, False], [1.5, None, 2.0],
    ]
    return write(folder / "example1.parquet", [pa.table(x, schema=schema) for x in (first, second)])


def example2(folder):
    schema = pa.schema([("one", pa.int64()), ("two", pa.list_(pa.int64())), ("three", pa.string()), ("four", pa.timestamp("us")), ("five", pa.date32()), ("six", pa.bool_())])
    one = [[1, 3, 5, 7, 9], [[19, 20], [21, 22], [23, 24], [25, 26], [27, 28]], ["eins", "zwei", "drei", "vier", "fünf"], [TS(d) for d in (1, 3, 5, 7, 9)], [D(d) for d in (1, 3, 5, 7, 9)], [True, False, True, False, True]]
    return write(folder / "example2.parquet", [pa.table(one, schema=schema), pa.table([[]] * 6, schema=schema)])


def example3(folder):
    schema = pa.schema([("one", pa.map_(pa.int32(), pa.string())), ("two", pa.map_(pa.date32(), pa.int16())), ("three", pa.int32())])
    rows = [[[(1, "foo"), (2, "bar"), (3, "baz")], [(4, "test1"), (5, "test2")]], [[(D(1), 10), (D(2), 15)], [(D(3), 20), (D(4), 25)]], [1, 2]]
    return write(folder / "example3.parquet", [pa.table(rows, schema=schema)])


def example4(folder):
    schema = pa.schema([("jsonb_col", pa.map_(pa.int32(), pa.string())), ("array_col", pa.list_(pa.int32()))])
    return write(folder / "example4.parquet", [pa.table([[[(1, "a")], [(2, "b")]], [[1, 2], [3, 4]]], schema=schema)])


def part(folder, n):
    schema = pa.schema([("id", pa.int64()), ("date", pa.timestamp("us")), ("num", pa.int64())])
    dates = [dt.datetime(2018, n, d) for d in (1, 2, 3)]
    return write(folder / f"part{n}.parquet", [pa.table([[1, 1, 2], dates, [10, 23, 9]], schema=schema)])


def ftcol(folder):
    schema = pa.schema([("C 1", pa.int64()), ("c2", pa.int64()), ("c3", pa.string())])
    return write(folder / "ftcol.parquet", [pa.table([[1, 2, 3], [0, 1, 2], ["foo", "bar", "baz"]], schema=schema)])


def case_sensitive(folder):
    schema = pa.schema([("id", pa.int32()), ("UPPER", pa.string()), ("lower", pa.string()), ("MiXiNg", pa.string())])
    return write(folder / "case.parquet", [pa.table([[1, 2], ["A", "B"], ["a", "b"], ["Aa", "Bb"]], schema=schema)])


def simple(path, columns, rows, compression="snappy"):
    """columns: name to Arrow type."""
    schema = pa.schema(list(columns.items()))
    pq.write_table(pa.table([list(c) for c in zip(*rows)] if rows else [[] for _ in columns], schema=schema), path, compression=compression)
    return str(path)
