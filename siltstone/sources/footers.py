"""Parquet footers: schemas, row groups, statistics.

Few files are read on the driver by Spark's own Parquet library, so that any store works. Many are read in tasks, which
hand back a line a file: what of it a filter leaves, not its statistics. Files of stores that Python can't reach in a task
are read on the driver after all."""

from __future__ import annotations

import datetime as dt
import json
import struct
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession

from siltstone.sources.files import Store

EPOCH = dt.date(1970, 1, 1)


@dataclass
class ColumnStats:
    low: object = None
    high: object = None
    nulls: int | None = None
    values: int = 0
    codec: str = ""
    kind: str = ""  # as types.kind_of() calls it; empty for types that aren't compared


@dataclass
class RowGroup:
    rows: int
    columns: dict[str, ColumnStats] = field(default_factory=dict)


@dataclass
class Footer:
    path: str
    schema_text: str
    names: tuple[str, ...]
    groups: list[RowGroup]

    @property
    def codec(self) -> str | None:
        """The codec of the first column, in Spark's spelling."""
        for group in self.groups:
            for stats in group.columns.values():
                return stats.codec.lower()
        return None


def read_footer(spark: SparkSession, path: str, stats: bool = True) -> Footer:
    store = Store(spark)
    jvm = store.jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(store.path(path), store.conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        schema = reader.getFileMetaData().getSchema()
        names = tuple(schema.getFieldName(i) for i in range(schema.getFieldCount()))
        groups = []
        for block in reader.getFooter().getBlocks():
            group = RowGroup(block.getRowCount())
            for chunk in block.getColumns() if stats else ():
                group.columns[chunk.getPath().toDotString()] = _stats(chunk)
            groups.append(group)
        return Footer(path, schema.toString(), names, groups)
    finally:
        reader.close()


def _stats(chunk) -> ColumnStats:
    found = ColumnStats(values=chunk.getValueCount(), codec=chunk.getCodec().name())
    s = chunk.getStatistics()
    if s is None or s.isEmpty():
        return found
    if s.isNumNullsSet():
        found.nulls = s.getNumNulls()
    if s.hasNonNullValue():
        kind = chunk.getPrimitiveType()
        primitive, note = kind.getPrimitiveTypeName().name(), str(kind.getLogicalTypeAnnotation() or "")
        found.kind = _kind(primitive, note)
        if found.kind:
            found.low, found.high = (_value(v, primitive, note) for v in (s.genericGetMin(), s.genericGetMax()))
    return found


def _kind(primitive: str, note: str) -> str:
    if note in ("DATE", "STRING"):
        return note.lower()
    if note.startswith("TIMESTAMP"):
        return "timestamp"
    if not note or note.startswith("INTEGER"):
        return {"INT32": "integer", "INT64": "integer", "FLOAT": "float", "DOUBLE": "double", "BOOLEAN": "boolean"}.get(primitive, "")
    return ""


def _value(value, primitive: str, note: str):
    """A statistic as a Python value of the column's type; None where it can't be told."""
    try:
        if note == "DATE":
            return EPOCH + dt.timedelta(days=value)
        if note.startswith("TIMESTAMP"):
            unit = note[note.index("(") + 1 :].split(",")[0]
            micros = value * 1000 if unit == "MILLIS" else value if unit == "MICROS" else abs(value) // 1000 * (1 if value > 0 else -1)
            return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    except OverflowError:
        return None
    if primitive == "FLOAT":  # comes over as the shortest decimal; as a double it must be the float's own value
        return struct.unpack("f", struct.pack("f", value))[0]
    if note == "STRING":
        text = value.toStringUsingUTF8()
        return None if "\ufffd" in text else text  # a bound cut within a character has no order as text
    if note.startswith("INTEGER") and note.replace(" ", "").endswith(",false)"):
        return value & (0xFFFFFFFF if primitive == "INT32" else 0xFFFFFFFFFFFFFFFF)  # unsigned, but the library's numbers are signed
    return value


def read_footers(spark: SparkSession, paths: list[str], stats: bool = True, threads: int = 32) -> list[Footer]:
    """Footers in the order of the paths."""
    if len(paths) < 4:
        return [read_footer(spark, p, stats) for p in paths]
    with ThreadPoolExecutor(min(threads, len(paths))) as pool:
        return list(pool.map(lambda p: read_footer(spark, p, stats), paths))


#: From so many files on, footers are read in tasks.
IN_TASKS, FILES_A_TASK = 64, 200


@dataclass
class Surveyed:
    """What is left of a file: its schema as text, top-level columns, and row groups (from 1) that may match."""

    path: str
    schema_text: str
    names: tuple[str, ...]
    groups: list[int]
    all_groups: int


def survey(spark: SparkSession, paths: list[str], filters: Sequence = ()) -> list[Surveyed]:
    """Each file in the order of the paths, its row groups by the filters."""
    if len(paths) < IN_TASKS:
        return [_left(f, filters) for f in read_footers(spark, paths, stats=bool(filters))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, path in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                try:
                    left = _left(task_footer(path), filters)
                except (OSError, ValueError, pa.ArrowException):  # not a store that this task reaches
                    rows.append((at, None, None, None, None))
                else:
                    rows.append((at, left.schema_text, list(left.names), left.groups, left.all_groups))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["at", "schema", "names", "groups", "n"])

    listed = spark.createDataFrame(list(enumerate(paths)), "at long, path string").repartition(-(-len(paths) // FILES_A_TASK))
    found: list[Surveyed | None] = [None] * len(paths)
    for r in listed.mapInArrow(run, "at long, schema string, names array<string>, groups array<int>, n int").collect():
        if r["schema"] is not None:
            found[r["at"]] = Surveyed(paths[r["at"]], r["schema"], tuple(r["names"]), r["groups"], r["n"])
    if None in found:  # all on the driver, so that schemas are written alike
        return [_left(f, filters) for f in read_footers(spark, paths, stats=bool(filters))]
    return found


def _left(footer: Footer, filters: Sequence) -> Surveyed:
    from siltstone.plans.prune import plan

    (file,) = plan([footer], filters)
    return Surveyed(footer.path, footer.schema_text, footer.names, file.groups, file.all_groups)


def task_footer(path: str) -> Footer:
    """A footer as a task reads it, from local disk or any store that Arrow knows."""
    if "://" in path:
        store, inner = pa.fs.FileSystem.from_uri(path.replace("s3a://", "s3://"))
        read = pq.read_metadata(inner, filesystem=store)
    else:
        read = pq.read_metadata(path.removeprefix("file:"))
    groups = []
    for g in range(read.num_row_groups):
        group = RowGroup(read.row_group(g).num_rows)
        for c in range(read.num_columns):
            chunk = read.row_group(g).column(c)
            group.columns[chunk.path_in_schema] = _task_stats(chunk, read.schema.column(c))
        groups.append(group)
    return Footer(path, str(read.schema), tuple(read.schema.to_arrow_schema().names), groups)


def _task_stats(chunk, column) -> ColumnStats:
    found = ColumnStats(values=chunk.num_values, codec=chunk.compression)
    s = chunk.statistics if chunk.is_stats_set else None
    if s is None:
        return found
    found.nulls = s.null_count if s.has_null_count else None
    if s.has_min_max:
        low, high = s.min, s.max
        if hasattr(low, "nanosecond"):  # read to the microsecond, before 1970 towards the later one
            low, high = low.floor("us").to_pydatetime(), high.ceil("us").to_pydatetime()
        note = column.logical_type.type
        kinds = {bool: "boolean", int: "integer", str: "string", dt.datetime: "timestamp", dt.date: "date"}
        found.kind = {"FLOAT": "float", "DOUBLE": "double"}.get(column.physical_type, kinds.get(type(low), ""))
        if note not in ("NONE", "INT", "STRING", "DATE", "TIMESTAMP") or type(low) is not type(high):
            found.kind = ""
        if note == "INT" and json.loads(column.logical_type.to_json()).get("isSigned") is False:
            low, high = (x & (0xFFFFFFFF if column.physical_type == "INT32" else 0xFFFFFFFFFFFFFFFF) for x in (low, high))
        if found.kind == "timestamp":
            low, high = low.replace(tzinfo=None), high.replace(tzinfo=None)
        if found.kind:
            found.low, found.high = low, high
    return found
