"""Tables over sets of Parquet files.

A table is a list of columns and options. Its rows are a lazy DataFrame: files are found anew at each call, files of one
schema share one scan, columns are matched by exact name, missing ones are null, and other types are cast from the
file's own type, so filters and column pruning reach the scans.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.errors import CatalogError, OptionError
from siltstone.plans import conditions, prune
from siltstone.plans.presorted import read_presorted, save_presorted
from siltstone.session import configure
from siltstone.sources.files import table_files
from siltstone.sources.footers import Footer, Surveyed, read_footer, read_footers, survey
from siltstone.sources.options import ColumnOptions, TableOptions
from siltstone.sources.types import kind_of, parse_type, read_cast

FILE, ROW, RANK = "__file", "__row", "__rank"
#: Files of a table whose ranks are still broadcast.
BROADCAST_FILES = 100_000


@dataclass
class TableColumn:
    name: str
    type_name: str
    options: ColumnOptions = field(default_factory=ColumnOptions)
    default: object = None
    generated: str | None = None

    @property
    def kind(self) -> T.DataType | None:
        return parse_type(self.type_name)

    @property
    def in_file(self) -> str:
        return self.options.column_name or self.name


@dataclass
class FileGroup:
    """Files of one schema, in the table's order."""

    schema: T.StructType
    paths: list[str]


class ParquetTable:
    """A declared or schemaless table.

    columns: name to type, or to (type, options); uniform_files: a promise that all files have the first one's schema,
    so that only one footer is read however many files there are."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        columns: Mapping[str, object] | Iterable[TableColumn],
        options: Mapping[str, object],
        uniform_files: bool = False,
    ) -> None:
        self.spark, self.name, self.uniform_files = configure(spark), name, uniform_files
        self.columns: list[TableColumn] = []
        if isinstance(columns, Mapping):
            for column, spec in columns.items():
                kind, own = spec if isinstance(spec, tuple) else (spec, {})
                self.columns.append(TableColumn(column, kind, ColumnOptions.parse(own)))
        else:
            self.columns = list(columns)
        for column in self.columns:
            column.kind  # noqa: B018  an unknown type fails here and not at the first query
        self.raw_options = dict(options)
        self.options = TableOptions.parse(self.raw_options)
        if self.options.filename:
            table_files(spark, self.options)

    # -- definition ------------------------------------------------------------------------------------------------

    def column(self, name: str) -> TableColumn:
        for column in self.columns:
            if column.name == name:
                return column
        raise CatalogError(f"column {name!r} of table {self.name!r} does not exist")

    def set_options(self, **changes: object) -> None:
        """Add or set options; None drops one."""
        merged = {k: v for k, v in (self.raw_options | changes).items() if v is not None}
        self.options = TableOptions.parse(merged)
        self.raw_options = merged

    def set_column_options(self, name: str, **changes: object) -> None:
        column = self.column(name)
        now = {k: v for k, v in vars(column.options).items() if v is not None} | changes
        column.options = ColumnOptions.parse({k: v for k, v in now.items() if v is not None})

    def rename_column(self, old: str, new: str) -> None:
        if any(c.name == new for c in self.columns):
            raise CatalogError(f"column {new!r} already exists")
        self.column(old).name = new

    def add_column(self, name: str, kind: str, default: object = None, generated: str | None = None, **options: object) -> None:
        if any(c.name == name for c in self.columns):
            raise CatalogError(f"column {name!r} already exists")
        self.columns.append(TableColumn(name, kind, ColumnOptions.parse(options), default, generated))

    def drop_column(self, name: str) -> None:
        self.columns.remove(self.column(name))

    @property
    def document_column(self) -> TableColumn | None:
        """The column that holds whole rows of a schemaless table: the first document column."""
        return next((c for c in self.columns if c.kind is None), None)

    def key_names(self) -> list[str]:
        """Key columns by their names in files (schemaless) or in the table (declared)."""
        if self.options.schemaless:
            return list(self.options.key_columns)
        return [c.name for c in self.columns if c.options.key]

    # -- files -----------------------------------------------------------------------------------------------------

    def files(self) -> list[str]:
        return table_files(self.spark, self.options)

    def footers(self, stats: bool = False) -> list[Footer]:
        return read_footers(self.spark, self.files(), stats)

    def file_groups(self, paths: list[str] | None = None) -> list[FileGroup]:
        paths = self.files() if paths is None else paths
        if not paths:
            return []
        if self.uniform_files:
            return [FileGroup(self.file_schema(paths[0]), paths)]
        return self._grouped(survey(self.spark, paths))

    def _grouped(self, files: list[Surveyed]) -> list[FileGroup]:
        by_schema: dict[str, list[str]] = {}
        for file in files:
            by_schema.setdefault(file.schema_text, []).append(file.path)
        return [FileGroup(self.file_schema(own[0]), own) for own in by_schema.values()]

    def surveyed(self, filters: Iterable[prune.Filter]) -> list[Surveyed]:
        """The files, and what the statistics leave of each under filters on the table's columns."""
        own = {c.name: c for c in self.columns}
        mapped = [f.mapped(own[f.column].in_file, kind_of(own[f.column].kind)) if f.column in own else f for f in filters]
        return survey(self.spark, self.files(), mapped)

    def file_schema(self, path: str) -> T.StructType:
        return self.spark.read.parquet(path).schema

    def read(self, group: FileGroup, positions: bool = False) -> DataFrame:
        """All file columns of a group, and on request where each row lies."""
        df = self.spark.read.schema(group.schema).parquet(*group.paths)
        if positions:
            df = df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
        return df

    # -- rows ------------------------------------------------------------------------------------------------------

    def schema(self, groups: list[FileGroup]) -> T.StructType:
        fields = []
        for column in self.columns:
            kind = column.kind
            if kind is None:
                found = [g.schema[column.in_file].dataType for g in groups if column.in_file in g.schema.names]
                kind = found[0] if found and not self.options.schemaless else T.StringType()
            fields.append(T.StructField(column.name, kind))
        return T.StructType(fields)

    def df(self, filters: Iterable[prune.Filter] = (), positions: bool = False) -> DataFrame:
        """The table's rows. filters (table column, operator, constant) are applied, after files whose statistics rule
        them out have been left out."""
        filters = list(filters)
        if self.options.schemaless:
            from siltstone.sources.document import Document

            return Document(self).df(filters, positions)
        if filters:
            files = self.surveyed(filters)
            groups = self._grouped([f for f in files if f.groups])
            schema = self.schema(groups or self._grouped(files))
        else:
            groups = self.file_groups()
            schema = self.schema(groups)
        branches = [self._declared(g, schema, positions) for g in groups]
        if not branches:
            extra = [T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())] if positions else []
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
        out = branches[0]
        for branch in branches[1:]:
            out = out.unionByName(branch)
        for f in filters:
            out = out.where(f.column_expression())
        return out

    def where(self, condition: str) -> DataFrame:
        """The rows that pass a SQL condition; what it compares with constants also leaves out files. A column named
        like another in other case, or qualified, is left to Spark."""
        names = {c.name for c in self.columns}
        found = [] if self.options.schemaless else conditions.filters_of(self.spark, condition)
        return self.df([f for f in found if f.column in names]).where(condition)

    def _declared(self, group: FileGroup, schema: T.StructType, positions: bool) -> DataFrame:
        df = self.read(group, positions)
        out: list[Column] = []
        for column, wanted in zip(self.columns, schema.fields, strict=True):
            if column.in_file in group.schema.names:
                have = group.schema[column.in_file].dataType
                value = read_cast(df[f"`{column.in_file}`"], have, column.kind, column.name)
            else:
                value = F.lit(None).cast(wanted.dataType)
            out.append(value.alias(column.name))
        return df.select(*out, *([FILE, ROW] if positions else []))

    def in_file_order(self) -> DataFrame:
        """Rows file by file, in the order of the file list and then of each file."""
        names = [c.name for c in self.columns]
        return self.ranked(self.df(positions=True)).orderBy(RANK, ROW).select(*[F.col(f"`{n}`") for n in names])

    def ranked(self, df: DataFrame) -> DataFrame:
        """df with `__rank`, the place in the table's list of the file that FILE names as Spark spells it."""
        cleaned = F.regexp_replace(F.url_decode(F.regexp_replace(FILE, r"\+", "%2B")), r"^\w+:(//)?", "")
        if self.options.dirname is not None:  # a folder's files are in the order of their paths
            return df.withColumn(RANK, cleaned)
        names = [p.rpartition("://")[2] if "://" in p else p.removeprefix("file:") for p in self.files()]
        rows = list({name: i for i, name in reversed(list(enumerate(names)))}.items())
        ranks = self.spark.createDataFrame(rows, f"__path string, {RANK} long")
        ranks = F.broadcast(ranks) if len(names) <= BROADCAST_FILES else ranks
        return df.withColumn("__path", cleaned).join(ranks, "__path", "left").drop("__path")

    def in_sorted_order(self) -> DataFrame:
        """Rows by the columns of `sorted`, nulls last: what a merge of presorted files gives."""
        if not self.options.sorted:
            return self.df()
        if self.options.schemaless:
            from siltstone.sources.document import Document

            document = Document(self)
            document.check_sorted()
            return document.df().orderBy(*[document.get(c).asc_nulls_last() for c in self.options.sorted])
        for name in self.options.sorted:
            self.column(name)
        return self.df().orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in self.options.sorted])

    def presorted(self, name: str, buckets: int) -> DataFrame:
        """The rows by the managed copy `name`, dealt into buckets and sorted by the columns of `sorted`; it is made
        where it doesn't exist. Joins and groups on those columns then need neither shuffle nor sort."""
        if not self.options.sorted:
            raise OptionError(f"table {self.name!r} has no `sorted` columns")
        if not self.spark.catalog.tableExists(f"`{name}`"):
            save_presorted(self.df(), name, list(self.options.sorted), buckets)
        return read_presorted(self.spark, name)

    # -- plans -----------------------------------------------------------------------------------------------------

    def explain_scan(self, filters: Iterable[prune.Filter] = (), ordered: bool = False) -> prune.ScanPlan:
        """Reader and row groups (from 1) that a scan with these filters keeps."""
        kept = [prune.FilePlan(f.path, f.groups, f.all_groups) for f in self.surveyed(filters)]
        return prune.ScanPlan(prune.reader_name(kept, bool(self.options.sorted) and ordered, self.options.max_open_files), kept)

    def register(self, view: str | None = None) -> DataFrame:
        """The rows, also as a temporary view."""
        df = self.df()
        df.createOrReplaceTempView(f"`{view or self.name}`")
        return df

    def statistics(self) -> DataFrame:
        """Row count and, for each scalar column, nulls, distinct values, least and greatest."""
        df = self.df()
        parts = [F.count("*").alias("rows")]
        flat = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
        for f in flat:
            c = F.col(f"`{f.name}`")
            parts += [F.count_if(c.isNull()).alias(f"{f.name}_nulls"), F.approx_count_distinct(c).alias(f"{f.name}_distinct")]
            parts += [F.min(c).cast("string").alias(f"{f.name}_min"), F.max(c).cast("string").alias(f"{f.name}_max")]
        return df.agg(*parts)


def first_schema(spark: SparkSession, paths: list[str]) -> tuple[T.StructType, Footer]:
    if not paths:
        raise OptionError("no file to take the schema from")
    return spark.read.parquet(paths[0]).schema, read_footer(spark, paths[0], stats=False)
