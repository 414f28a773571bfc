"""Servers, tables, views and partitioned tables by name; import of schemas; statements in SQL."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import siltstone
from siltstone.errors import CatalogError, OptionError, UnsupportedOperation
from siltstone.operators.modify import Modifier
from siltstone.plans import conditions, prune
from siltstone.session import configure
from siltstone.sources.files import Store, check_one_kind
from siltstone.sources.options import LONGEST_NAME, ServerConfig, TableOptions
from siltstone.sources.table import ParquetTable, first_schema
from siltstone.sources.types import import_type, kind_of


class PartitionedTable:
    """Tables that each hold a range of one column: from the lower bound up to, but without, the upper one."""

    def __init__(self, name: str, column: str, parts: Sequence[tuple[ParquetTable, object, object]]) -> None:
        self.name, self.column, self.parts = name, column, list(parts)

    def kept(self, *alternatives: Iterable[prune.Filter]) -> list[tuple[ParquetTable, object, object]]:
        """The parts that can hold a row for any of several sets of filters."""
        kinds = {c.name: kind_of(c.kind) for table, _, _ in self.parts for c in table.columns}
        own = [[f for f in filters if f.column == self.column] for filters in alternatives]
        return [p for p in self.parts if any(prune.range_may_match(p[1], p[2], f, kinds.get(self.column)) for f in own)]

    def df(self, filters: Iterable[prune.Filter] = (), parts: Sequence[tuple[ParquetTable, object, object]] | None = None) -> DataFrame:
        """The union of the parts that filters leave, or of those given, each with its range as a condition."""
        if not self.parts:
            raise CatalogError(f"partitioned table {self.name!r} has no parts")
        filters, out = list(filters), None
        parts = self.kept(filters) if parts is None else parts
        for table, low, high in parts or self.parts[:1]:
            c = F.col(f"`{self.column}`")
            part = table.df(filters)
            if low is not None:
                part = part.where(c >= F.lit(low).cast(part.schema[self.column].dataType))
            if high is not None:
                part = part.where(c < F.lit(high).cast(part.schema[self.column].dataType))
            part = part if parts else part.limit(0)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def insert(self, rows) -> None:
        """Each row into the part of its range."""
        spark = self.parts[0][0].spark
        if not isinstance(rows, DataFrame):
            names = [c.name for c in self.parts[0][0].columns]
            kinds = self.parts[0][0].df().schema
            rows = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], kinds)
        left = rows
        for table, low, high in self.parts:
            c = F.col(f"`{self.column}`")
            inside = F.lit(True)
            inside = inside & (c >= F.lit(low).cast(rows.schema[self.column].dataType)) if low is not None else inside
            inside = inside & (c < F.lit(high).cast(rows.schema[self.column].dataType)) if high is not None else inside
            own = rows.where(inside)
            left = left.where(~F.coalesce(inside, F.lit(False)))
            if not own.isEmpty():
                Modifier(table).insert(own)
        if not left.isEmpty():
            raise CatalogError(f"no partition of {self.name!r} found for a row")

    def update(self, changes, where=None) -> None:
        for table, _, _ in self.parts:
            Modifier(table).update(changes, where)

    def delete(self, where=None) -> None:
        for table, _, _ in self.parts:
            Modifier(table).delete(where)


class Catalog:
    """What a session knows by name."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = configure(spark)
        self.servers: dict[str, ServerConfig] = {}
        self.tables: dict[str, ParquetTable | PartitionedTable] = {}
        self.views: dict[str, str] = {}

    # -- servers ---------------------------------------------------------------------------------------------------

    def create_server(self, name: str, **options: object) -> ServerConfig:
        if name in self.servers:
            raise CatalogError(f"server {name!r} already exists")
        self.servers[name] = ServerConfig.from_options(name, options)
        return self.servers[name]

    def server(self, name: str) -> ServerConfig:
        if name not in self.servers:
            raise CatalogError(f"server {name!r} does not exist")
        return self.servers[name]

    def create_user_mapping(self, server: str, **options: str) -> None:
        self.server(server).map_user(options)

    def connect(self, server: str, bucket: str) -> None:
        """Put a server's settings for one bucket into the session's Hadoop configuration."""
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for key, value in self.server(server).hadoop_conf(bucket).items():
            conf.set(key, value)
        self.server(server).valid = True

    def get_connections(self) -> DataFrame:
        rows = [(s.name, s.valid) for s in self.servers.values()]
        return self.spark.createDataFrame(rows, "server_name string, valid boolean")

    def disconnect(self, name: str) -> bool:
        server = self.server(name)
        was, server.valid = server.valid, False
        return was

    def disconnect_all(self) -> bool:
        return any([self.disconnect(name) for name in self.servers])

    def version(self) -> str:
        return siltstone.__version__

    # -- tables ----------------------------------------------------------------------------------------------------

    def create_table(self, name: str, columns: Mapping[str, object], server: str | None = None, **options: object) -> ParquetTable:
        if name in self.tables:
            raise CatalogError(f"table {name!r} already exists")
        if server is not None:
            self.server(server)
        self.tables[name] = ParquetTable(self.spark, name, columns, options)
        return self.tables[name]

    def create_partitioned(self, name: str, column: str, parts: Sequence[tuple[str, object, object]]) -> PartitionedTable:
        self.tables[name] = PartitionedTable(name, column, [(self.table(t), low, high) for t, low, high in parts])
        return self.tables[name]

    def table(self, name: str) -> ParquetTable:
        """A table by its name, or by the name of a view that shows all of it."""
        seen = set()
        while name in self.views and name not in seen:
            seen.add(name)
            simple = re.fullmatch(r"(?is)\s*select\s+\*\s+from\s+`?(\w+)`?\s*;?\s*", self.views[name])
            if not simple:
                raise UnsupportedOperation(f"view {name!r} can't be changed through")
            name = simple[1]
        if name not in self.tables:
            raise CatalogError(f"table {name!r} does not exist")
        return self.tables[name]

    def drop_table(self, name: str, if_exists: bool = False) -> None:
        if self.tables.pop(name, None) is None and not if_exists:
            raise CatalogError(f"table {name!r} does not exist")
        self.spark.catalog.dropTempView(name)

    def create_view(self, name: str, query: str) -> None:
        self.views[name] = query

    def sql(self, query: str, args: Mapping[str, object] | Sequence[object] | None = None) -> DataFrame:
        """A query over the catalog's tables and views, whose files are looked up now; args fills its parameters."""
        self._register(query, ())
        return self.spark.sql(query, args=args) if args else self.spark.sql(query)

    def _register(self, query: str, within: tuple[str, ...]) -> None:
        """Temporary views of the tables and views that a query names; `within`: views whose queries lead to it."""
        used: dict[str, list[list[prune.Filter]]] = {}
        for reference in conditions.references(self.spark, query):
            used.setdefault(reference.name, []).append(reference.filters())
        for name, alternatives in used.items():
            if name in self.views:
                if name in within:
                    raise CatalogError(f"view {name!r} leads back to itself")
                self._register(self.views[name], (*within, name))
                self.spark.sql(self.views[name]).createOrReplaceTempView(f"`{name}`")
            elif name in self.tables:
                table = self.tables[name]
                if isinstance(table, PartitionedTable):
                    df = table.df(parts=table.kept(*alternatives))
                else:
                    df = table.df()
                df.createOrReplaceTempView(f"`{name}`")

    def insert(self, name: str, rows, **more) -> None:
        target = self.table(name)
        target.insert(rows) if isinstance(target, PartitionedTable) else Modifier(target).insert(rows, **more)

    def update(self, name: str, changes: Mapping[str, object], where=None, **more) -> None:
        target = self.table(name)
        target.update(changes, where) if isinstance(target, PartitionedTable) else Modifier(target).update(changes, where, **more)

    def delete(self, name: str, where=None, **more) -> None:
        target = self.table(name)
        target.delete(where) if isinstance(target, PartitionedTable) else Modifier(target).delete(where, **more)

    def analyze(self, name: str) -> DataFrame:
        return self.table(name).statistics()

    # -- import ----------------------------------------------------------------------------------------------------

    def import_parquet(self, name: str, files_func: Callable[..., Iterable[str]], arg: object = None, options: Mapping[str, object] | None = None) -> ParquetTable:
        """A table over the files of a function, with the columns of the first file."""
        options = dict(options or {}) | {"files_func": files_func, "files_func_arg": arg}
        paths = list(files_func(arg) or [])
        check_one_kind(paths)
        schema, _ = first_schema(self.spark, paths)
        return self.create_table(name, self._columns(schema, options), **options)

    def import_parquet_explicit(
        self,
        name: str,
        names: Sequence[str],
        types: Sequence[str],
        files_func: Callable[..., Iterable[str]],
        arg: object = None,
        options: Mapping[str, object] | None = None,
    ) -> ParquetTable:
        """The same with columns given."""
        if len(names) != len(types):
            raise OptionError("as many types as names are required")
        if any(not n for n in names) or any(not t for t in types):
            raise OptionError("names and types must not be empty")
        options = dict(options or {}) | {"files_func": files_func, "files_func_arg": arg}
        columns: dict[str, object] = dict(zip(names, types, strict=True))
        if TableOptions.parse(options).schemaless:
            warnings.warn("a schemaless table has no columns of its own: names and types are ignored", stacklevel=2)
            columns = {"v": "jsonb"}
        return self.create_table(name, columns, **options)

    def import_foreign_schema(
        self,
        dirname: str,
        limit_to: Sequence[str] | None = None,
        except_: Sequence[str] | None = None,
        options: Mapping[str, object] | None = None,
    ) -> list[str]:
        """A table for each Parquet file of a folder, named after it; names of the tables."""
        made = []
        for path in Store(self.spark).list_files(dirname, recursive=False):
            stem, dot, extension = path.rpartition("/")[2].rpartition(".")
            if not dot or extension != "parquet":
                continue
            if (limit_to is not None and stem not in limit_to) or (except_ is not None and stem in except_):
                continue
            schema, _ = first_schema(self.spark, [path])
            own = dict(options or {}) | {"filename": [path]}
            self.create_table(stem, self._columns(schema, own), **own)
            made.append(stem)
        return made

    def _columns(self, schema, options: Mapping[str, object]) -> dict[str, object]:
        parsed = TableOptions.parse(dict(options))
        if parsed.schemaless:
            return {"v": "jsonb"}
        columns = {}
        for f in schema.fields:
            if len(f.name.encode()) > LONGEST_NAME:
                raise OptionError(f"column name {f.name!r} is too long")
            own = {"column_name": f.name} | ({"key": "true"} if f.name in parsed.key_columns else {})
            columns[f.name] = (import_type(f.dataType, f.name), own)
        return columns

    # -- data sources ----------------------------------------------------------------------------------------------

    def create_datasource(self, name: str, if_not_exists: bool = False) -> None:
        """An empty file for a declared table, under its `filename`."""
        table = self.table(name)
        path = table.options.filename[0] if table.options.filename else f"{table.options.dirname}/{name}.parquet"
        if Store(self.spark).exists(path):
            if if_not_exists:
                return
            raise CatalogError(f"{path} already exists")
        empty = table.spark.createDataFrame([], table.schema([]))
        Modifier(table)._write(path, Modifier._behind(empty))

    def drop_datasource(self, name: str, if_exists: bool = False) -> None:
        table, store = self.table(name), Store(self.spark)
        for path in table.options.filename or table.files():
            if store.exists(path):
                store.delete(path)
            elif not if_exists:
                raise CatalogError(f"no such file or directory: {path}")
