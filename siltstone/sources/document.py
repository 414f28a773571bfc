"""Schemaless tables: a whole row as one document.

The document is a struct of the file's columns, so `get("a")` is a field access and only that column is read. Which keys
a row has is a constant of its file's schema; `has("a")` therefore leaves out the branches of files without it. JSON text
is made only where it is asked for."""

from __future__ import annotations

from collections.abc import Iterable
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.errors import OptionError
from siltstone.plans import prune
from siltstone.sources.types import json_text, kind_of, object_text, parse_type, plain_text

if TYPE_CHECKING:
    from siltstone.sources.table import ParquetTable

KEYS = "__keys"


class Document:
    """Access to the documents of a table; names and types are those of its files at the time of the call."""

    def __init__(self, table: ParquetTable) -> None:
        self.table = table
        self.groups = table.file_groups()
        fields: dict[str, T.DataType] = {}
        for group in self.groups:
            for f in group.schema.fields:
                fields.setdefault(f.name, f.dataType)
        self.schema = T.StructType([T.StructField(k, v) for k, v in fields.items()])
        column = table.document_column
        self.name = column.name if column else None

    def df(self, filters: Iterable[prune.Filter] = (), positions: bool = False) -> DataFrame:
        """The table's columns: the document, all others null; and `__keys`, the keys that each row has."""
        from siltstone.sources.table import FILE, ROW

        filters = list(filters)
        groups = self.groups
        if filters:
            from siltstone.sources.footers import survey
            from siltstone.sources.table import FileGroup

            paths = [p for g in groups for p in g.paths]
            kinds = {f.name: kind_of(f.dataType) for f in self.schema.fields}
            mapped = [f.mapped(f.column, kinds.get(f.column)) for f in filters]
            kept = {f.path for f in survey(self.table.spark, paths, mapped) if f.groups}
            groups = [FileGroup(g.schema, own) for g in groups if (own := [p for p in g.paths if p in kept])]
        branches = []
        for group in groups:
            df = self.table.read(group, positions)
            values = [
                (df[f"`{f.name}`"].cast(f.dataType) if f.name in group.schema.names else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in self.schema.fields
            ]
            keys = F.array(*[F.lit(n) for n in group.schema.names]).alias(KEYS)
            out = []
            for column in self.table.columns:
                own = column.name == self.name
                out.append((F.struct(*values) if own else F.lit(None).cast(column.kind or T.StringType())).alias(column.name))
            branches.append(df.select(*out, keys, *([FILE, ROW] if positions else [])))
        if not branches:
            fields = [T.StructField(c.name, self.schema if c.name == self.name else c.kind or T.StringType()) for c in self.table.columns]
            fields.append(T.StructField(KEYS, T.ArrayType(T.StringType())))
            fields += [T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())] if positions else []
            return self.table.spark.createDataFrame([], T.StructType(fields))
        out = branches[0]
        for branch in branches[1:]:
            out = out.unionByName(branch)
        for f in filters:
            out = out.where(self._condition(f))
        return out

    def _condition(self, f: prune.Filter) -> Column:
        if f.op == "?":
            return self.has(f.column, f.value) if f.column else self.has(f.value)
        c, v = self.get(f.column), F.lit(f.value)
        return {"<": c < v, "<=": c <= v, "=": c == v, ">=": c >= v, ">": c > v}[f.op]

    def kind(self, *path: object) -> T.DataType:
        kind: T.DataType = self.schema[path[0]].dataType if path[0] in self.schema.names else T.NullType()
        for _ in path[1:]:
            kind = kind.valueType if isinstance(kind, T.MapType) else kind.elementType if isinstance(kind, T.ArrayType) else T.NullType()
        return kind

    def get(self, *path: object) -> Column:
        """v -> a -> b: a column, a map's value by key, a list's element from 0. What isn't there is null."""
        if self.name is None or path[0] not in self.schema.names:
            return F.lit(None)
        value, kind = F.col(f"`{self.name}`").getField(str(path[0])), self.schema[str(path[0])].dataType
        for step in path[1:]:
            if isinstance(kind, T.MapType):
                value, kind = F.try_element_at(value, F.lit(str(step)).cast(kind.keyType)), kind.valueType
            elif isinstance(kind, T.ArrayType) and isinstance(step, int):
                value, kind = F.try_element_at(value, F.lit(step + 1 if step >= 0 else step)), kind.elementType
            else:
                return F.lit(None)
        return value

    def text(self, *path: object) -> Column:
        """v ->> a: scalars as plain text, lists and maps as JSON text."""
        kind = self.kind(*path)
        if isinstance(kind, T.NullType):
            return F.lit(None).cast("string")
        value = self.get(*path)
        if isinstance(kind, (T.ArrayType, T.MapType)):
            return F.when(value.isNotNull(), json_text(value, kind))
        return plain_text(value, kind)

    def cast(self, type_name: str, *path: object) -> Column:
        """(v ->> a)::type."""
        return self.get(*path).cast(parse_type(type_name))

    def has(self, *path: object) -> Column:
        """v ? a, or v -> m ? k."""
        if len(path) == 1:
            return F.array_contains(KEYS, F.lit(str(path[0])))
        kind = self.kind(*path[:-1])
        if not isinstance(kind, T.MapType):
            return F.lit(False)
        return F.coalesce(F.map_contains_key(self.get(*path[:-1]), F.lit(str(path[-1])).cast(kind.keyType)), F.lit(False))

    def json(self) -> Column:
        """The whole document as JSON text, with the keys that its file has."""
        if self.name is None:
            return F.lit(None).cast("string")
        return object_text(F.col(f"`{self.name}`"), self.schema, F.col(KEYS))

    def check_sorted(self) -> None:
        for name in self.table.options.sorted:
            if name not in self.schema.names:
                raise OptionError(f"sorted column {name!r} is in no file")
