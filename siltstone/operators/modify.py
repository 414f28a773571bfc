"""INSERT, UPDATE and DELETE on tables over Parquet files, by copy-on-write of the files they touch.

A statement's rows are planned as DataFrames: which file a new row goes to, which rows (file, position) an update or
delete hits. That plan is written to a staging folder first, so a statement may read the table that it changes. Then
each touched file, and no other, is rewritten beside itself and put in its place by a rename. A statement over several
files is not atomic as a whole.

Rows are identified by key columns. Where keys repeat, a statement that hits n rows of a key changes the first n rows of
that key in the order of files and positions."""

from __future__ import annotations

import json
import time
import uuid
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.errors import ModifyError, UnsupportedOperation
from siltstone.session import shared_folder
from siltstone.sources.document import Document
from siltstone.sources.files import Store
from siltstone.sources.footers import read_footer
from siltstone.sources.table import FILE, RANK, ROW, ParquetTable
from siltstone.sources.types import KEY_TYPES, SORT_TYPES, document_type

Values = Mapping[str, object]
FILES_AT_ONCE = 16
#: An INSERT of more rows into a folder table makes new files of about this size, written by as many tasks.
ROWS_PER_FILE = 2_000_000


def _column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


class Modifier:
    """Changes to one table."""

    def __init__(self, table: ParquetTable, rows_per_file: int = ROWS_PER_FILE) -> None:
        self.table, self.spark, self.store = table, table.spark, Store(table.spark)
        self.options, self.rows_per_file = table.options, rows_per_file

    # -- statements ------------------------------------------------------------------------------------------------

    def insert(self, rows: DataFrame | Sequence[Values], returning: object = None, on_conflict: object = None) -> None:
        """Add rows: a DataFrame or dicts of the table's columns; for a schemaless table a DataFrame of one JSON column
        or dicts of keys."""
        if returning is not None or on_conflict is not None:
            raise UnsupportedOperation("RETURNING and ON CONFLICT are not supported")
        stage = self._stage()
        try:
            if self.options.schemaless:
                self._insert_documents(rows, stage)
            else:
                self._insert_declared(rows, stage)
        finally:
            self.store.delete(stage, True)

    def update(self, changes: Values, where: Column | None = None, source: DataFrame | None = None, on: Column | None = None, returning: object = None) -> None:
        """Set columns (document keys) to constants or expressions in the rows that pass `where`; with `source`, in the
        rows that join it by `on`, whose columns expressions may use."""
        if returning is not None:
            raise UnsupportedOperation("RETURNING is not supported")
        if not self.options.schemaless:
            for name in changes:
                if self.table.column(name).generated:
                    raise ModifyError(f"column {name!r} is generated and can't be set")
        self._change(changes, where, source, on)

    def delete(self, where: Column | None = None, source: DataFrame | None = None, on: Column | None = None, returning: object = None) -> None:
        if returning is not None:
            raise UnsupportedOperation("RETURNING is not supported")
        self._change(None, where, source, on)

    # -- insert ----------------------------------------------------------------------------------------------------

    def _insert_declared(self, rows: DataFrame | Sequence[Values], stage: str) -> None:
        columns = self.table.columns
        if not isinstance(rows, DataFrame):
            given = list(dict.fromkeys(k for row in rows for k in row))
            for name in given:
                self.table.column(name)
            kinds = {c.name: c.kind or T.StringType() for c in columns}
            schema = T.StructType([T.StructField(n, kinds[n]) for n in given])
            rows = self.spark.createDataFrame([tuple(row.get(n) for n in given) for row in rows], schema)
        given = rows.columns
        for name in given:
            self.table.column(name)
        out = []
        for c in columns:
            value = rows[f"`{c.name}`"] if c.name in given else _column(c.default)
            out.append((value.cast(c.kind) if c.kind is not None else value).alias(c.name))
        full = self._generate(rows.select(*out))
        full.write.parquet(f"{stage}/rows")
        full = self.spark.read.schema(full.schema).parquet(f"{stage}/rows")
        self._check_keys(full)
        files = self._file_names()
        self._each(lambda item: self._add(*item, item[0] in files), list(self._targets(full, files).items()))

    @staticmethod
    def _each(work: Callable, items: list) -> None:
        """Files are independent of each other: rewrite several at a time."""
        with ThreadPoolExecutor(max(1, min(FILES_AT_ONCE, len(items)))) as pool:
            list(pool.map(work, items))

    def _generate(self, df: DataFrame) -> DataFrame:
        """Generated columns from the others."""
        for c in self.table.columns:
            if c.generated:
                df = df.withColumn(c.name, F.expr(c.generated).cast(c.kind))
        return df

    def _check_keys(self, rows: DataFrame) -> None:
        for name in self.table.key_names():
            kind = self.table.column(name).kind
            if not isinstance(kind, KEY_TYPES):
                raise ModifyError(f"rows can't be told apart by a key of type {self.table.column(name).type_name!r}")
            if not rows.where(F.col(f"`{name}`").isNull()).isEmpty():
                raise ModifyError(f"key {name!r} has a null")

    def _file_names(self) -> dict[str, tuple[str, ...]]:
        """Columns of each file, in the table's order."""
        return {f.path: f.names for f in self.table.footers()}

    def _targets(self, rows: DataFrame, files: dict[str, tuple[str, ...]]) -> dict[str, DataFrame]:
        """Rows by the file that they go to."""
        in_file = {c.name: c.in_file for c in self.table.columns}
        used = F.filter(F.array(*[F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n in in_file]), lambda x: x.isNotNull())
        rows = rows.withColumn("__used", used)
        if self.options.insert_file_selector is not None:
            rows = rows.withColumn("__file", self._selected(rows))
            chosen: dict[str, DataFrame] = {}
            for r in rows.groupBy("__file").agg(F.array_distinct(F.flatten(F.collect_set("__used"))).alias("u")).collect():
                target = r["__file"]
                if target in files and not {in_file[n] for n in r["u"]} <= set(files[target]):
                    raise ModifyError(f"the schema of {target} does not match the inserted row")
                chosen[target] = rows.where(F.col("__file") == target).drop("__file", "__used")
            return chosen
        by_file: dict[str, list[list[str]]] = {}
        for (names,) in rows.select("__used").distinct().collect():
            wanted = {in_file[n] for n in names}
            target = next((path for path, own in files.items() if wanted <= set(own)), None)
            by_file.setdefault(target or self._new_file(), []).append(names)
        out = {}
        for target, sets in by_file.items():
            hit = F.lit(False)
            for names in sets:
                hit = hit | (F.col("__used") == F.array(*map(F.lit, names)).cast("array<string>"))
            out[target] = rows.where(hit).drop("__used")
        return out

    def _new_file(self) -> str:
        if self.options.dirname is None:
            raise ModifyError("no file of the table has the columns of this row")
        if not hasattr(self, "_fresh"):
            self._fresh = f"{self.options.dirname.rstrip('/')}/{self.table.name}-{time.strftime('%Y-%m-%d_%H-%M-%S')}-{uuid.uuid4().hex[:6]}.parquet"
        return self._fresh

    def _selected(self, rows: DataFrame) -> Column:
        """The target that the selector names: a function of (columns, dirname), or SQL over the row and `dirname`."""
        selector, folder = self.options.insert_file_selector, self.options.dirname or ""
        if callable(selector):
            return _column(selector({n: rows[f"`{n}`"] for n in rows.columns}, folder)).cast("string")
        quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
        return F.expr(f"transform(array('{quoted}'), dirname -> cast({selector} as string))[0]")

    def _add(self, target: str, rows: DataFrame, exists: bool) -> None:
        by_file: dict[str, str] = {}
        for c in self.table.columns:
            by_file.setdefault(c.in_file, c.name)
        n = rows.count()
        if n > self.rows_per_file and self.options.dirname is not None and self.options.insert_file_selector is None:
            # too many for one task: new files beside the others, in the schema of the first that fits
            kinds = self.spark.read.parquet(target).schema.fields if exists else None
            self._write_many(self._fitted(rows, by_file, kinds), -(-n // self.rows_per_file))
            return
        if not exists:
            self._write(target, self._behind(self._fitted(rows, by_file, None)))
            return
        base = self.spark.read.parquet(target)
        self._check_sorted(base, target)
        self._write(target, self._placed(base).unionByName(self._behind(self._fitted(rows, by_file, base.schema.fields))))

    @staticmethod
    def _fitted(rows: DataFrame, by_file: dict[str, str], fields: Sequence[T.StructField] | None) -> DataFrame:
        """rows with a file's columns and types, or those that a new file gets."""
        if fields is None:
            return rows.select(*[F.col(f"`{n}`").alias(f) for f, n in by_file.items()])
        value = lambda f: F.col(f"`{by_file[f.name]}`") if f.name in by_file else F.lit(None)
        return rows.select(*[value(f).cast(f.dataType).alias(f.name) for f in fields])

    def _insert_documents(self, rows: DataFrame | Sequence[Values], stage: str) -> None:
        if not isinstance(rows, DataFrame):
            texts = [(json.dumps({k: v for k, v in row.items()}, default=str),) for row in rows]
            rows = self.spark.createDataFrame(texts, "doc string")
        if len(rows.columns) != 1:
            raise ModifyError("a schemaless table takes one column of JSON text")
        rows = rows.select(F.col(f"`{rows.columns[0]}`").cast("string").alias("doc"))
        rows.withColumn("keys", F.array_sort(F.json_object_keys("doc"))).write.parquet(f"{stage}/rows")
        rows = self.spark.read.parquet(f"{stage}/rows")
        for name in self.options.key_columns:
            if not rows.where(F.get_json_object("doc", f"$['{name}']").isNull()).isEmpty():
                raise ModifyError(f"key {name!r} has a null")
        files = self._file_names()
        for (keys,) in rows.select("keys").distinct().collect():
            own = rows.where(F.col("keys") == F.array(*map(F.lit, keys)).cast("array<string>"))
            target = next((path for path, names in files.items() if set(keys) <= set(names)), None)
            if target is None:
                first = json.loads(own.select("doc").first()["doc"])
                self.__dict__.pop("_fresh", None)  # each set of keys that no file has makes a file of its own
                target = self._new_file()
                files[target] = tuple(keys)
                self._write(target, self._behind(self._parsed(own, document_type(first))))
                continue
            base = self.spark.read.parquet(target)
            self._check_sorted(base, target)
            self._write(target, self._placed(base).unionByName(self._behind(self._parsed(own, base.schema))))

    @staticmethod
    def _parsed(rows: DataFrame, schema: T.StructType) -> DataFrame:
        """JSON texts as rows of a file; truth values may be written as t and f."""
        loose = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType) for f in schema.fields])
        parsed = rows.select(F.from_json("doc", loose).alias("d"))
        return parsed.select(*[F.col("d").getField(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    # -- update and delete -----------------------------------------------------------------------------------------

    def _keyed(self) -> tuple[DataFrame, dict[str, Column], Document | None]:
        """The table's rows with their places, and key expressions."""
        names = self.table.key_names()
        if not names:
            raise ModifyError(f"table {self.table.name!r} has no key, which UPDATE and DELETE need")
        if self.options.schemaless:
            document = Document(self.table)
            kinds = {n: document.kind(n) for n in names}
            rows, keys = document.df(positions=True), {n: document.get(n) for n in names}
        else:
            document = None
            kinds = {n: self.table.column(n).kind for n in names}
            rows, keys = self.table.df(positions=True), {n: F.col(f"`{n}`") for n in names}
        for name, kind in kinds.items():
            if not isinstance(kind, (*KEY_TYPES, T.NullType, T.ByteType)):
                raise ModifyError(f"rows can't be told apart by key {name!r} of type {kind.simpleString() if kind else 'jsonb'}")
        return rows, keys, document

    def _change(self, changes: Values | None, where: Column | None, source: DataFrame | None, on: Column | None) -> None:
        rows, keys, document = self._keyed()
        key_columns = [e.alias(f"__k{i}") for i, e in enumerate(keys.values())]
        k = [f"__k{i}" for i in range(len(keys))]
        hit = rows
        if source is not None:
            hit = rows.join(source, on) if on is not None else rows.crossJoin(source)
        if where is not None:
            hit = hit.where(where)
        if changes is not None and document is None and any(c.generated for c in self.table.columns):
            hit = self._with_generated(hit, changes, k, key_columns)
        else:
            hit = hit.select(FILE, ROW, *key_columns, *self._new_values(hit, changes, document))
        for name in k:
            hit = hit.where(F.col(name).isNotNull())  # a null key never matches
        if source is not None:
            hit = hit.dropDuplicates([FILE, ROW])
        stage = self._stage()
        try:
            order = Window.partitionBy(*k).orderBy(RANK, ROW)
            self.table.ranked(hit).withColumn("__n", F.row_number().over(order)).drop(RANK).write.parquet(f"{stage}/hit")
            hit = self.spark.read.parquet(f"{stage}/hit")
            every = rows.select(FILE, ROW, *key_columns).join(hit.select(*k).distinct(), k, "left_semi")
            every = self.table.ranked(every).withColumn("__n", F.row_number().over(order)).drop(RANK)
            victims = every.join(hit.drop(FILE, ROW), [*k, "__n"])
            victims.write.parquet(f"{stage}/victims")
            victims = self.spark.read.parquet(f"{stage}/victims")
            if changes is not None and document is None:
                for name in set(changes) & set(keys):
                    if not victims.where(F.col("__new").getField(name).isNull()).isEmpty():
                        raise ModifyError(f"key {name!r} has a null")
            touched = [r[0] for r in victims.select(FILE).distinct().collect()]
            self._each(lambda file: self._rewrite(file, victims.where(F.col(FILE) == file), changes), touched)
        finally:
            self.store.delete(stage, True)

    def _new_values(self, hit: DataFrame, changes: Values | None, document: Document | None) -> list[Column]:
        """One struct of the values that a hit row gets."""
        if changes is None:
            return []
        if document is not None:
            known = {f.name: f.dataType for f in document.schema.fields}
            for name in changes:
                if name not in known:
                    raise ModifyError(f"no file of the table has a column {name!r}")
            return [F.struct(*[_column(v).cast(known[n]).alias(n) for n, v in changes.items()]).alias("__new")]
        values = {n: _column(v) for n, v in changes.items()}
        values = {n: v.cast(self.table.column(n).kind) if self.table.column(n).kind else v for n, v in values.items()}
        return [F.struct(*[v.alias(n) for n, v in values.items()]).alias("__new")]

    def _with_generated(self, hit: DataFrame, changes: Values, keys: list[str], key_columns: list[Column]) -> DataFrame:
        """The same rows and values, with generated columns worked out from each new row."""
        later = [c for c in self.table.columns if c.generated]
        values = {n: _column(v).cast(self.table.column(n).kind) if self.table.column(n).kind else _column(v) for n, v in changes.items()}
        whole = F.struct(*[values.get(c.name, F.col(f"`{c.name}`")).alias(c.name) for c in self.table.columns]).alias("__whole")
        flat = hit.select(FILE, ROW, *key_columns, whole).select(FILE, ROW, *keys, "__whole.*")
        fields = [F.col(f"`{n}`") for n in changes] + [F.expr(c.generated).cast(c.kind).alias(c.name) for c in later]
        return flat.select(FILE, ROW, *keys, F.struct(*fields).alias("__new"))

    def _rewrite(self, file: str, victims: DataFrame, changes: Values | None) -> None:
        base = self.spark.read.parquet(file)
        self._check_sorted(base, file)
        placed = self._placed(base)
        if changes is None:
            self._write(file, placed.join(victims.select(ROW), ROW, "left_anti"))
            return
        new = victims.select(ROW, F.lit(True).alias("__hit"), "__new")
        names = self._new_names(victims)
        if not self.options.schemaless:
            in_file = {n: self.table.column(n).in_file for n in names}
        else:
            in_file = {n: n for n in names}
        missing = [n for n, f in in_file.items() if f not in base.columns]
        for n in missing:
            if not victims.where(F.col("__new").getField(n).isNotNull()).isEmpty():
                raise ModifyError(f"no file of the table has a column {n!r}")
        by_file = {f: n for n, f in in_file.items()}
        joined = placed.join(new, ROW, "left")
        out = []
        for f in base.schema.fields:
            value = F.col(f"`{f.name}`")
            if f.name in by_file:
                value = F.when(F.col("__hit"), F.col("__new").getField(by_file[f.name]).cast(f.dataType)).otherwise(value)
            out.append(value.alias(f.name))
        self._write(file, joined.select(*out, ROW))

    @staticmethod
    def _new_names(victims: DataFrame) -> list[str]:
        return victims.schema["__new"].dataType.names

    # -- files -----------------------------------------------------------------------------------------------------

    def _stage(self) -> str:
        """A hidden folder beside the table's files."""
        if self.options.dirname is not None:
            folder = self.options.dirname.rstrip("/")
        else:
            files = self.table.files()
            folder = files[0].rpartition("/")[0] if files else shared_folder(self.spark)
        return f"{folder}/.siltstone-{uuid.uuid4().hex}"

    def _sort_columns(self, schema: T.StructType) -> list[str]:
        names = []
        for name in self.options.sorted:
            in_file = name if self.options.schemaless else self.table.column(name).in_file
            if in_file not in schema.names:
                continue
            if not isinstance(schema[in_file].dataType, (*SORT_TYPES, T.ByteType)):
                raise ModifyError(f"sorted column {name!r}: type {schema[in_file].dataType.simpleString()} is not supported")
            names.append(in_file)
        return names

    def _check_sorted(self, base: DataFrame, file: str) -> None:
        """A file that isn't in its table's order can't be kept in it."""
        names = self._sort_columns(base.schema)
        if not names:
            return
        key = F.struct(*[F.struct(F.col(f"`{n}`").isNotNull().alias("p"), F.col(f"`{n}`").alias("v")) for n in names])
        # each split by itself, and then the splits' ends, one row a split
        placed = base.select(key.alias("k"), F.col("_metadata.row_index").alias(ROW), F.spark_partition_id().alias("split"))
        before = F.lag("k").over(Window.partitionBy("split").orderBy(ROW))
        within = F.max(F.coalesce(F.col("b") > F.col("k"), F.lit(False))).alias("wrong")
        ends = placed.withColumn("b", before).groupBy("split").agg(within, F.min(ROW).alias("at"), F.min_by("k", ROW).alias("k1"), F.max_by("k", ROW).alias("k2"))
        across = F.lag("k2").over(Window.orderBy("at")) > F.col("k1")
        if not ends.select("wrong", across.alias("b")).where("wrong or b").isEmpty():
            raise ModifyError(f"{file} isn't in the table's order by {', '.join(names)}, so rows can't be put in place")

    def _codec(self, target: str, exists: bool) -> str:
        own = [c.options.compression_type for c in self.table.columns if c.options.compression_type]
        if len(set(own)) > 1:
            warnings.warn(f"one codec a file: {own[0]} is used for all columns of {target}", stacklevel=2)
        if own:
            return own[0]
        if self.options.compression_type:
            return self.options.compression_type
        kept = read_footer(self.spark, target).codec if exists else None
        return kept or "uncompressed"

    @staticmethod
    def _placed(base: DataFrame) -> DataFrame:
        return base.select("*", F.col("_metadata.row_index").alias(ROW))

    @staticmethod
    def _behind(rows: DataFrame) -> DataFrame:
        """New rows take places after all that a file can have."""
        return rows.withColumn(ROW, F.lit(1 << 62) + F.monotonically_increasing_id() % (1 << 61))

    def _write(self, target: str, df: DataFrame) -> None:
        """df as the one file `target`: in the table's order, nulls first, and else in the order of places."""
        order = [F.col(f"`{n}`").asc_nulls_first() for n in self._sort_columns(df.schema)]
        self._put(df.coalesce(1).sortWithinPartitions(*order, ROW).drop(ROW), target.rpartition("/")[0], self._codec(target, self.store.exists(target)), lambda _: target)

    def _write_many(self, df: DataFrame, files: int) -> None:
        """df as new files, each in the table's order."""
        order = [F.col(f"`{n}`").asc_nulls_first() for n in self._sort_columns(df.schema)]
        dealt = df.repartition(files)
        stem = self._new_file().removesuffix(".parquet")
        self._put(dealt.sortWithinPartitions(*order) if order else dealt, stem.rpartition("/")[0], self._codec(stem, False), lambda i: f"{stem}-{i:05d}.parquet")

    def _put(self, df: DataFrame, folder: str, codec: str, name: Callable[[int], str]) -> None:
        """Each partition of df as the file that name gives for its number: staged beside it and put in its place."""
        staged = f"{folder}/.siltstone-{uuid.uuid4().hex}"
        try:
            df.write.option("compression", codec).parquet(staged)
            files = [f.getPath() for f in self.store.fs(staged).listStatus(self.store.path(staged))]
            parts = sorted((p for p in files if p.getName().startswith("part-")), key=lambda p: p.getName())
            for i, part in enumerate(parts):
                self.store.replace(part.toString(), name(i))
                self.spark.catalog.refreshByPath(name(i))
        finally:
            self.store.delete(staged, True)
