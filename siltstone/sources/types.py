"""SQL type names, Spark types, and conversions between a file's type and the declared one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.errors import TypeMismatch

#: Fixed names of the SQL types that tables are declared with.
SCALARS: dict[str, T.DataType] = {
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "int2": T.ShortType(), "smallint": T.ShortType(),
    "int4": T.IntegerType(), "int": T.IntegerType(), "integer": T.IntegerType(),
    "int8": T.LongType(), "bigint": T.LongType(),
    "float4": T.FloatType(), "real": T.FloatType(),
    "float8": T.DoubleType(), "double precision": T.DoubleType(),
    "numeric": T.DoubleType(),
    "text": T.StringType(), "varchar": T.StringType(),
    "bytea": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(),
}
DOCUMENT = "jsonb"
#: The name by which an imported column of each type is declared.
IMPORT_NAMES = {
    T.BooleanType: "bool", T.ByteType: "int2", T.ShortType: "int2", T.IntegerType: "int4", T.LongType: "int8",
    T.FloatType: "float4", T.DoubleType: "float8", T.StringType: "text", T.BinaryType: "bytea",
    T.DateType: "date", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamp",
}
KEY_TYPES = (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.TimestampNTZType, T.TimestampType, T.DateType, T.StringType)
SORT_TYPES = KEY_TYPES[:-1]


def parse_type(name: str) -> T.DataType | None:
    """The Spark type of a declared one; None for a document, whose type comes from the file."""
    plain = " ".join(name.lower().split())
    if plain in (DOCUMENT, "json"):
        return None
    if plain.endswith("[]"):
        return T.ArrayType(_scalar(plain[:-2].strip(), name))
    return _scalar(plain, name)


def _scalar(plain: str, name: str) -> T.DataType:
    plain = plain.split("(")[0].strip()
    if plain not in SCALARS:
        raise TypeMismatch(f"type {name!r} is not supported")
    return SCALARS[plain]


def kind_of(kind: T.DataType | None) -> str | None:
    """What statistics of a column of this type are compared as; None for a type that is taken from the file."""
    if kind is None:
        return None
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return kind.typeName()


def import_type(kind: T.DataType, column: str) -> str:
    """The declared type that a file's column is imported as."""
    if isinstance(kind, T.ArrayType) and type(kind.elementType) in IMPORT_NAMES:
        return IMPORT_NAMES[type(kind.elementType)] + "[]"
    if isinstance(kind, T.MapType) and type(kind.keyType) in IMPORT_NAMES and type(kind.valueType) in IMPORT_NAMES:
        return DOCUMENT
    if type(kind) not in IMPORT_NAMES:
        raise TypeMismatch(f"cannot import column {column!r} of type {kind.simpleString()}")
    return IMPORT_NAMES[type(kind)]


def read_cast(value: Column, have: T.DataType, want: T.DataType | None, column: str) -> Column:
    """A file's value as the declared type: as it is, or by an explicit cast that fails on values it can't keep."""
    if want is None or have == want:
        return value
    nested = (T.ArrayType, T.MapType, T.StructType)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return value if have.elementType == want.elementType else value.cast(T.ArrayType(want.elementType))
    if isinstance(have, nested) or isinstance(want, nested):
        raise TypeMismatch(f"column {column!r}: cannot convert {have.simpleString()} to {want.simpleString()}")
    if isinstance(want, (T.TimestampNTZType, T.TimestampType)) and isinstance(have, T.LongType):
        return F.timestamp_micros(F.call_function("div", value, F.lit(1000))).cast(want)  # nanoseconds, read as numbers
    return value.cast(want)


def document_type(values: dict) -> T.StructType:
    """The file schema for a document written as a new file: numbers as double, lists and maps by their first element."""

    def of(value) -> T.DataType:
        if isinstance(value, bool):
            return T.BooleanType()
        if isinstance(value, (int, float)):
            return T.DoubleType()
        if isinstance(value, list):
            return T.ArrayType(of(value[0]) if value else T.StringType())
        if isinstance(value, dict):
            first = next(iter(value.values()), None)
            return T.MapType(T.StringType(), of(first) if first is not None else T.StringType())
        return T.StringType()

    return T.StructType([T.StructField(k, of(v)) for k, v in values.items()])


# -- JSON text as the document type prints it ----------------------------------------------------------------------


def quoted(text: Column) -> Column:
    """A string as JSON."""
    inner = F.to_json(F.array(text))
    return F.substring(inner, F.lit(2), F.length(inner) - 2)


def plain_text(value: Column, kind: T.DataType) -> Column:
    """A scalar as its type prints it: t and f, and no trailing zeros of a fraction."""
    if isinstance(kind, T.BooleanType):
        return F.when(value, "t").when(~value, "f")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        full = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.rtrim(F.rtrim(full, F.lit("0")), F.lit("."))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.regexp_replace(value.cast("string"), r"\.0$", "")
    return value.cast("string")


def json_text(value: Column, kind: T.DataType) -> Column:
    """A value as JSON text in a document: numbers bare, all other scalars as strings, null as null."""
    if isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda x: json_text(x, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                F.octet_length(plain_text(e["key"], kind.keyType)).alias("n"),
                plain_text(e["key"], kind.keyType).alias("k"),
                json_text(e["value"], kind.valueType).alias("v"),
            ),
        )
        pairs = F.transform(F.array_sort(entries), lambda e: F.concat(quoted(e["k"]), F.lit(": "), e["v"]))
        text = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    elif isinstance(kind, T.NumericType):
        text = plain_text(value, kind)
    else:
        text = quoted(plain_text(value, kind))
    return F.coalesce(text, F.lit("null"))


def object_text(struct: Column, schema: T.StructType, keys: Column | None = None) -> Column:
    """A struct as a JSON object: keys by length and then bytes; `keys` names those that are present, if not all are."""
    parts = []
    for field in sorted(schema.fields, key=lambda f: (len(f.name.encode()), f.name.encode())):
        text = F.concat(quoted(F.lit(field.name)), F.lit(": "), json_text(struct.getField(field.name), field.dataType))
        parts.append(text if keys is None else F.when(F.array_contains(keys, field.name), text))
    listed = F.filter(F.array(*parts), lambda x: x.isNotNull()) if parts else F.array().cast("array<string>")
    return F.concat(F.lit("{"), F.array_join(listed, ", "), F.lit("}"))
