"""A folder table as a stream of the files that arrive in it.

The tables' own semantics look files up anew at each query; a stream does the same step by step and takes each file
once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.errors import UnsupportedOperation
from siltstone.sources.table import ParquetTable
from siltstone.sources.types import read_cast


def stream(table: ParquetTable) -> DataFrame:
    """The rows of a declared folder table as a streaming DataFrame, by the schema of the files now in the folder.
    Columns that a later file lacks are null."""
    if table.options.dirname is None or table.options.schemaless:
        raise UnsupportedOperation("only declared tables over a folder can be streamed")
    groups = table.file_groups()
    kinds = {f.name: f for g in reversed(groups) for f in g.schema.fields}
    schema = type(groups[0].schema)(list(kinds.values()))
    reader = table.spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    df = reader.parquet(table.options.dirname)
    out = []
    for column, wanted in zip(table.columns, table.schema(groups).fields, strict=True):
        if column.in_file in kinds:
            value = read_cast(df[f"`{column.in_file}`"], kinds[column.in_file].dataType, column.kind, column.name)
        else:
            value = F.lit(None).cast(wanted.dataType)
        out.append(value.alias(column.name))
    return df.select(*out)
