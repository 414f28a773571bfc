"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import shared_folder

#: The white space that separates words, as a Java character class and as plain characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def durable(df: DataFrame) -> DataFrame:
    """Compute df once into the shared checkpoint folder, so that its lineage ends there and lost executors cost
    only a reread."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; a folder without the table's rows gives an empty DataFrame of the same schema."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def words(text: Column) -> Column:
    """The words of a text: runs of anything but space, tab, LF, VT, FF and CR. Null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_CLASS + "+", -1)).otherwise(
        F.array().cast("array<string>")
    )


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
