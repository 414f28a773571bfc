"""Co-located, sorted copies of tables.

Plain Parquet files can't tell Spark how they are dealt or sorted. A bucketed copy can: joins and groups on its key need
no shuffle, and with one file a bucket no sort either."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lets a scan of buckets with one file each report the order of its rows.
ORDERED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def save_presorted(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """df as a table of `buckets` buckets by keys, each one file in the order of the keys.

    Its files get a folder of their own in the warehouse: another session's catalog may know the same name, or one that
    is gone may have left files under it, and those are neither read nor touched. Where the catalog ends with the
    session, so do the files."""
    spark = df.sparkSession
    folder = f"{spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").format("parquet").option("path", folder)
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    writer.saveAsTable(f"`{name}`")


def read_presorted(spark: SparkSession, name: str) -> DataFrame:
    spark.conf.set(ORDERED_BUCKETS, "true")
    return spark.table(f"`{name}`")
