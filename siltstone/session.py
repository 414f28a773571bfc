"""Session settings that the engine relies on, and access to the driver's tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from siltstone.errors import OptionError

#: Exact column names, micros in files, nanoseconds as numbers, and run-time re-planning.
SETTINGS = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the engine's settings into a session that someone else has made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir. Where that is unset a local
    session, as in tests, gets one of its own; on a cluster it is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        chosen = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not chosen and not sc.master.startswith("local"):
            raise OptionError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(chosen or tempfile.mkdtemp(prefix="siltstone-"))
    return sc.getCheckpointDir()


def local_session(cores: int = 8, app: str = "siltstone", **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings the session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = SETTINGS | {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (conf | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
