"""siltstone: a PySpark-native analytics engine over sets of Parquet files."""

__version__ = "0.1.0"
