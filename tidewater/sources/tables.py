"""Reading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


_HANDLES: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet input table; column pruning and filters reach the scan lazily.

    Input tables are immutable snapshots, so the lazy handle (file listing and
    footer schema) is resolved once per application and reused by every
    query; call ``forget_tables()`` after replacing input files in place.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _HANDLES.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _HANDLES[key] = df
    return df


def forget_tables() -> None:
    _HANDLES.clear()
