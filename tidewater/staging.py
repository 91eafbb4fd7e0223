"""Intermediate tables that several branches of one job read."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


ROWS_PER_FILE = 100_000  # a file is read by one task, and cheap rows to store can be dear to work on


def shared_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder under the one that ``spark.checkpoint.dir`` names; what is written there
    goes when the application ends. Where the setting is missing a local session takes a temporary
    folder, and any other fails: its executors can't share a folder of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        root = "file://" + tempfile.mkdtemp(prefix="tidewater-staged-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/staged-{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)  # noqa: SLF001
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its sources are read once however many
    branches follow, and a lost executor re-reads files instead of repeating the lineage. Files end
    at ROWS_PER_FILE rows: however few tasks write the table, many can read it."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``staged`` for several tables, written side by side: small ones don't wait for each other."""
    with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
        return dict(zip(frames, pool.map(lambda item: staged(item[1], item[0]), frames.items())))
