"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset a local session gets one of its
    own, and any other fails: its executors can't share a folder of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        root = "file://" + tempfile.mkdtemp(prefix="llm-shared-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, removed when the application ends."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later jobs neither repeat its
    lineage nor see other values, also after executors are lost."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Before Python code runs on whole texts: Arrow batches of at most ARROW_ROWS rows, so that a
    worker holds a few MB of text at a time, and workers that start from now on find this package
    where the driver did, whatever their folder. (On a cluster it is shipped with ``--py-files``.)"""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
