"""SparkSession construction and cluster-level settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is below the threshold), coalesces
# small shuffle partitions and splits skewed join partitions.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    *,
    shuffle_partitions: int | None = None,
    app_name: str = "tidewater",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's base settings.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    return spark
