"""Raw/mart table writes, upsert, and the run ledger.

Tables are Parquet folders. An overwrite goes to a staging folder of its own and takes the
target's place by renames whose results are checked; the old table is set aside first and
put back if the new one can't take its place. Appends leave only whole files (Spark's
committer). Row counts come from an ``Observation`` on the written DataFrame — no second
pass over the data.
"""

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tidewater.schemas import DEFAULTS, MART_KEYS, MART_SCHEMAS, RAW_SCHEMAS
from tidewater.sinks.commits import RunWrites


def conform(df: DataFrame, schema: StructType, now: dt.datetime | None = None,
            defaults: dict[str, object] | None = None) -> DataFrame:
    """K11 + C9: project onto a table schema: cast each column, drop helper
    columns not in the schema, fill ``loaded_at``/``enriched_at`` with ``now``
    (or the query's current timestamp) and other missing columns with their
    default, or null. As in DDL, a default stands for a column that is left
    out, not for a null that is given."""
    present, defaults = set(df.columns), defaults or {}
    stamp = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in ("loaded_at", "enriched_at"):
            cols.append(stamp.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def encode_nested(df: DataFrame) -> DataFrame:
    """K8: arrays, structs and maps as JSON text (for text-only targets)."""
    return df.select(*[
        F.to_json(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (ArrayType, StructType, MapType)) else F.col(f.name)
        for f in df.schema.fields])


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath  # noqa: SLF001


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return bool(fs.exists(at))


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def commit_write(df: DataFrame, path: str, *, mode: str = "overwrite",
                 keep_if_empty: bool = False, partition_by: list[str] | None = None) -> int:
    """Write ``df`` as Parquet at ``path``; returns the rows written.

    ``overwrite`` writes a staging folder of its own, sets the old table aside, renames the new
    one into its place and only then deletes the old one; if the rename fails the old table is
    put back and the error raised. With ``keep_if_empty`` an empty result leaves the table as is.
    """
    spark = df.sparkSession
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    overwrite = mode == "overwrite"
    name = path.rstrip("/")
    staging = f"{name}._staging-{uuid.uuid4().hex}" if overwrite else path
    w = observed.write.mode("errorifexists" if overwrite else mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(staging)
    rows = int(obs.get["rows"])
    if not overwrite:
        return rows
    fs, target = _fs(spark, name)
    _, stage = _fs(spark, staging)
    _, aside = _fs(spark, f"{name}._old-{uuid.uuid4().hex}")
    replaces = fs.exists(target)
    if rows == 0 and keep_if_empty and replaces:
        fs.delete(stage, True)
        return 0
    if replaces:
        _rename(fs, target, aside)
    try:
        _rename(fs, stage, target)
    except Exception:
        if replaces:
            _rename(fs, aside, target)
        raise
    if replaces:
        fs.delete(aside, True)
    return rows


def load_raw(cleaned: dict[str, DataFrame], out_dir: str,
             now: dt.datetime | None = None) -> dict[str, int]:
    """K1: write the five cleaned sources to ``<out_dir>/raw/<table>``.

    Returns rows written per table. No cascade into mart tables (Q4).
    """
    written = {}
    for table, df in cleaned.items():
        written[table] = commit_write(conform(df, RAW_SCHEMAS[table], now, DEFAULTS.get(table)),
                                      f"{out_dir.rstrip('/')}/raw/{table}")
    return written


def write_mart(df: DataFrame, table: str, out_dir: str, run_id: str,
               now: dt.datetime | None = None) -> int:
    """K2, K4-K7: stamp run_id and enriched_at, conform to the mart schema,
    replace the table; an empty result leaves the table as is (returns 0)."""
    stamped = df.withColumn("run_id", F.lit(run_id))
    return commit_write(conform(stamped, MART_SCHEMAS[table], now),
                        f"{out_dir.rstrip('/')}/mart/{table}", keep_if_empty=True)


def one_per_key(incoming: DataFrame, keys: list[str], order: str | None, columns: list[str]) -> DataFrame:
    """``columns`` of ``incoming`` with one row per key: the one with the greatest ``order``. Without
    ``order`` a repeated key is an error when the result is computed."""
    rest = F.struct(*[c for c in columns if c not in keys]) if set(columns) - set(keys) else F.lit(None)
    picked = F.max_by(rest, F.col(order)) if order else F.first(rest)
    new = incoming.groupBy(*keys).agg(picked.alias("x"), F.count(F.lit(1)).alias("n"))
    if not order:
        new = new.where(F.when(F.col("n") > 1, F.raise_error(F.lit("upsert_by_key: incoming key repeated"))
                               .cast("boolean")).otherwise(F.lit(True)))
    return new.select(*[F.col(c) if c in keys else F.col(f"x.{c}").alias(c) for c in columns])


def upsert_by_key(current: DataFrame, incoming: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """K3 as a DataFrame function: rows of ``incoming`` replace rows of ``current`` with the same key
    (``commits.RunWrites.upsert`` does it to a written table).

    Of incoming rows with one key the one with the greatest ``order`` counts (a column of
    ``incoming``). Without ``order`` a repeated incoming key is an error when the result is
    computed, so the result's key always holds.
    """
    new = one_per_key(incoming, keys, order, current.columns)
    kept = current.join(incoming.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*current.columns).unionByName(new)


def put_mart(writes: RunWrites, df: DataFrame, table: str, now: dt.datetime | None = None, mode: str = "replace") -> int:
    """K2-K7 within a run: stamp run_id and enriched_at, conform to the mart schema, then replace the
    table's rows (an empty result leaves it as is) or, with ``mode="upsert"``, only the rows of the keys
    that changed. Returns the rows written or changed."""
    stamped = conform(df.withColumn("run_id", F.lit(writes.run_id)), MART_SCHEMAS[table], now)
    if mode == "upsert":
        return writes.upsert(f"mart/{table}", stamped, MART_KEYS[table])
    if mode != "replace":
        raise ValueError("mode must be 'replace' or 'upsert'")
    return writes.replace_keyed(f"mart/{table}", stamped, MART_KEYS[table], keep_if_empty=True)


# ── run ledger ──────────────────────────────────────────────────────────────
LEDGER = MART_SCHEMAS["pipeline_runs"]
LEDGER_DEFAULTS = DEFAULTS["pipeline_runs"]
OPENING_SEQ, CLOSING_SEQ = 1, 2


def _ledger_rows(runs: DataFrame, seq: int, **given) -> DataFrame:
    """Ledger rows from a table of runs: its columns, then ``given``, else null."""
    values = {c: F.col(c) for c in runs.columns} | {k: F.lit(v) for k, v in given.items()} | {"seq": F.lit(seq)}
    if "attempt" not in values:
        values["attempt"] = F.lit(1)
    return runs.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields])


def opening_rows(runs: DataFrame) -> DataFrame:
    """K9 for many runs (run_id, attempt, started_at, enrichment_mode, ...): status ``running``."""
    return _ledger_rows(runs, OPENING_SEQ, status="running", **LEDGER_DEFAULTS, rows_loaded=0)


def closing_rows(runs: DataFrame) -> DataFrame:
    """K10 for many runs (run_id, attempt, finished_at, status, counts, report_path, error, ...)."""
    return _ledger_rows(runs, CLOSING_SEQ)


def _one_run(spark: SparkSession, **values) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in LEDGER.fields}
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {types[k]}" for k in values))


def start_run(spark: SparkSession, run_id: str, started_at: dt.datetime, enrichment_mode: str,
              llm_provider: str | None = None, llm_model: str | None = None, attempt: int = 1) -> DataFrame:
    """K9: the opening ledger row of one attempt, status ``running``."""
    return opening_rows(_one_run(spark, run_id=run_id, attempt=attempt, started_at=started_at,
                                 enrichment_mode=enrichment_mode, llm_provider=llm_provider, llm_model=llm_model))


def finalize_run(spark: SparkSession, run_id: str, *, finished_at: dt.datetime, status: str,
                 rows_extracted: int, rows_enriched: int, llm_calls: int,
                 llm_cost_estimate, report_path: str | None, slack_sent: bool,
                 error: str | None = None, rows_loaded: int | None = None, attempt: int = 1) -> DataFrame:
    """The closing ledger row of one attempt; the ledger view folds it over the first."""
    return closing_rows(_one_run(
        spark, run_id=run_id, attempt=attempt, finished_at=finished_at, status=status, rows_extracted=rows_extracted,
        rows_loaded=rows_loaded, rows_enriched=rows_enriched, llm_calls=llm_calls,
        llm_cost_estimate=Decimal(str(llm_cost_estimate)), report_path=report_path, slack_sent=slack_sent, error=error))


def next_attempt(ledger: DataFrame, run_id: str) -> int:
    """1 for a new run, else one more than its last attempt (``commits.claim_attempt`` makes it a number
    that no other run gets)."""
    last = ledger.where(F.col("run_id") == run_id).agg(F.max("attempt")).first()[0]
    return int(last or 0) + 1


def run_ledger(events: DataFrame) -> DataFrame:
    """One row per run, the state of its latest attempt: per column the value of the latest
    event row that set it (UPDATE semantics over append-only rows); ``error`` and ``report_path``
    are what the latest row says, null included. Earlier attempts leave nothing behind."""
    cols = [c for c in events.columns if c not in ("run_id", "attempt", "seq")]
    decided = ("error", "report_path")
    folded = events.groupBy("run_id", "attempt").agg(
        *[F.max_by(F.col(c), F.col("seq") if c in decided else F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
          for c in cols])
    latest = folded.groupBy("run_id").agg(F.max_by(F.struct("attempt", *cols), F.col("attempt")).alias("x"))
    return latest.select("run_id", "x.*")


def run_status(task_states: DataFrame, exclude_task: str | None = None) -> DataFrame:
    """``failed`` when any task of the run failed, else ``success``."""
    df = task_states if exclude_task is None else task_states.filter(
        F.col("task_id") != F.lit(exclude_task))
    return df.groupBy("run_id").agg(
        F.when(F.bool_or(F.col("state") == "failed"), F.lit("failed"))
         .otherwise(F.lit("success")).alias("status"))


def count_rows_by_name(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """Rows per named frame plus a ``total`` row, in one aggregate: each frame
    is reduced to a tag column, the tags are unioned, and ``rollup`` adds the
    grand total, so every input is computed exactly once."""
    tagged = reduce(lambda a, b: a.unionByName(b),
                    [df.select(F.lit(name).alias(label)) for name, df in frames.items()])
    counts = tagged.rollup(label).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select(F.coalesce(F.col(label), F.lit("total")).alias(label),
                         F.col("n_rows").cast("long").alias("n_rows"))


def enrichment_counts(outputs: dict[str, DataFrame]) -> DataFrame:
    """Rows per enrichment output and their sum (``table='total'``)."""
    return count_rows_by_name(outputs, "table")


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append",
               properties: dict[str, str] | None = None, num_partitions: int | None = None) -> None:
    """Drop-in for a relational warehouse target (the original loaded
    PostgreSQL): Spark's JDBC writer, one connection per partition, batched
    inserts. Nested columns are JSON-encoded first. ``num_partitions`` is the number of
    concurrent connections the database sees; the rows are dealt out anew, so the
    stages before keep their own width. Not exercised in the tests: no
    database server is available here."""
    out = encode_nested(df)
    if num_partitions is not None:
        out = out.repartition(num_partitions)
    out.write.jdbc(url, table, mode=mode, properties=properties or {})
