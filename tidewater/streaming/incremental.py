"""Incremental daily runs with Structured Streaming.

The job is scheduled once a day and must not re-process what earlier runs
handled. A file-source stream with ``trigger(availableNow=True)`` does exactly
that: each run picks up only the CSV files that landed since the last run
(tracked in the stream checkpoint), processes them, and stops. Ticket
classification and lead enrichment are per-row maps, so they stream as-is;
the anomaly detector needs each segment's whole history and stays a batch
job over the raw table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators import clean as C
from tidewater.operators import leads as L
from tidewater.operators import tickets as T
from tidewater.schemas import SOURCE_COLUMNS
from tidewater.sources.files import CORRUPT, csv_options, header_schema, normalize_nulls, reads_all


def stream_source(spark: SparkSession, source_dir: str, name: str, multiline: bool = False) -> DataFrame:
    """Streaming read of ``<dir>/<name>*.csv``: columns bound by the name in the header of the
    files present at the start (all files of a source share it; ``enforceSchema`` is off, so one
    with another header fails). Rows that don't match their header have ``_corrupt`` set."""
    schema = header_schema(spark, f"{source_dir.rstrip('/')}/{name}*.csv", name, multiline)
    df = (spark.readStream.schema(schema).options(**csv_options(multiline))
          .option("pathGlobFilter", f"{name}*.csv").csv(source_dir))
    return df.where(reads_all(df))


def _run(source: DataFrame, name: str, enrich, out_dir: str, table: str, checkpoint: str) -> StreamingQuery:
    """Per batch: enriched rows to ``<table>``, rows that don't match the header to
    ``<table>_rejects``; each batch writes its own folder anew, so a repeated batch adds nothing."""
    base = f"{out_dir.rstrip('/')}/mart/{table}"

    def write(batch: DataFrame, batch_id: int) -> None:
        good = normalize_nulls(batch.where(F.col(CORRUPT).isNull()).select(*SOURCE_COLUMNS[name]))
        enrich(good).write.mode("overwrite").parquet(f"{base}/batch={batch_id}")
        (batch.where(F.col(CORRUPT).isNotNull()).select(F.lit(name).alias("table"), F.col(CORRUPT).alias("row"))
         .write.mode("overwrite").parquet(f"{base}_rejects/batch={batch_id}"))

    return (source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def classify_new_tickets(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                         multiline: bool = False) -> StreamingQuery:
    """Classify the tickets of newly arrived files and add them to
    ``<out_dir>/mart/ticket_classifications_stream``. ``checkpoint`` (a lasting, shared folder)
    remembers what earlier runs handled."""
    return _run(stream_source(spark, source_dir, "support_tickets", multiline), "support_tickets",
                lambda df: T.classify_tickets(C.clean_tickets(df)), out_dir, "ticket_classifications_stream", checkpoint)


def enrich_new_leads(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                     multiline: bool = False) -> StreamingQuery:
    """Enrich the leads of newly arrived files, in the same way."""
    return _run(stream_source(spark, source_dir, "crm_leads", multiline), "crm_leads",
                lambda df: L.enrich_leads(C.clean_leads(df)), out_dir, "lead_enrichments_stream", checkpoint)
