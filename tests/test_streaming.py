"""Incremental (availableNow) streaming runs pick up only new files."""

import csv
import tempfile

from tidewater.schemas import SOURCE_COLUMNS
from tidewater.streaming.incremental import classify_new_tickets


def _tickets_file(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(SOURCE_COLUMNS["support_tickets"])
        w.writerows(rows)


def test_incremental_ticket_runs(spark):
    src = tempfile.mkdtemp(prefix="tidewater-stream-src-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="tidewater-stream-out-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="tidewater-stream-ckpt-", dir="/tmp")
    _tickets_file(f"{src}/support_tickets_day1.csv", [
        ["t1", "C-1", "2026-07-01T10:00:00", "email", "en", "Refund request", "charged twice",
         "open", "true"]])
    q = classify_new_tickets(spark, src, out, checkpoint=ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(f"{out}/mart/ticket_classifications_stream")
    assert [(r.ticket_id, r.category) for r in first.collect()] == [("t1", "billing")]
    _tickets_file(f"{src}/support_tickets_day2.csv", [
        ["t2", "C-2", "2026-07-02T10:00:00", "chat", "fr", "Colis en retard", "toujours en transit",
         "open", "false"]])
    q = classify_new_tickets(spark, src, out, checkpoint=ckpt)
    q.awaitTermination(120)
    both = spark.read.parquet(f"{out}/mart/ticket_classifications_stream")
    assert sorted((r.ticket_id, r.category) for r in both.collect()) == [
        ("t1", "billing"), ("t2", "shipping")]
