"""The daily batch job: extract -> raw -> enrich -> mart -> checks -> report -> ledger.

Each stage is a lazy DataFrame; actions happen only at the writes. Each source is
parsed once: one write deals its rows to accepted, rejected and unreadable ones, and the
counts come from that job. The enrichment stage reads the *written* raw tables back, which
cuts lineage (a lost executor recomputes from Parquet, not from the CSV parse) and lets
Parquet pushdown serve the narrow enrichment projections. All tables of a run become visible
in one commit at its end (``sinks.commits``); a run that fails leaves the tables of the last
one. Every attempt of a run has its own number and ledger rows, and the ledger view shows the
latest attempt.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions import lexicon as lx
from tidewater.operators import clean as C
from tidewater.operators import delivery as D
from tidewater.operators import leads as L
from tidewater.operators import quality as QC
from tidewater.operators import revenue as R
from tidewater.operators import responses as RS
from tidewater.operators import reviews as RV
from tidewater.operators import tickets as T
from tidewater.schemas import DEFAULTS, RAW_SCHEMAS
from tidewater.sinks import warehouse as W
from tidewater.sinks.commits import RunWrites, claim_attempt, read_table
from tidewater.sources.files import CORRUPT, assert_source_marker, read_landing


@dataclass
class ModelResponses:
    """Responses written by whatever called the model.

    ``request_id`` names the requests of ``write_model_requests`` they answer. ``tickets`` /
    ``leads``: (batch_id, content); ``reviews``: (product_id, review_window, content).
    """
    provider: str
    request_id: str
    model: str | None = None
    tickets: DataFrame | None = None
    reviews: DataFrame | None = None
    leads: DataFrame | None = None


@dataclass
class RunResult:
    run_id: str
    status: str
    rows_extracted: int = 0
    rows_loaded: dict[str, int] = field(default_factory=dict)
    rows_enriched: dict[str, int] = field(default_factory=dict)
    error: str | None = None
    llm_calls: int = 0
    llm_cost_estimate: float = 0.0
    fell_back: list[str] = field(default_factory=list)
    rows_rejected: int = 0
    rows_unreadable: int = 0
    commit: int = 0
    violations: int = 0
    message: str | None = None

    @property
    def total_enriched(self) -> int:
        return sum(self.rows_enriched.values())


def run_pipeline(spark: SparkSession, sources: dict[str, DataFrame] | str, out_dir: str,
                 run_id: str, *, now: dt.datetime | None = None,
                 threshold: float = lx.ANOMALY_THRESHOLD_DEFAULT,
                 responses: ModelResponses | None = None,
                 on_stage: Callable[[str], None] | None = None,
                 marts: str = "replace", multiline: bool = False) -> RunResult:
    """Run the whole job once. ``sources`` is a CSV folder (``multiline``: with quoted line
    breaks) or a dict of the five source DataFrames (e.g. from the adapters). With ``responses`` the
    enrichers merge the model's answers (rules fill the gaps; a failed
    operation falls back to rules and is flagged in the ledger). ``marts="upsert"`` writes only
    rows that changed into the marts and keeps rows of keys that a run doesn't produce.
    ``on_stage`` is told each stage and each mart before it is written."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = out_dir.rstrip("/")
    ledger_path = f"{out}/mart/pipeline_runs_log"
    mode = "llm" if responses is not None else "mock"
    known = W.next_attempt(spark.read.parquet(ledger_path), run_id) - 1 if W.table_exists(spark, ledger_path) else 0
    attempt = claim_attempt(spark, out, run_id, after=known)
    writes = RunWrites(spark, out, run_id, attempt)
    W.commit_write(W.start_run(spark, run_id, now, mode,
                               responses.provider if responses else None,
                               responses.model if responses else None, attempt),
                   ledger_path, mode="append")
    result = RunResult(run_id=run_id, status="running")
    try:
        if isinstance(sources, str):
            assert_source_marker(spark, sources)
            sources = {n: read_landing(spark, sources, n, multiline) for n in lx.SOURCE_NAMES}
        if on_stage:
            on_stage("load_raw")
        rejects = []
        for name, df in sources.items():
            rejects.append(_land(writes, name, df, now, result))
        result.rows_rejected = writes.replace("raw/rejected_rows", reduce(DataFrame.unionByName, rejects))["rows"]

        raw = {name: writes.read(f"raw/{name}") for name in sources}
        if on_stage:
            on_stage("enrich")
        found = {
            "ticket_classifications": T.classify_tickets(raw["support_tickets"]),
            "review_summaries": RV.summarize_reviews(raw["product_reviews"]),
            "revenue_anomalies": R.detect_anomalies(
                R.daily_revenue_by_segment(raw["orders"]), threshold=threshold),
            "lead_enrichments": L.enrich_leads(raw["crm_leads"]),
        }
        if responses is not None:
            found = _merge_model(spark, raw, found, responses, run_id, result, out)
        for table, df in found.items():
            if on_stage:
                on_stage(table)
            result.rows_enriched[table] = W.put_mart(writes, df, table, now, marts)

        if on_stage:
            on_stage("report")
        mart = {t: writes.read(f"mart/{t}") for t in found}
        ledger = ledger_view(spark, out)
        checks = writes.replace("mart/quality_report", QC.warehouse_report({**raw, **mart, "pipeline_runs": ledger}),
                                counts={"violations": F.sum("violations")})
        result.violations = int(checks["violations"] or 0)
        run_row = ledger.filter(F.col("run_id") == run_id)
        report = D.run_report(run_row, D.for_run(mart["ticket_classifications"], run_id),
                              D.for_run(mart["revenue_anomalies"], run_id))
        W.commit_write(report, f"{out}/mart/run_reports/run_id={run_id}")
        if on_stage:
            on_stage("publish")
        result.commit = writes.publish()
        result.status = "success"
    except Exception as exc:  # the ledger records the failure, then re-raises
        result.status = "failed"
        result.error = f"{type(exc).__name__}: {exc}"
        raise
    finally:
        W.commit_write(W.finalize_run(
            spark, run_id, finished_at=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            status=result.status, rows_extracted=result.rows_extracted,
            rows_loaded=sum(result.rows_loaded.values()), rows_enriched=result.total_enriched,
            llm_calls=result.llm_calls, llm_cost_estimate=result.llm_cost_estimate,
            report_path=f"{out}/mart/run_reports/run_id={run_id}" if result.status == "success"
            else None, slack_sent=False,
            error=result.error or ("; ".join(result.fell_back) or None), attempt=attempt),
            ledger_path, mode="append")
        row = D.run_message(ledger_view(spark, out).where(F.col("run_id") == run_id)).first()
        result.message = row["message"] if row else None
    return result


def _land(writes: RunWrites, name: str, df: DataFrame, now: dt.datetime, result: RunResult) -> DataFrame:
    """K1 for one source: one write of all its rows by outcome; returns the reject table's part."""
    rows = C.judged_rows(df, name, CORRUPT if CORRUPT in df.columns else None)
    stamped = W.conform(rows, StructType([*RAW_SCHEMAS[name], *(rows.schema[c] for c in (C.REJECT, "raw_row", "outcome"))]),
                        now, DEFAULTS.get(name))
    counts = {o: F.count_if(F.col("outcome") == o) for o in sorted(C.OUTCOMES)}
    seen, landed = writes.land(f"raw/{name}", stamped, RAW_SCHEMAS[name], "outcome", C.ACCEPTED, counts)
    result.rows_loaded[name] = int(seen[C.ACCEPTED])
    result.rows_extracted += int(seen[C.ACCEPTED]) + int(seen[C.REJECTED])
    result.rows_unreadable += int(seen[C.UNREADABLE])
    return C.rejects_of(landed, name)


OPERATIONS = {  # operation -> (name in the ledger, key columns, response schema)
    "tickets": ("classify_tickets", ["batch_id"], RS.TICKET_RESULT),
    "reviews": ("summarize_reviews", ["product_id", "review_window"], RS.REVIEW_RESULT),
    "leads": ("enrich_leads", ["batch_id"], RS.LEAD_RESULT),
}


def model_requests(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The request rows (ticket batches, review prompts, lead batches) built from the
    raw tables."""
    summaries = RV.summarize_reviews(raw["product_reviews"])
    return {"tickets": RS.build_ticket_batches(raw["support_tickets"]),
            "reviews": RS.build_review_prompts(summaries),
            "leads": RS.build_lead_batches(raw["crm_leads"])}


def _requests_path(out_dir: str, request_id: str, op: str) -> str:
    return f"{out_dir.rstrip('/')}/mart/model_requests/request_id={request_id}/{op}"


def write_model_requests(spark: SparkSession, out_dir: str, request_id: str) -> dict[str, int]:
    """Write the request rows for an external model caller to
    ``<out_dir>/mart/model_requests/request_id=<request_id>/<operation>`` (from the written raw
    tables). Responses name the ``request_id`` they answer."""
    out = out_dir.rstrip("/")
    raw = {n: read_table(spark, out, f"raw/{n}") for n in ("support_tickets", "product_reviews", "crm_leads")}
    return {op: W.commit_write(df, _requests_path(out, request_id, op)) for op, df in model_requests(raw).items()}


def _merge_model(spark: SparkSession, raw: dict[str, DataFrame], marts: dict[str, DataFrame],
                 responses: ModelResponses, run_id: str, result: RunResult,
                 out_dir: str) -> dict[str, DataFrame]:
    """E7-E11 inside the job: each response table is parsed and written once, and the merge, the
    fallback flag and the call count come from that table. Fails if the requests named by the
    responses don't exist or don't hold a call that is answered."""
    out = dict(marts)
    given = {"tickets": responses.tickets, "reviews": responses.reviews, "leads": responses.leads}
    calls, statuses = [], []
    for op, answers in given.items():
        if answers is None:
            continue
        name, keys, schema = OPERATIONS[op]
        requests = spark.read.parquet(_requests_path(out_dir, responses.request_id, op))
        path = f"{out_dir}/mart/model_responses/run_id={run_id}/{op}"
        W.commit_write(RS.parse_response(answers, schema), path)
        parsed = spark.read.parquet(path)
        if parsed.join(requests.select(*keys), keys, "left_anti").limit(1).count():
            raise ValueError(f"{name}: responses to calls that request {responses.request_id} does not hold")
        if op == "tickets":
            out["ticket_classifications"] = RS.merge_ticket_responses(raw["support_tickets"], requests, parsed)
        elif op == "reviews":
            answered = parsed.where(RS.all_answered(requests, parsed, keys, schema))
            out["review_summaries"] = RS.merge_review_responses(marts["review_summaries"], answered, fallback=False)
        else:
            out["lead_enrichments"] = RS.merge_lead_responses(marts["lead_enrichments"], requests, parsed)
        statuses.append(RS.fallback_status(name, requests, parsed, keys, schema))
        calls.append(requests.select(F.lit(run_id).alias("run_id"), F.lit(responses.provider).alias("provider"), F.lit(1).alias("n_calls")))
    if calls:
        log = calls[0]
        for c in calls[1:]:
            log = log.unionByName(c)
        for row in RS.estimate_cost(log).collect():  # one row
            result.llm_calls, result.llm_cost_estimate = int(row.llm_calls), float(row.llm_cost_estimate)
    for st in statuses:  # one row per operation
        result.fell_back += [row.error for row in st.collect() if row.fell_back]
    return out


def ledger_view(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current state of every run (``pipeline_runs``) from the append-only log."""
    return W.run_ledger(spark.read.parquet(f"{out_dir.rstrip('/')}/mart/pipeline_runs_log"))

