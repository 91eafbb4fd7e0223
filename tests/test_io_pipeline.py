"""Sources, sinks, ledger, pipeline and model-response tests."""

import datetime as dt
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.operators import responses as RS
from tidewater.operators import tickets as T
from tidewater.plans.pipeline import ledger_view, run_pipeline
from tidewater import schemas as SC
from tidewater.schemas import SOURCE_COLUMNS
from tidewater.sinks import warehouse as W
from tidewater.sinks.commits import read_table
from tidewater.sources import files as S

from conftest import SF_SMALL


@pytest.fixture()
def scratch():
    # a fresh folder per test; never removed by the tests
    return tempfile.mkdtemp(prefix="tidewater-test-", dir="/tmp")


def _write_csv(folder, name, rows):
    import csv
    with open(f"{folder}/{name}.csv", "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(SOURCE_COLUMNS[name])
        w.writerows(rows)


def _seed(folder, marker=True):
    with open(f"{folder}/README.md", "w") as fh:
        fh.write("# Seed\nSAMPLE / DEMO data\n" if marker else "# Seed\nreal data\n")
    _write_csv(folder, "orders", [
        ["o1", "C-1", "2026-07-01", "web", "EU", "EUR", "100.00", "10.00", "90.00", "2"],
        ["o2", "C-2", "2026-07-01", "web", "EU", "EUR", "50.00", "N/A", "50.00", "1"],
        ["o3", "C-3", "2026-07-02", "mobile", "FR", "EUR", "20.00", "0.00", "20.00", "NA"]])
    _write_csv(folder, "support_tickets", [
        ["t1", "C-1", "2026-07-01T10:00:00", "email", "en", "Refund request",
         "I was charged twice", "open", "true"],
        ["t2", "C-2", "2026-07-01T11:00:00", "chat", "fr", "Colis en retard",
         "Ma commande devait arriver le 2026-07-20 mais a du retard", "open", ""]])
    _write_csv(folder, "product_reviews", [
        ["r1", "p1", "Product 1", "2026-07-01T00", "5", "en", "Great", "Loved it", "true"],
        ["r2", "p1", "Product 1", "2026-07-03T00", "4.5", "en", "Good", "Nice", "false"]])
    _write_csv(folder, "web_analytics", [
        ["2026-07-01", "/", "FR", "desktop", "10", "", "30.5", "100.25"]])
    _write_csv(folder, "crm_leads", [
        ["LD-1", "Acme", "SaaS", "FR", "2026-07-01T00", "referral", "won", "50000",
         "Met at event. Large team, ~60 people."],
        ["LD-2", "Bright", "Retail", "UK", "2026-07-01T00", "ads", "new", "", ""]])


def test_csv_sources_and_counts(spark, scratch):
    _seed(scratch)
    src = S.extract_all(spark, scratch)
    orders = {r.order_id: r for r in src["orders"].collect()}
    assert orders["o2"].discount_eur is None and orders["o3"].units is None
    counts = {r.source: r.n_rows for r in S.source_row_counts(src).collect()}
    assert counts == {"orders": 3, "support_tickets": 2, "product_reviews": 2,
                      "web_analytics": 1, "crm_leads": 2, "total": 10}


def test_source_marker_guard(spark, scratch):
    _seed(scratch, marker=False)
    with pytest.raises(RuntimeError):
        S.extract_all(spark, scratch)


def test_run_pipeline_csv(spark, scratch):
    src = tempfile.mkdtemp(prefix="tidewater-src-", dir="/tmp")
    _seed(src)
    now = dt.datetime(2026, 8, 2, 6, 0, 0)
    res = run_pipeline(spark, src, scratch, "run-a", now=now)
    assert res.status == "success" and res.rows_extracted == 10
    assert res.rows_loaded == {"orders": 2, "support_tickets": 2, "product_reviews": 1,
                               "web_analytics": 1, "crm_leads": 2}
    assert res.rows_enriched["ticket_classifications"] == 2
    assert res.rows_enriched["revenue_anomalies"] == 0
    cls = read_table(spark, scratch, "mart/ticket_classifications")
    assert {r.run_id for r in cls.collect()} == {"run-a"}
    assert dict(cls.select("ticket_id", "category").collect()) == {"t1": "billing",
                                                                     "t2": "shipping"}
    view = ledger_view(spark, scratch).collect()[0]
    assert view.status == "success" and view.rows_extracted == 10
    assert view.started_at is not None and view.finished_at is not None
    assert view.enrichment_mode == "mock"
    lines = spark.read.parquet(f"{scratch}/mart/run_reports/run_id=run-a").collect()
    assert {(r.section, r.line) for r in lines} >= {
        ("anomalies", "No significant revenue anomalies detected.")}
    from tidewater.operators.delivery import dashboard
    dash = dashboard(spark, scratch, "fr")
    kpi = dash["kpis"].collect()[0]
    assert (kpi.total_orders, kpi.total_tickets, kpi.total_leads) == (2, 2, 2)
    assert kpi.total_revenue == Decimal("110.00")
    assert dash["leads"].columns == ["lead_id", "company_size_band", "lead_score", "notes"]
    assert dash["tickets_by_category"].count() == 2
    assert res.rows_rejected == 2 and res.message.startswith("Pipeline run run-a completed")
    rejects = {(r.table, r.row_key, r.reason) for r in read_table(spark, scratch, "raw/rejected_rows").collect()}
    assert rejects == {("orders", "o2", "net_revenue_eur"), ("product_reviews", "r2", "rating")}
    report = read_table(spark, scratch, "mart/quality_report").collect()
    assert {r.table for r in report} == set(SC.TABLE_SCHEMAS) and res.violations == sum(r.violations for r in report)
    # a further run: tables replaced, ledger keeps one view row per run
    run_pipeline(spark, src, scratch, "run-b", now=now)
    assert {r.run_id for r in read_table(spark, scratch, "mart/ticket_classifications")
            .collect()} == {"run-b"}
    assert ledger_view(spark, scratch).count() == 2


def test_run_pipeline_on_driver_tables(spark, scratch):
    from tidewater.plans.registry import source
    srcs = {n: source(spark, SF_SMALL, n) for n in SOURCE_COLUMNS}
    res = run_pipeline(spark, srcs, scratch, "run-sf", now=dt.datetime(2026, 1, 1))
    assert res.status == "success"
    assert res.rows_enriched["revenue_anomalies"] > 0
    assert res.rows_enriched["ticket_classifications"] == res.rows_loaded["support_tickets"]


def test_write_mart_keeps_table_when_empty(spark, scratch):
    df = spark.createDataFrame([("t1", "bug", "negative", "medium", Decimal("0.5"), "en")],
                               "ticket_id string, category string, sentiment string, "
                               "urgency string, confidence decimal(4,3), detected_language string")
    assert W.write_mart(df, "ticket_classifications", scratch, "r1") == 1
    assert W.write_mart(df.limit(0), "ticket_classifications", scratch, "r2") == 0
    back = spark.read.parquet(f"{scratch}/mart/ticket_classifications").collect()
    assert [(r.ticket_id, r.run_id) for r in back] == [("t1", "r1")]
    assert back[0].enriched_at is not None


def test_upsert_and_encode(spark):
    cur = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    inc = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert sorted(W.upsert_by_key(cur, inc, ["k"]).collect()) == [("a", 1), ("b", 20), ("c", 30)]
    nested = spark.createDataFrame([("x", ["a", "b"])], "id string, tags array<string>")
    assert W.encode_nested(nested).collect()[0].tags == '["a","b"]'


def test_run_ledger_fold_and_status(spark):
    t0 = dt.datetime(2026, 8, 1, 6, 0)
    rows = W.start_run(spark, "r1", t0, "mock").unionByName(W.finalize_run(
        spark, "r1", finished_at=t0 + dt.timedelta(minutes=5), status="success",
        rows_extracted=10, rows_enriched=7, llm_calls=0, llm_cost_estimate=0,
        report_path=None, slack_sent=True))
    v = W.run_ledger(rows).collect()[0]
    assert (v.status, v.rows_extracted, v.rows_enriched, v.enrichment_mode, v.slack_sent) == \
        ("success", 10, 7, "mock", True)
    assert v.started_at == t0
    tasks = spark.createDataFrame([("r1", "a", "success"), ("r1", "b", "failed"),
                                   ("r2", "a", "success"), ("r2", "finalize", "failed")],
                                  "run_id string, task_id string, state string")
    st = dict(W.run_status(tasks, exclude_task="finalize").collect())
    assert st == {"r1": "failed", "r2": "success"}


TICKET_ROWS = [("TKT-1", "App crashes on login. Console shows a 500 error."),
               ("TKT-2", "Refund request. I was charged twice."),
               ("TKT-3", "Colis en retard. Ma commande devait arriver le 20 mais a du retard."),
               ("TKT-4", "General question.")]


def _tickets(spark):
    return spark.createDataFrame(TICKET_ROWS, "ticket_id string, text string")


def test_ticket_batches(spark):
    rows = [(f"TKT-{i}", "x" * 600) for i in range(95)]
    b = RS.build_ticket_batches(spark.createDataFrame(rows, "ticket_id string, text string"),
                                n_buckets=2).collect()
    assert sum(r.n_items for r in b) == 95 and max(r.n_items for r in b) <= 40
    assert all(len(it.text) == 600 for r in b for it in r.items)  # whole texts
    assert b[0].user_message.startswith("Classify each ticket:\n[{")
    assert "feature_request" in b[0].system_message and '"results"' in b[0].system_message
    cut = RS.build_ticket_batches(spark.createDataFrame(rows, "ticket_id string, text string"), max_chars=500).collect()
    assert all(len(it.text) == 500 for r in cut for it in r.items)
    late = spark.createDataFrame([("T", "x" * 600 + "a"), ("T", "x" * 600 + "b"), ("T", "x" * 600 + "a")], "ticket_id string, text string")
    assert sum(r.n_items for r in RS.build_ticket_batches(late).collect()) == 2  # they differ late in the text


def test_batches_are_bounded_by_bytes(spark):
    def plain(items, limit):  # items of one slice in order -> pieces
        sizes = [len(t.encode()) for _, t in items]
        if sum(sizes) <= limit:
            return [items]
        out, run = {}, 0
        for i, (item, size) in enumerate(zip(items, sizes)):
            out.setdefault(-1 - i if size > limit // 2 else run // (limit // 2), []).append(item)
            run += 0 if size > limit // 2 else size
        return list(out.values())

    rows = [(f"T{i:03}", "é" * (i * 37 % 90)) for i in range(200)] + [("T500", "x" * 5000), ("T501", "")]
    got = RS.build_ticket_batches(spark.createDataFrame(rows, "ticket_id string, text string"), n_buckets=1, max_bytes=1000).collect()
    ordered = sorted(rows)
    want = [p for k in range(0, len(ordered), 40) for p in plain(ordered[k:k + 40], 1000)]
    assert sorted([(it.id, it.text) for it in r["items"]] for r in got) == sorted(want)
    assert len({r.batch_id for r in got}) == len(got) and sum(r.n_items for r in got) == len(rows)
    assert all(r.n_items == 1 or sum(len(it.text.encode()) for it in r["items"]) <= 1000 for r in got)


def test_batches_of_long_texts(spark):
    rows = spark.range(4000).select(F.concat(F.lit("T"), F.col("id")).alias("ticket_id"), F.repeat(F.concat(F.col("id"), F.lit(" word ")), 100_000 // 8).alias("text"))
    batches = RS.build_ticket_batches(rows).select("batch_id", "n_items", F.octet_length("user_message").alias("bytes"),
                                                   F.expr("aggregate(items, 0L, (n, x) -> n + octet_length(x.text))").alias("payload"))
    got = batches.collect()
    assert sum(r.n_items for r in got) == 4000 and max(r.payload for r in got) <= RS.BATCH_BYTES
    assert len({r.batch_id.split("-")[0] for r in got}) >= sum(r.payload for r in got) // RS.BUCKET_BYTES  # buckets follow the bytes


@pytest.mark.parametrize("content,valid", [
    ('{"results": []}', True), ('```json\n{"results": []}\n```', True),
    ('Sure! {"results": []} Anything else?', True), ("", False), ("not json", False),
    ('{"results": [1, }', False), (None, False), ('{"results": []} and {more}', False),
    ('{"results": [{"id": "a", "id": "b", "confidence": NaN}]}', True), ('{"results": "text"}', False)])
def test_parse_response(spark, content, valid):
    df = spark.createDataFrame([("b", content)], "batch_id string, content string")
    assert RS.parse_response(df).collect()[0].is_valid is valid


def test_merge_ticket_responses_cases(spark):
    tickets = _tickets(spark)
    batches = RS.build_ticket_batches(tickets, n_buckets=1)
    bid = batches.collect()[0].batch_id
    content = ('```json\n{"results": ['
               '{"id": "TKT-1", "category": "Feature Request", "sentiment": "Negative", '
               '"urgency": "high", "confidence": "high"},'
               '{"id": "TKT-2", "category": "spam", "confidence": 1.7},'
               '{"id": "TKT-2", "category": "billing", "sentiment": "positive", "confidence": 0.91},'
               '{"id": "TKT-99", "category": "bug"},'
               '{"category": "bug"}]}\n```')
    resp = spark.createDataFrame([(bid, content)], "batch_id string, content string")
    out = {r.ticket_id: r for r in RS.merge_ticket_responses(tickets, batches, resp).collect()}
    assert set(out) == {"TKT-1", "TKT-2", "TKT-3", "TKT-4"}
    assert (out["TKT-1"].category, out["TKT-1"].sentiment, out["TKT-1"].urgency,
            out["TKT-1"].confidence) == ("feature_request", "negative", "high", Decimal("0.700"))
    assert (out["TKT-2"].category, out["TKT-2"].confidence) == ("billing", Decimal("0.910"))
    rules = {r.ticket_id: r for r in T.classify_tickets(tickets).collect()}
    assert out["TKT-3"] == rules["TKT-3"] and out["TKT-4"] == rules["TKT-4"]
    assert out["TKT-3"].detected_language == "fr"


def test_merge_ticket_responses_fallback(spark):
    tickets = _tickets(spark)
    batches = RS.build_ticket_batches(tickets, n_buckets=1)
    bid = batches.collect()[0].batch_id
    resp = spark.createDataFrame([(bid, "")], "batch_id string, content string")
    out = sorted(RS.merge_ticket_responses(tickets, batches, resp).collect())
    assert out == sorted(T.classify_tickets(tickets).collect())
    st = RS.fallback_status("classify_tickets", batches, resp, ["batch_id"]).collect()[0]
    assert st.fell_back and "1 call(s)" in st.error
    ok = spark.createDataFrame([(bid, '{"results": []}')], "batch_id string, content string")
    assert not RS.fallback_status("x", batches, ok, ["batch_id"]).collect()[0].fell_back


def test_estimate_cost(spark):
    log = spark.createDataFrame([("r", "anthropic", 2), ("r", "nvidia", 5), ("r", "other", 1)],
                                "run_id string, provider string, n_calls int")
    row = RS.estimate_cost(log).collect()[0]
    assert row.llm_calls == 8 and row.llm_cost_estimate == Decimal("0.045000")


def test_partition_count_invariance(spark):
    from tidewater.plans.registry import cleaned
    from tidewater.operators import reviews as RV
    t = cleaned(spark, SF_SMALL, "support_tickets")
    a = T.classify_tickets(t.repartition(1)).collect()
    b = T.classify_tickets(t.repartition(7)).collect()
    assert sorted(a) == sorted(b)
    r = cleaned(spark, SF_SMALL, "product_reviews")
    ra = RV.summarize_reviews(r.repartition(1)).collect()
    rb = RV.summarize_reviews(r.repartition(5)).collect()
    assert sorted(map(str, ra)) == sorted(map(str, rb))


def test_confidence_and_score_ranges(spark):
    from tidewater.operators import leads as L
    from tidewater.plans.registry import cleaned
    c = T.classify_tickets(cleaned(spark, SF_SMALL, "support_tickets"))
    lo, hi = c.agg(F.min("confidence"), F.max("confidence")).collect()[0]
    assert Decimal("0.45") <= lo and hi <= Decimal("0.95")
    s = L.enrich_leads(cleaned(spark, SF_SMALL, "crm_leads"))
    lo, hi = s.agg(F.min("lead_score"), F.max("lead_score")).collect()[0]
    assert 0 <= lo and hi <= 100


def test_run_pipeline_model_mode(spark, scratch):
    from tidewater.plans.pipeline import ModelResponses, write_model_requests
    from tidewater.sources import adapters as AD
    src = tempfile.mkdtemp(prefix="tidewater-src-", dir="/tmp")
    _seed(src)
    run_pipeline(spark, src, scratch, "run-rules", now=dt.datetime(2026, 8, 2))
    written = write_model_requests(spark, scratch, "req-1")
    assert written["tickets"] >= 1 and written["leads"] >= 1
    raw_t = read_table(spark, scratch, "raw/support_tickets")
    batches = RS.build_ticket_batches(raw_t)
    # responses arrive as a written table, independent of the raw files a run replaces
    resp_dir = tempfile.mkdtemp(prefix="tidewater-resp-", dir="/tmp")
    AD.ticket_responses_source(batches).write.mode("overwrite").parquet(f"{resp_dir}/ok")
    ok = spark.read.parquet(f"{resp_dir}/ok")
    rules = sorted(T.classify_tickets(raw_t).collect())
    batch_ids = [r.batch_id for r in batches.collect()]
    res = run_pipeline(spark, src, scratch, "run-llm", now=dt.datetime(2026, 8, 3),
                       responses=ModelResponses(provider="anthropic", tickets=ok, request_id="req-1"))
    assert res.llm_calls == written["tickets"] and not res.fell_back
    assert abs(res.llm_cost_estimate - 0.0225 * res.llm_calls) < 1e-9
    v = {r.run_id: r for r in ledger_view(spark, scratch).collect()}["run-llm"]
    assert (v.enrichment_mode, v.llm_provider, v.status) == ("llm", "anthropic", "success")
    bad = spark.createDataFrame([(b, "") for b in batch_ids],
                                "batch_id string, content string")
    res = run_pipeline(spark, src, scratch, "run-bad", now=dt.datetime(2026, 8, 4),
                       responses=ModelResponses(provider="nvidia", tickets=bad, request_id="req-1"))
    assert res.fell_back and "classify_tickets" in res.fell_back[0]
    v = {r.run_id: r for r in ledger_view(spark, scratch).collect()}["run-bad"]
    assert v.error.startswith("classify_tickets: no usable response")
    cls = read_table(spark, scratch, "mart/ticket_classifications").drop("enriched_at", "run_id")
    assert sorted(cls.collect()) == rules


def test_batches_with_hot_copies_keep_every_row(spark):
    rows = [("TKT-0", "App crashes with error")] * 30 + \
           [(f"TKT-{i}", f"Refund request {i}") for i in range(1, 61)]
    tickets = spark.createDataFrame(rows, "ticket_id string, text string")
    batches = RS.build_ticket_batches(tickets, n_buckets=4)
    b = batches.collect()
    assert sum(r.n_items for r in b) == 61 and max(r.n_items for r in b) <= 40
    content = [(r.batch_id, '{"results": [' + ", ".join(
        f'{{"id": "{it.id}", "category": "account"}}' for it in r.items) + "]}") for r in b]
    resp = spark.createDataFrame(content, "batch_id string, content string")
    out = RS.merge_ticket_responses(tickets, batches, resp).collect()
    assert len(out) == 90 and {r.category for r in out} == {"account"}


def test_csv_quoted_multiline_and_empty_inputs(spark, scratch):
    _seed(scratch)
    _write_csv(scratch, "support_tickets", [
        ["t9", "C-9", "2026-07-01T10:00:00", "email", "en", "Refund, please",
         'Line one\nline "two", charged twice', "open", "YES"]])
    t = S.read_source(spark, scratch, "support_tickets", multiline=True).collect()
    assert len(t) == 1 and t[0].description == 'Line one\nline "two", charged twice'
    cls = T.classify_tickets(__import__("tidewater.operators.clean", fromlist=["x"])
                             .clean_tickets(S.read_source(spark, scratch, "support_tickets", multiline=True)))
    assert cls.collect()[0].category == "billing"
    empty = S.read_source(spark, scratch, "support_tickets").limit(0)
    from tidewater.operators import clean as C, reviews as RV, leads as L
    assert T.classify_tickets(C.clean_tickets(empty)).count() == 0
    assert RV.summarize_reviews(C.clean_reviews(
        S.read_source(spark, scratch, "product_reviews").limit(0))).columns == [
        "product_id", "review_window", "n_reviews", "avg_rating", "summary_en", "summary_fr",
        "top_themes"]
    assert L.enrich_leads(C.clean_leads(S.read_source(spark, scratch, "crm_leads").limit(0))) \
        .columns == ["lead_id", "company_size_band", "lead_score", "intent_signals",
                     "notes_en", "notes_fr"]


def test_to_eur_unknown_currency(spark):
    from tidewater.operators import clean as C
    df = spark.createDataFrame([("a", "USD", Decimal("100.00")), ("b", "JPY", Decimal("5.00"))],
                               "order_id string, currency string, net_revenue_eur decimal(12,2)")
    out = dict(C.to_eur(df).select("order_id", "net_revenue_eur").collect())
    assert out == {"a": Decimal("92.00"), "b": None}


def test_rerun_takes_the_latest_attempt(spark, scratch):
    src = tempfile.mkdtemp(prefix="tidewater-src-", dir="/tmp")
    _seed(src)
    now = dt.datetime(2026, 8, 2, 6, 0, 0)

    def boom(stage):
        if stage == "report":
            raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        run_pipeline(spark, src, scratch, "r", now=now, on_stage=boom)
    v = ledger_view(spark, scratch).collect()[0]
    assert (v.status, v.error, v.report_path, v.attempt) == ("failed", "RuntimeError: boom", None, 1)
    run_pipeline(spark, src, scratch, "r", now=now)
    v = ledger_view(spark, scratch).collect()[0]
    assert (v.status, v.error, v.attempt) == ("success", None, 2) and v.report_path
    with pytest.raises(RuntimeError):
        run_pipeline(spark, src, scratch, "r", now=now, on_stage=boom)
    v = ledger_view(spark, scratch).collect()[0]
    assert (v.status, v.error, v.report_path, v.attempt) == ("failed", "RuntimeError: boom", None, 3)


def test_responses_must_answer_their_requests(spark, scratch):
    from tidewater.plans.pipeline import ModelResponses, write_model_requests
    src = tempfile.mkdtemp(prefix="tidewater-src-", dir="/tmp")
    _seed(src)
    run_pipeline(spark, src, scratch, "r0", now=dt.datetime(2026, 8, 2))
    write_model_requests(spark, scratch, "q1")
    odd = spark.createDataFrame([("99-99", "{}")], "batch_id string, content string")
    with pytest.raises(ValueError):
        run_pipeline(spark, src, scratch, "r1", responses=ModelResponses(provider="x", request_id="q1", tickets=odd))
    with pytest.raises(Exception):
        run_pipeline(spark, src, scratch, "r2", responses=ModelResponses(provider="x", request_id="none", tickets=odd))


def test_report_leaves_out_unknown_runs(spark):
    from tidewater.operators import delivery as D
    runs = spark.createDataFrame([("a",), ("b",)], "run_id string")
    cls = spark.createDataFrame([("a", "bug"), ("zz", "bug")], "run_id string, category string")
    an = spark.createDataFrame([("zz", "i", "d", "v", "critical", Decimal("4.0"))],
                               "run_id string, anomaly_id string, dimension string, dimension_value string, severity string, deviation decimal(10,3)")
    got = {(r.run_id, r.section, r.line) for r in D.run_report(runs, cls, an).collect()}
    assert got == {("a", "categories", "bug: 1"), ("a", "anomalies", D.NO_ANOMALY_LINE),
                   ("b", "categories", D.NO_CATEGORY_LINE), ("b", "anomalies", D.NO_ANOMALY_LINE)}


def test_csv_binds_columns_by_name(spark, scratch):
    cols = SOURCE_COLUMNS["orders"]
    row = dict(zip(cols, ["o1", "C-1", "2026-07-01", "web", "EU", "EUR", "100.00", "10.00", "90.00", "2"]))
    mixed = [*reversed(cols), "extra"]
    with open(f"{scratch}/orders.csv", "w") as fh:
        fh.write(",".join(mixed) + "\n" + ",".join(row.get(c, "x") for c in mixed) + "\n" + "too,few\n" + ",".join(["y"] * 14) + "\n")
    got = S.read_source(spark, scratch, "orders").collect()
    assert [r.asDict() for r in got] == [row] and got[0].__fields__ == cols
    assert S.read_source(spark, scratch, "orders").count() == 1
    assert [r.reason for r in S.read_rejects(spark, scratch, "orders").collect()] == ["fields do not match the header"] * 2
    with open(f"{scratch}/crm_leads.csv", "w") as fh:
        fh.write("lead_id,notes\nl,n\n")
    with pytest.raises(ValueError, match="company_name"):
        S.read_source(spark, scratch, "crm_leads")


def test_failed_rename_keeps_the_old_table(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    W.commit_write(spark.range(3).toDF("id"), path)
    real, calls = W._rename, []

    def fails_second(fs, source, target):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("no")
        real(fs, source, target)

    monkeypatch.setattr(W, "_rename", fails_second)
    with pytest.raises(OSError):
        W.commit_write(spark.range(9).toDF("id"), path)
    assert spark.read.parquet(path).count() == 3
    assert W.commit_write(spark.range(5).toDF("id"), path) == 5 and spark.read.parquet(path).count() == 5


def test_upsert_repeated_keys(spark):
    cur = spark.createDataFrame([("a", 1)], "k string, v int")
    inc = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("b", 4, 1)], "k string, v int, at int")
    assert sorted(W.upsert_by_key(cur, inc, ["k"], order="at").collect()) == [("a", 3), ("b", 4)]
    with pytest.raises(Exception, match="incoming key repeated"):
        W.upsert_by_key(cur, inc, ["k"]).collect()


def test_lead_results_of_other_batches_are_ignored(spark):
    from tidewater.operators import leads as L
    leads = spark.createDataFrame([(f"L{i}", "new", "ads", None, f"note {i}") for i in range(90)],
                                  "lead_id string, status string, source string, est_value_eur decimal(24,2), notes string")
    batches = RS.build_lead_batches(leads)
    b = batches.collect()
    other = next(it.id for it in b[1].items)
    content = [(r.batch_id, '{"results": [' + (f'{{"id": "{other}", "notes_en": "wrong"}}' if r is b[0] else "") + "]}") for r in b]
    base = L.enrich_leads(leads)
    resp = spark.createDataFrame(content, "batch_id string, content string")
    assert sorted(RS.merge_lead_responses(base, batches, resp).collect()) == sorted(base.collect())
    failed = spark.createDataFrame([(r.batch_id, "" if r is b[0] else f'{{"results": [{{"id": "{r["items"][0].id}", "notes_en": "new"}}]}}') for r in b],
                                   "batch_id string, content string")
    assert sorted(RS.merge_lead_responses(base, batches, failed).collect()) == sorted(base.collect())
    assert "new" in {r.notes_en for r in RS.merge_lead_responses(base, batches, failed, fallback=False).collect()}


def test_values_that_do_not_fit_are_rejected_with_a_reason(spark):
    from tidewater.operators import clean as C
    cols = SOURCE_COLUMNS["orders"]
    rows = [("o1", "C", "2026-07-01", "web", "EU", "EUR", "12345678901.005", "0.004", None, "3000000000"),
            ("o2", "C", "2026-07-01", "web", "EU", "EUR", "1e30", "0", None, "1"),
            ("o3", "C", "2026-07-01", "web", "EU", "EUR", "10.005", "0.004", None, "99999999999999999999"),
            ("o4", "C", "2026-07-01", "web", "EU", "EUR", "10.005", "0.004", None, "-1.9")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    good = {r.order_id: (r.net_revenue_eur, r.units) for r in C.clean_orders(df).collect()}
    assert good == {"o1": (Decimal("12345678901.00"), 3000000000), "o4": (Decimal("10.00"), -1)}
    bad = {r.row_key: r.reason for r in C.rejected_rows({"orders": df}).collect()}
    assert bad == {"o2": "net_revenue_eur", "o3": "units"}
