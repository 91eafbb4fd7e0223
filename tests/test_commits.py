"""Versioned tables, commits of several tables, keyed writes, attempt numbers, one-pass landing."""

import datetime as dt
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest

from tidewater.plans.pipeline import ledger_view, run_pipeline
from tidewater.schemas import SOURCE_COLUMNS
from tidewater.sinks import commits as CM
from tidewater.sinks import warehouse as W

from test_io_pipeline import _seed, _write_csv

KV = "k string, v int, run_id string"


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidewater-test-", dir="/tmp")


def _files(root):
    return {os.path.join(d, f): (os.stat(os.path.join(d, f)).st_mtime_ns, os.stat(os.path.join(d, f)).st_ino)
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def _put(spark, root, rows, run, **how):
    w = CM.RunWrites(spark, root, run)
    n = w.upsert("t", spark.createDataFrame([(*r, run) for r in rows], KV), ["k"], n_buckets=8, **how)
    w.publish()
    return n


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_leaves_other_buckets_alone(spark, scratch):
    assert _put(spark, scratch, [(f"k{i}", i) for i in range(100)], "a") == 100
    before = _files(scratch)
    assert _put(spark, scratch, [("k7", 700), ("k8", 8), ("new", 1)], "b") == 2  # k8 says what it said
    after = _files(scratch)
    assert all(after[f] == stamp for f, stamp in before.items())  # nothing is overwritten
    entry = CM.read_commit(spark, scratch)["tables"]["t"]
    old = CM.read_commit(spark, scratch, 1)["tables"]["t"]
    touched = {r.b for r in spark.createDataFrame([("k7",), ("new",)], "k string").select(CM.bucket_of(["k"], 8).alias("b")).collect()}
    assert {int(b) for b, v in entry["buckets"].items() if old["buckets"][b] != v} == touched and len(touched) < 8
    assert entry["rows"] == 101
    want = [(f"k{i}", 700 if i == 7 else i, "b" if i == 7 else "a") for i in range(100)] + [("new", 1, "b")]
    assert _rows(CM.read_table(spark, scratch, "t")) == sorted(want)
    assert CM.read_table(spark, scratch, "t", 1).count() == 100  # the earlier state is still there
    assert _put(spark, scratch, [("k9", 9)], "c") == 0 and CM.read_commit(spark, scratch)["number"] == 3
    assert CM.expire(spark, scratch, keep=2) == []
    assert _rows(CM.read_table(spark, scratch, "t")) == sorted(want)


def test_expired_versions(spark, scratch):
    for k in range(3):
        w = CM.RunWrites(spark, scratch, f"r{k}")
        w.replace("p", spark.range(k + 1).toDF("id"))
        w.publish()
    lost = CM.RunWrites(spark, scratch, "failed")
    lost.replace("p", spark.range(9).toDF("id"))  # never published
    assert len(CM.expire(spark, scratch, keep=1)) == 2
    assert CM.read_table(spark, scratch, "p").count() == 3 and lost.read("p").count() == 9


def test_upsert_keys(spark, scratch):
    rows = [("a", 1), ("b", 2), (None, 3)]
    _put(spark, scratch, rows, "a")
    assert _put(spark, scratch, [(None, 30), ("b", 2)], "b") == 1  # null is a key like others
    assert _rows(CM.read_table(spark, scratch, "t").where("k IS NULL")) == [(None, 30, "b")]
    w = CM.RunWrites(spark, scratch, "c")
    twice = spark.createDataFrame([("a", 5, "c", 1), ("a", 6, "c", 2)], KV + ", at int")
    assert w.upsert("t", twice, ["k"], order="at") == 1 and w.read("t").where("k = 'a'").first().v == 6
    with pytest.raises(Exception, match="incoming key repeated"):
        w.upsert("t", twice.drop("at"), ["k"])
    with pytest.raises(ValueError):
        w.upsert("t", twice, ["v"])
    assert CM.read_table(spark, scratch, "t").where("k = 'a'").first().v == 1  # not published
    with pytest.raises(LookupError):
        CM.read_table(spark, scratch, "none")


def test_full_buckets_are_dealt_anew(spark, scratch, monkeypatch):
    _put(spark, scratch, [(f"k{i}", i) for i in range(40)], "a")
    monkeypatch.setattr(CM, "BUCKET_ROWS", 4)
    _put(spark, scratch, [("k0", 5)], "b")
    entry = CM.read_commit(spark, scratch)["tables"]["t"]
    assert entry["n_buckets"] == 16 and entry["rows"] == 40 and CM.read_table(spark, scratch, "t").count() == 40


def test_rows_of_a_run_are_found_by_folders(spark, scratch):
    _put(spark, scratch, [(f"k{i}", i) for i in range(30)], "2026-08-01")
    _put(spark, scratch, [("k1", 100)], "2026-08-02")
    from tidewater.operators.delivery import for_run
    one = for_run(CM.read_table(spark, scratch, "t"), "2026-08-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "run_id" in filters and "2026-08-02" in filters
    assert _rows(one) == [("k1", 100, "2026-08-02")] and one.schema["run_id"].dataType.simpleString() == "string"


def test_two_runs_at_once(spark, scratch):
    first, second = CM.RunWrites(spark, scratch, "a"), CM.RunWrites(spark, scratch, "b")
    first.replace("x", spark.range(1).toDF("id"))
    second.replace("y", spark.range(2).toDF("id"))
    assert (first.publish(), second.publish()) == (1, 2)  # different tables: both hold
    assert CM.read_table(spark, scratch, "x").count() == 1 and CM.read_table(spark, scratch, "y").count() == 2
    third, fourth = CM.RunWrites(spark, scratch, "c"), CM.RunWrites(spark, scratch, "d")
    for w in (third, fourth):
        w.replace("x", spark.range(5).toDF("id"))
    third.publish()
    with pytest.raises(CM.CommitConflict):
        fourth.publish()
    assert [h["run_id"] for h in CM.history(spark, scratch)] == ["a", "b", "c"]


def test_attempt_numbers_are_claimed_once(spark, scratch):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: CM.claim_attempt(spark, scratch, "run/1"), range(24)))
    assert sorted(got) == list(range(1, 25))
    assert CM.claim_attempt(spark, scratch, "other", after=4) == 5
    assert CM.create_exclusive(spark, f"{scratch}/f", "one") and not CM.create_exclusive(spark, f"{scratch}/f", "two")
    assert CM._read_text(spark, f"{scratch}/f") == "one"


def test_a_failing_run_leaves_every_table(spark, scratch):
    src = tempfile.mkdtemp(prefix="tidewater-src-", dir="/tmp")
    _seed(src)
    now = dt.datetime(2026, 8, 2)
    run_pipeline(spark, src, scratch, "good", now=now)
    state = CM.read_commit(spark, scratch)
    _write_csv(src, "orders", [["o9", "C-1", "2026-07-01", "web", "EU", "EUR", "1.00", "0.00", "1.00", "2"]])

    def third_mart(stage):
        if stage == "revenue_anomalies":
            raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        run_pipeline(spark, src, scratch, "bad", now=now, on_stage=third_mart)
    assert CM.read_commit(spark, scratch) == state
    for t in state["tables"]:
        if t.startswith("mart/") and "run_id" in CM.read_table(spark, scratch, t).columns:
            assert {r.run_id for r in CM.read_table(spark, scratch, t).select("run_id").distinct().collect()} <= {"good"}
    assert CM.read_table(spark, scratch, "raw/orders").count() == 2

    def other_run(stage):  # two attempts that overlap: each has its number, the later commit wins or fails
        if stage == "publish":
            run_pipeline(spark, src, scratch, "twice", now=now)

    with pytest.raises(CM.CommitConflict):
        run_pipeline(spark, src, scratch, "twice", now=now, on_stage=other_run)
    log = spark.read.parquet(f"{scratch}/mart/pipeline_runs_log").where("run_id = 'twice'")
    assert sorted((r.attempt, r.status) for r in log.collect()) == [(1, "failed"), (1, "running"), (2, "running"), (2, "success")]
    assert {r.run_id: r.status for r in ledger_view(spark, scratch).collect()}["twice"] == "success"
    assert CM.read_commit(spark, scratch)["attempt"] == 2 and CM.read_table(spark, scratch, "raw/orders").count() == 1


def test_late_ticket_changes_one_bucket(spark, scratch):
    src = tempfile.mkdtemp(prefix="tidewater-src-", dir="/tmp")
    _seed(src)
    now = dt.datetime(2026, 8, 2)
    run_pipeline(spark, src, scratch, "a", now=now, marts="upsert")
    _write_csv(src, "support_tickets", [
        ["t1", "C-1", "2026-07-01T10:00:00", "email", "en", "Refund request", "I was charged twice", "open", "true"],
        ["t3", "C-3", "2026-07-02T10:00:00", "email", "en", "Login", "App crashes on login", "open", ""]])
    res = run_pipeline(spark, src, scratch, "b", now=now, marts="upsert")
    assert res.rows_enriched["ticket_classifications"] == 1 and res.rows_enriched["lead_enrichments"] == 0
    got = {r.ticket_id: r.run_id for r in CM.read_table(spark, scratch, "mart/ticket_classifications").collect()}
    assert got == {"t1": "a", "t2": "a", "t3": "b"}


def test_landing_counts_add_up(spark, scratch):
    src = tempfile.mkdtemp(prefix="tidewater-src-", dir="/tmp")
    _seed(src)
    with open(f"{src}/orders.csv", "a") as fh:
        fh.write("too,few\n")
    wide = [["2026-07-01", "/", "FR", "desktop", "10", "", "1e12", "100.25"], ["2026-07-01", "/a", "FR", "desktop", "10", "", "30.5", "-1e12"],
            ["2026-07-01", "/b", "FR", "desktop", "10", "", "none", ""]]
    _write_csv(src, "web_analytics", wide)
    _write_csv(src, "crm_leads", [["LD-1", "Acme", "SaaS", "FR", "2026-07-01T00", "referral", "won", "1e30", "Note"],
                                  ["LD-2", "Acme", "SaaS", "FR", "2026-07-01T00", "referral", "won", "n/k", "Note"]])
    res = run_pipeline(spark, src, scratch, "r", now=dt.datetime(2026, 8, 2))
    rejects = {(r.table, r.row_key, r.reason, r.row if "few" in r.row else None) for r in CM.read_table(spark, scratch, "raw/rejected_rows").collect()}
    assert rejects == {("orders", "o2", "net_revenue_eur", None), ("product_reviews", "r2", "rating", None), ("orders", "too", "fields do not match the header", "too,few"),
                       ("web_analytics", "2026-07-01|/|FR|desktop", "bounce_rate", None), ("web_analytics", "2026-07-01|/a|FR|desktop", "avg_session_sec", None),
                       ("crm_leads", "LD-1", "est_value_eur", None)}
    assert res.rows_unreadable == 1 and res.rows_rejected == 6
    assert res.rows_extracted == sum(res.rows_loaded.values()) + 5
    web = CM.read_table(spark, scratch, "raw/web_analytics").collect()
    assert [(r.page_path, r.bounce_rate, r.avg_session_sec) for r in web] == [("/b", None, None)]


def test_operators_reject_what_does_not_fit(spark):
    from tidewater.operators import clean as C
    cols = SOURCE_COLUMNS["crm_leads"]
    rows = [("a", "n", "i", "r", "2026-07-01T00", "s", "won", v, "x") for v in ("12.345", None, "inf", "NaN", "1e25")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    assert sorted(str(r.est_value_eur) for r in C.clean_leads(df).collect()) == ["12.35", "None", "None"]
    assert [r.reason for r in C.rejected_rows({"crm_leads": df}).collect()] == ["est_value_eur"] * 2
    top = spark.createDataFrame([(Decimal("9" * 22), "GBP")], "gross_revenue_eur decimal(24,2), currency string").selectExpr(
        "*", "gross_revenue_eur AS discount_eur", "gross_revenue_eur AS net_revenue_eur")
    assert C.to_eur(top, {"GBP": "1.2000"}).first().net_revenue_eur is None  # too large: null, not a failed job


def test_staging_needs_a_shared_folder():
    from types import SimpleNamespace

    from tidewater import staging
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        staging.shared_folder(cluster, "x")
