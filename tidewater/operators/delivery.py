"""Dashboard, report and message queries.

Each is a small aggregate or top-k over the mart tables; Catalyst prunes
the scans to the columns used, aggregates run partial+final on executors,
and ``orderBy().limit()`` plans as ``TakeOrderedAndProject``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NO_CATEGORY_LINE = "No tickets classified in this run."
NO_ANOMALY_LINE = "No significant revenue anomalies detected."


def dashboard_kpis(orders: DataFrame, tickets: DataFrame, leads: DataFrame) -> DataFrame:
    """P1 (A7 + A8): total revenue, orders, tickets, leads as one row.

    The three inputs are tagged and unioned, then one global aggregate (partial
    sums on every partition) produces the row: one pass, no join.
    """
    money = "decimal(30,2)"
    parts = orders.select(F.col("net_revenue_eur").cast(money).alias("rev"),
                          F.lit(1).alias("o"), F.lit(0).alias("t"), F.lit(0).alias("ld"))
    parts = parts.unionByName(tickets.select(F.lit(None).cast(money).alias("rev"),
                                             F.lit(0).alias("o"), F.lit(1).alias("t"),
                                             F.lit(0).alias("ld")))
    parts = parts.unionByName(leads.select(F.lit(None).cast(money).alias("rev"),
                                           F.lit(0).alias("o"), F.lit(0).alias("t"),
                                           F.lit(1).alias("ld")))
    return parts.agg(
        F.coalesce(F.sum("rev"), F.lit(0)).cast(money).alias("total_revenue"),
        F.coalesce(F.sum("o"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("total_tickets"),
        F.coalesce(F.sum("ld"), F.lit(0)).cast("long").alias("total_leads"))


def tickets_by_category(classified: DataFrame) -> DataFrame:
    """A10: tickets per category and their share of all tickets."""
    counts = classified.groupBy("category").agg(F.count(F.lit(1)).alias("n_tickets"))
    total = F.sum("n_tickets").over(Window.partitionBy())  # over <= 6 aggregated rows
    return counts.select("category", "n_tickets",
                         (F.col("n_tickets").cast("double") / total.cast("double")).alias("share"))


def sentiment_by_urgency(classified: DataFrame) -> DataFrame:
    """Grouped counts behind the sentiment x urgency histogram."""
    return classified.groupBy("sentiment", "urgency").agg(F.count(F.lit(1)).alias("n_tickets"))


def for_run(df: DataFrame, run_id: str) -> DataFrame:
    """C11: rows of one run (of a keyed warehouse table, a partition filter: other runs' folders
    aren't read)."""
    return df.filter(F.col("run_id") == F.lit(run_id))


def report_top_categories(classified: DataFrame, run_id: str | None = None,
                          k: int = 3) -> DataFrame:
    """L1: the k most frequent categories of a run (ties by name)."""
    df = for_run(classified, run_id) if run_id is not None else classified
    counts = df.groupBy("category").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("category")).limit(k)


def report_top_anomalies(anomalies: DataFrame, run_id: str | None = None, k: int = 3,
                         by: str = "signed") -> DataFrame:
    """L2: the k anomalies with the largest deviation. ``by='signed'`` keeps the
    original order (drops rank last); ``by='abs'`` ranks by magnitude."""
    df = for_run(anomalies, run_id) if run_id is not None else anomalies
    key = F.col("deviation") if by == "signed" else F.abs(F.col("deviation"))
    return (df.select("anomaly_id", "dimension", "dimension_value", "severity", "deviation")
            .orderBy(key.desc(), F.asc("anomaly_id")).limit(k))


def anomaly_cards(anomalies: DataFrame) -> DataFrame:
    """One card per anomaly: icon by severity, headline and detail line."""
    icon = F.when(F.col("severity") == "critical", F.lit("🚨")).otherwise(F.lit("⚠️"))
    return anomalies.select(
        "anomaly_id",
        F.concat_ws(" ", icon, F.col("detected_date").cast("string")).alias("headline"),
        F.concat(F.col("dimension"), F.lit(": "), F.col("dimension_value")).alias("subject"),
        F.format_string("%s in %s | Exp: %s | Act: %s", F.initcap("direction"), F.col("metric"),
                        F.col("expected_value").cast("string"),
                        F.col("observed_value").cast("string")).alias("detail"))


def recent_runs(ledger: DataFrame, limit: int = 5) -> DataFrame:
    """L3 + P6: latest runs with a status marker and formatted start time."""
    marker = (F.when(F.col("status") == "success", F.lit("🟢"))
              .when(F.col("status") == "failed", F.lit("🔴")).otherwise(F.lit("🟡")))
    top = ledger.orderBy(F.desc("started_at"), F.asc("run_id")).limit(limit)
    return top.select(
        "run_id", "started_at", "finished_at", "status", "enrichment_mode", "rows_extracted",
        "rows_enriched", "report_path", "error",
        F.format_string("%s Run: %s (%s)", marker,
                        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss 'UTC'"),
                        F.upper("status")).alias("title"))


def run_report(run: DataFrame, classified: DataFrame, anomalies: DataFrame,
               k: int = 3) -> DataFrame:
    """Report lines ``(run_id, section, rank, line)`` for every run in ``run``.

    Category lines ``category: count``; anomaly lines
    ``SEVERITY anomaly in dim (value): x.x std dev``; a fixed line when a run
    has none. Rows of runs that are not in ``run`` are left out. The sections of
    each run are joined to the ranked lines (top-k windows with a group limit), once.
    """
    runs = run.select("run_id").distinct()
    cat = classified.groupBy("run_id", "category").agg(F.count(F.lit(1)).alias("n"))
    wc = Window.partitionBy("run_id").orderBy(F.desc("n"), F.asc("category"))
    cat = (cat.withColumn("rank", F.row_number().over(wc)).filter(F.col("rank") <= k)
           .select("run_id", F.lit("categories").alias("section"), "rank",
                   F.concat(F.col("category"), F.lit(": "), F.col("n").cast("string"))
                   .alias("line")))
    wa = Window.partitionBy("run_id").orderBy(F.desc("deviation"), F.asc("anomaly_id"))
    an = (anomalies.withColumn("rank", F.row_number().over(wa)).filter(F.col("rank") <= k)
          .select("run_id", F.lit("anomalies").alias("section"), "rank",
                  anomaly_line().alias("line")))
    sections = runs.select("run_id", F.inline(F.array(
        F.struct(F.lit("categories").alias("section"), F.lit(NO_CATEGORY_LINE).alias("empty_line")),
        F.struct(F.lit("anomalies").alias("section"), F.lit(NO_ANOMALY_LINE).alias("empty_line")))))
    return sections.join(cat.unionByName(an), ["run_id", "section"], "left").select(
        "run_id", "section", F.coalesce("rank", F.lit(1)).alias("rank"), F.coalesce("line", "empty_line").alias("line"))


def anomaly_line():
    """``SEVERITY anomaly in dim (value): x.x std dev``; the deviation is
    rounded half-to-even on its decimal value, as decimal text formatting does."""
    return F.concat(F.upper("severity"), F.lit(" anomaly in "), F.col("dimension"), F.lit(" ("),
                    F.col("dimension_value"), F.lit("): "),
                    F.bround(F.col("deviation").cast("decimal(10,3)"), 1).cast("string"),
                    F.lit(" std dev"))


def run_message(ledger_view: DataFrame) -> DataFrame:
    """Notification text per run from the ledger view."""
    ok = F.format_string("Pipeline run %s completed successfully. Enriched %s rows.",
                         F.col("run_id"), F.coalesce(F.col("rows_enriched"), F.lit(0))
                         .cast("string"))
    bad = F.format_string("Pipeline run %s failed. Please check Airflow logs.", F.col("run_id"))
    return ledger_view.select("run_id", "status",
                              F.when(F.col("status") == "success", ok).otherwise(bad)
                              .alias("message"))


def dashboard(spark, out_dir: str, lang: str = "en") -> dict[str, DataFrame]:
    """S7 + P1-P5: every dataset behind the dashboard page, read from the
    warehouse's latest commit. Scans are pruned to the columns each view uses."""
    from tidewater.operators.clean import leads_view
    from tidewater.operators.revenue import daily_revenue_by_region
    from tidewater.sinks.commits import read_commit, read_table

    number = read_commit(spark, out_dir)["number"]  # all tables of one commit
    orders, tickets, anomalies, leads = (read_table(spark, out_dir, t, number) for t in (
        "raw/orders", "mart/ticket_classifications", "mart/revenue_anomalies", "mart/lead_enrichments"))
    return {
        "kpis": dashboard_kpis(orders, tickets, leads),
        "revenue_by_region": daily_revenue_by_region(orders),
        "anomaly_cards": anomaly_cards(anomalies),
        "tickets_by_category": tickets_by_category(tickets),
        "sentiment_by_urgency": sentiment_by_urgency(tickets),
        "leads": leads_view(leads, lang),
    }
