"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus oracle SQL.

Every query reads the driver's tables through the adapters, so its work
grows with them; nothing runs on a fixed in-memory input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators import clean as C
from tidewater.operators import revenue as R
from tidewater.plans import oracle as O
from tidewater.sources.adapters import SOURCE_ADAPTERS
from tidewater.sources.files import normalize_nulls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Business source in CSV form (strings, null tokens normalised)."""
    return normalize_nulls(SOURCE_ADAPTERS[name](spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return C.CLEANERS[name](source(spark, sf_dir, name))


# ── cleaning ────────────────────────────────────────────────────────────────
@register("clean_orders", O.build("SELECT * FROM orders_clean", ["orders_clean"]))
def q_clean_orders(spark, sf_dir):
    return cleaned(spark, sf_dir, "orders")


@register("clean_tickets", O.build("SELECT * FROM tickets_clean", ["tickets_clean"]))
def q_clean_tickets(spark, sf_dir):
    return cleaned(spark, sf_dir, "support_tickets")


@register("clean_reviews", O.build(
    "SELECT review_id, product_id, product_name, created_at, rating, language, title, "
    "verified, length(body) AS body_chars, md5(body) AS body_md5, md5(text) AS text_md5 "
    "FROM reviews_clean", ["reviews_clean"]))
def q_clean_reviews(spark, sf_dir):
    from pyspark.sql import functions as F
    df = cleaned(spark, sf_dir, "product_reviews")
    return df.select("review_id", "product_id", "product_name", "created_at", "rating",
                     "language", "title", "verified",
                     F.length("body").cast("long").alias("body_chars"),
                     F.md5("body").alias("body_md5"), F.md5("text").alias("text_md5"))


@register("clean_web", O.build("SELECT * FROM web_clean", ["web_clean"]))
def q_clean_web(spark, sf_dir):
    return cleaned(spark, sf_dir, "web_analytics")


@register("clean_leads", O.build("SELECT * FROM leads_clean", ["leads_clean"]))
def q_clean_leads(spark, sf_dir):
    return cleaned(spark, sf_dir, "crm_leads")


@register("to_eur", O.build("""SELECT order_id, customer_id, order_date, channel, region, currency,
  CAST(ROUND(gross_revenue_eur * r, 2) AS DECIMAL(24,2)) AS gross_revenue_eur,
  CAST(ROUND(discount_eur * r, 2) AS DECIMAL(24,2)) AS discount_eur,
  CAST(ROUND(net_revenue_eur * r, 2) AS DECIMAL(24,2)) AS net_revenue_eur, units
FROM (SELECT *, CASE currency WHEN 'EUR' THEN CAST(1.0 AS DECIMAL(10,4))
  WHEN 'USD' THEN CAST(0.92 AS DECIMAL(10,4)) WHEN 'GBP' THEN CAST(1.17 AS DECIMAL(10,4)) END AS r
  FROM orders_clean)""", ["orders_clean"]))
def q_to_eur(spark, sf_dir):
    return C.to_eur(cleaned(spark, sf_dir, "orders"))


# ── revenue ─────────────────────────────────────────────────────────────────
@register("daily_revenue_by_segment", O.build("SELECT * FROM segment", ["segment"]))
def q_segment(spark, sf_dir):
    return R.daily_revenue_by_segment(cleaned(spark, sf_dir, "orders"))


@register("daily_revenue_rollups", O.build("SELECT * FROM segment_rollups", ["segment_rollups"]))
def q_segment_rollups(spark, sf_dir):
    return R.daily_revenue_by_segment(cleaned(spark, sf_dir, "orders"), rollups=True)


@register("detect_anomalies", O.build("SELECT * FROM anomalies", ["anomalies"]))
def q_anomalies(spark, sf_dir):
    return R.detect_anomalies(R.daily_revenue_by_segment(cleaned(spark, sf_dir, "orders")))


@register("detect_anomalies_rollups", O.build(O.anomalies_sql("segment_rollups"),
                                              ["segment_rollups"]))
def q_anomalies_rollups(spark, sf_dir):
    seg = R.daily_revenue_by_segment(cleaned(spark, sf_dir, "orders"), rollups=True)
    return R.detect_anomalies(seg)


@register("daily_revenue_by_region", O.build(
    "SELECT order_date, region, CAST(COALESCE(SUM(net_revenue_eur), 0) AS DECIMAL(30,2)) "
    "AS net_revenue_eur FROM orders_clean GROUP BY order_date, region", ["orders_clean"]))
def q_rev_region(spark, sf_dir):
    return R.daily_revenue_by_region(cleaned(spark, sf_dir, "orders"))
