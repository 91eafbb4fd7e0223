"""Fixed table schemas: source (all strings), clean/raw, mart."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

SOURCE_COLUMNS: dict[str, list[str]] = {
    "orders": ["order_id", "customer_id", "order_date", "channel", "region", "currency",
               "gross_revenue_eur", "discount_eur", "net_revenue_eur", "units"],
    "support_tickets": ["ticket_id", "customer_id", "created_at", "channel", "language",
                        "subject", "description", "status", "sla_breached"],
    "product_reviews": ["review_id", "product_id", "product_name", "created_at", "rating",
                        "language", "title", "body", "verified"],
    "web_analytics": ["event_date", "page_path", "country", "device", "sessions", "pageviews",
                      "bounce_rate", "avg_session_sec"],
    "crm_leads": ["lead_id", "company_name", "industry", "region", "created_at", "source",
                  "status", "est_value_eur", "notes"],
}


def _s(name: str, dtype, nullable: bool = True) -> StructField:
    return StructField(name, dtype, nullable)


S, TS, D = StringType(), TimestampType(), DateType()
TSN = TimestampNTZType()
MONEY = DecimalType(24, 2)

def _table(required: list[tuple[str, object]], optional: list[tuple[str, object]] = (), *, stamp: str | None = "loaded_at") -> StructType:
    """Required columns, optional ones and the load stamp, in declaration order."""
    return StructType([*(_s(n, t, False) for n, t in required), *(_s(n, t) for n, t in optional),
                       *([_s(stamp, TS, False)] if stamp else [])])


# raw.* tables (clean form without the helper ``text`` column, plus loaded_at). The money and
# count types are wider than the original's, so that sums at scale fit.
RAW_SCHEMAS: dict[str, StructType] = {
    "orders": _table([
        ("order_id", S), ("customer_id", S), ("order_date", D), ("channel", S), ("region", S), ("currency", S),
        ("gross_revenue_eur", MONEY), ("discount_eur", MONEY), ("net_revenue_eur", MONEY), ("units", LongType())]),
    "support_tickets": _table([
        ("ticket_id", S), ("customer_id", S), ("created_at", TSN), ("channel", S), ("language", S), ("subject", S),
        ("description", S), ("status", S), ("sla_breached", BooleanType())]),
    "product_reviews": _table([
        ("review_id", S), ("product_id", S), ("product_name", S), ("created_at", TSN), ("rating", IntegerType()),
        ("language", S), ("title", S), ("body", S), ("verified", BooleanType())]),
    "web_analytics": _table([
        ("event_date", D), ("page_path", S), ("country", S), ("device", S), ("sessions", LongType()),
        ("pageviews", LongType()), ("bounce_rate", DecimalType(10, 2)), ("avg_session_sec", DecimalType(10, 2))]),
    "crm_leads": _table([
        ("lead_id", S), ("company_name", S), ("industry", S), ("region", S), ("created_at", TSN), ("source", S),
        ("status", S)], [("est_value_eur", MONEY), ("notes", S)]),
}

THEME_STRUCT = StructType([_s("theme", S), _s("weight", LongType())])

MART_SCHEMAS: dict[str, StructType] = {
    "ticket_classifications": StructType([
        _s("ticket_id", S, False), _s("category", S, False), _s("sentiment", S, False),
        _s("urgency", S, False), _s("confidence", DecimalType(4, 3), False),
        _s("detected_language", S, False), _s("enriched_at", TS, False), _s("run_id", S)]),
    "review_summaries": StructType([
        _s("product_id", S, False), _s("review_window", S, False),
        _s("n_reviews", LongType(), False), _s("avg_rating", DecimalType(3, 2), False),
        _s("summary_en", S, False), _s("summary_fr", S, False),
        _s("top_themes", ArrayType(THEME_STRUCT), False), _s("enriched_at", TS, False),
        _s("run_id", S)]),
    "revenue_anomalies": StructType([
        _s("anomaly_id", S, False), _s("detected_date", D, False), _s("dimension", S, False),
        _s("dimension_value", S, False), _s("metric", S, False),
        _s("observed_value", DecimalType(30, 2), False),
        _s("expected_value", DecimalType(30, 2), False),
        _s("deviation", DecimalType(10, 3), False), _s("direction", S, False),
        _s("severity", S, False), _s("enriched_at", TS, False), _s("run_id", S)]),
    "lead_enrichments": StructType([
        _s("lead_id", S, False), _s("company_size_band", S, False),
        _s("lead_score", ShortType(), False), _s("intent_signals", ArrayType(S), False),
        _s("notes_en", S), _s("notes_fr", S), _s("enriched_at", TS, False), _s("run_id", S)]),
    "pipeline_runs": StructType([
        _s("run_id", S, False), _s("attempt", IntegerType(), False), _s("seq", IntegerType(), False),
        _s("started_at", TS, False), _s("finished_at", TS), _s("status", S, False), _s("enrichment_mode", S, False),
        _s("llm_provider", S), _s("llm_model", S), _s("llm_calls", IntegerType(), False),
        _s("llm_cost_estimate", DecimalType(18, 4), False), _s("rows_extracted", LongType(), False),
        _s("rows_loaded", LongType()), _s("rows_enriched", LongType(), False), _s("report_path", S),
        _s("slack_sent", BooleanType(), False), _s("error", S)]),
}

MART_KEYS: dict[str, list[str]] = {
    "ticket_classifications": ["ticket_id"],
    "review_summaries": ["product_id", "review_window"],
    "revenue_anomalies": ["anomaly_id"],
    "lead_enrichments": ["lead_id"],
    "pipeline_runs": ["run_id"],
}
RAW_KEYS: dict[str, list[str]] = {
    "orders": ["order_id"],
    "support_tickets": ["ticket_id"],
    "product_reviews": ["review_id"],
    "web_analytics": ["event_date", "page_path", "country", "device"],
    "crm_leads": ["lead_id"],
}

TABLE_KEYS: dict[str, list[str]] = {**RAW_KEYS, **MART_KEYS}
TABLE_SCHEMAS: dict[str, StructType] = {**RAW_SCHEMAS, **MART_SCHEMAS}

# Values of columns a writer leaves out (besides the load stamp).
DEFAULTS: dict[str, dict[str, object]] = {
    "orders": {"currency": "EUR", "discount_eur": 0},
    "support_tickets": {"sla_breached": False},
    "product_reviews": {"verified": False},
    "pipeline_runs": {"llm_calls": 0, "llm_cost_estimate": 0, "rows_extracted": 0, "rows_enriched": 0, "slack_sent": False},
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("ticket_classifications", "ticket_id", "support_tickets", "ticket_id"),
    ("lead_enrichments", "lead_id", "crm_leads", "lead_id"),
    *((t, "run_id", "pipeline_runs", "run_id")
      for t in ("ticket_classifications", "review_summaries", "revenue_anomalies", "lead_enrichments")),
]

# table -> column -> (least, greatest)
RANGES: dict[str, dict[str, tuple[int, int]]] = {"product_reviews": {"rating": (1, 5)}}


def required_columns(table: str) -> list[str]:
    """NOT NULL columns without the load stamp and the ledger's own event numbers."""
    return [f.name for f in TABLE_SCHEMAS[table].fields
            if not f.nullable and f.name not in ("loaded_at", "enriched_at", "attempt", "seq")]
