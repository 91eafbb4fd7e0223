"""Registers the text-enrichment, response, quality and delivery queries.

Importing this module fills ``tidewater.plans.registry.QUERIES``/``ORACLE``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.operators import delivery as D
from tidewater.operators import tickets as T
from tidewater.plans import oracle as O
from tidewater.plans.registry import cleaned, register
from tidewater.sources.tables import read_table
from tidewater.sinks import commits as CM
from tidewater.staging import shared_folder, staged, staged_all

q = O.q


# ── oracle fragments for tickets / language ─────────────────────────────────
def lang_sql(text: str) -> str:
    t = f"lower(COALESCE({text}, ''))"
    markers = ", ".join(q(m) for m in lx.FR_MARKERS)
    return (f"(CASE WHEN NOT regexp_matches({t}, '[{lx.TOKEN_LETTERS}]') THEN 'en' "
            f"WHEN regexp_matches({t}, '[{lx.ACCENT_LETTERS}]') THEN 'fr' "
            f"WHEN len(list_filter(regexp_extract_all({t}, '[{lx.TOKEN_LETTERS}]+'), "
            f"lambda x: x IN ({markers}))) >= {lx.FR_MARKER_MIN_HITS} THEN 'fr' "
            f"ELSE 'en' END)")


def _ticket_sig_sql() -> str:
    hits = [f"{O.weighted_hits_sql('t', kws)} AS h_{cat}"
            for cat, kws in lx.CATEGORY_KEYWORDS.items()]
    hits += [f"{O.weighted_hits_sql('t', lx.NEGATIVE_WORDS)} AS neg_hits",
             f"{O.weighted_hits_sql('t', lx.POSITIVE_WORDS)} AS pos_hits",
             f"{O.any_contains_sql('t', lx.URGENCY_CRITICAL)} AS is_critical",
             f"{O.any_contains_sql('t', lx.URGENCY_HIGH)} AS is_high"]
    cats = list(lx.CATEGORY_KEYWORDS)
    best = "GREATEST(" + ", ".join(f"h_{c}" for c in cats) + ")"
    cat_case = ("CASE WHEN best <= 0 THEN 'other' "
                + " ".join(f"WHEN h_{c} = best THEN {q(c)}" for c in cats) + " ELSE 'other' END")
    return f"""SELECT *, {cat_case} AS category,
  CASE WHEN is_critical THEN 'critical' WHEN is_high THEN 'high'
       WHEN sentiment = 'negative' THEN 'medium' ELSE 'low' END AS urgency,
  CAST(ROUND(LEAST(CAST(0.95 AS DECIMAL(4,2)), CAST(0.45 AS DECIMAL(4,2))
       + CAST(0.12 AS DECIMAL(4,2)) * best
       + CASE WHEN sentiment <> 'neutral' THEN CAST(0.05 AS DECIMAL(4,2))
              ELSE CAST(0 AS DECIMAL(4,2)) END), 3) AS DECIMAL(4,3)) AS confidence
FROM (
  SELECT *, {best} AS best,
    CASE WHEN neg_hits > pos_hits THEN 'negative' WHEN pos_hits > neg_hits THEN 'positive'
         ELSE 'neutral' END AS sentiment
  FROM (SELECT ticket_id, text, {', '.join(hits)}
        FROM (SELECT ticket_id, COALESCE(text, '') AS text, lower(COALESCE(text, '')) AS t
              FROM tickets_clean)))"""


O.cte("ticket_sig", _ticket_sig_sql(), ["tickets_clean"])
O.cte("ticket_cls", f"""SELECT ticket_id, category, sentiment, urgency, confidence,
  {lang_sql('text')} AS detected_language FROM ticket_sig""", ["ticket_sig"])


def _tickets(spark, sf_dir):
    return cleaned(spark, sf_dir, "support_tickets")


@register("ticket_category", O.build(
    "SELECT ticket_id, category, CAST(best AS INTEGER) AS best_hits FROM ticket_sig",
    ["ticket_sig"]))
def q_ticket_category(spark, sf_dir):
    return T.ticket_category(_tickets(spark, sf_dir))


@register("ticket_sentiment", O.build(
    "SELECT ticket_id, sentiment, CAST(neg_hits AS INTEGER) AS neg_hits, "
    "CAST(pos_hits AS INTEGER) AS pos_hits FROM ticket_sig", ["ticket_sig"]))
def q_ticket_sentiment(spark, sf_dir):
    return T.ticket_sentiment(_tickets(spark, sf_dir))


@register("ticket_urgency", O.build("SELECT ticket_id, urgency FROM ticket_sig", ["ticket_sig"]))
def q_ticket_urgency(spark, sf_dir):
    return T.ticket_urgency(_tickets(spark, sf_dir))


@register("classify_tickets", O.build("SELECT * FROM ticket_cls", ["ticket_cls"]))
def q_classify_tickets(spark, sf_dir):
    return T.classify_tickets(_tickets(spark, sf_dir))


@register("detect_language", f"""SELECT doc_id, lang,
  {lang_sql('text')} AS detected_language FROM documents""")
def q_detect_language(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return T.with_language(docs).select("doc_id", "lang", "detected_language")


@register("detect_language_conversations", f"""SELECT conv_id, turn, role,
  {lang_sql('text')} AS detected_language FROM conversations""")
def q_detect_language_conv(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return T.with_language(conv).select("conv_id", "turn", "role", "detected_language")


@register("tickets_by_category", O.build(
    "SELECT category, COUNT(*) AS n_tickets, "
    "CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share "
    "FROM ticket_cls GROUP BY category", ["ticket_cls"]))
def q_tickets_by_category(spark, sf_dir):
    return D.tickets_by_category(T.classify_tickets(_tickets(spark, sf_dir)))


@register("sentiment_by_urgency", O.build(
    "SELECT sentiment, urgency, COUNT(*) AS n_tickets FROM ticket_cls GROUP BY ALL",
    ["ticket_cls"]))
def q_sentiment_by_urgency(spark, sf_dir):
    return D.sentiment_by_urgency(T.classify_tickets(_tickets(spark, sf_dir)))


@register("report_top_categories", O.build(
    "SELECT category, COUNT(*) AS count FROM ticket_cls GROUP BY category "
    "ORDER BY count DESC, category LIMIT 3", ["ticket_cls"]))
def q_report_top_categories(spark, sf_dir):
    return D.report_top_categories(T.classify_tickets(_tickets(spark, sf_dir)))


_ = F  # keep the functions import for the sections below


# ── leads ───────────────────────────────────────────────────────────────────
from tidewater.operators import clean as C  # noqa: E402
from tidewater.operators import leads as L  # noqa: E402


def _points_sql(col: str, table: dict[str, int]) -> str:
    return "(CASE " + " ".join(f"WHEN {col} = {q(k)} THEN {v}" for k, v in table.items()) \
        + " ELSE 0 END)"


def size_number_sql(text: str) -> str:
    """First run of digits, whole; null if none or 0; at most the top of the top band."""
    digits = f"ltrim(regexp_extract({text}, '([0-9]+)', 1), '0')"
    return (f"CASE WHEN {digits} = '' THEN NULL WHEN length({digits}) > 9 THEN {lx.SIZE_BANDS[-1][1]} "
            f"ELSE CAST({digits} AS INTEGER) END")


def _leads_enriched_sql() -> str:
    t = "lower(COALESCE(notes, ''))"
    band = "CASE " + " ".join(
        f"WHEN n BETWEEN {lo} AND {hi} THEN {q(label)}" for lo, hi, label in L.size_band_labels()
    ) + f" ELSE {q(lx.SIZE_BAND_DEFAULT)} END"
    flags = []
    for label, words in lx.INTENT_SIGNALS:
        cond = (f"regexp_matches({t}, {q(O.unicode_boundaries(lx.TIMELINE_PATTERN))})"
                if words is None
                else O.any_contains_sql(t, words))
        flags.append(f"CASE WHEN {cond} THEN {q(label)} END")
    signals = f"list_filter([{', '.join(flags)}], lambda x: x IS NOT NULL)"
    en, fr = "COALESCE(notes, '')", "COALESCE(notes, '')"
    for src, dst in L.glossary("en"):
        en = f"replace({en}, {q(src)}, {q(dst)})"
    for src, dst in L.glossary("fr"):
        fr = f"replace({fr}, {q(src)}, {q(dst)})"
    score = (f"{lx.LEAD_SCORE_BASE} + {_points_sql('status', lx.STATUS_POINTS)} "
             f"+ {_points_sql('source', lx.SOURCE_POINTS)} "
             f"+ CASE WHEN est_value_eur IS NULL THEN 0 ELSE CAST(trunc(LEAST({lx.VALUE_POINTS_CAP}, "
             f"GREATEST(-1000000, est_value_eur / {lx.VALUE_POINTS_DIVISOR}))) AS INTEGER) END "
             f"+ CASE WHEN {O.any_contains_sql(t, lx.POSITIVE_SIGNAL_WORDS)} "
             f"THEN {lx.POSITIVE_SIGNAL_POINTS} ELSE 0 END "
             f"+ CASE WHEN {O.any_contains_sql(t, lx.OBJECTION_WORDS)} "
             f"THEN {lx.OBJECTION_POINTS} ELSE 0 END")
    return f"""SELECT lead_id, {band} AS company_size_band,
  CAST(GREATEST(0, LEAST(100, {score})) AS SMALLINT) AS lead_score,
  CASE WHEN len(sig) = 0 THEN ['{lx.NO_SIGNAL_LABEL}'] ELSE sig END AS intent_signals,
  notes_en, notes_fr
FROM (SELECT *, {signals} AS sig, {en} AS notes_en, {fr} AS notes_fr,
        {size_number_sql(t)} AS n
      FROM leads_clean)"""


O.cte("leads_enriched", _leads_enriched_sql(), ["leads_clean"])


def _leads(spark, sf_dir):
    return cleaned(spark, sf_dir, "crm_leads")


@register("company_size_band", O.build(
    "SELECT lead_id, company_size_band FROM leads_enriched", ["leads_enriched"]))
def q_company_size_band(spark, sf_dir):
    return _leads(spark, sf_dir).select(
        "lead_id", L.company_size_band("notes").alias("company_size_band"))


@register("lead_score", O.build("SELECT lead_id, lead_score FROM leads_enriched",
                                ["leads_enriched"]))
def q_lead_score(spark, sf_dir):
    df = _leads(spark, sf_dir)
    return df.select("lead_id", L.lead_score("status", "source", "est_value_eur", "notes")
                     .alias("lead_score"))


@register("intent_signals", O.build(
    "SELECT lead_id, array_to_string(intent_signals, '|') AS intent_signals FROM leads_enriched",
    ["leads_enriched"]))
def q_intent_signals(spark, sf_dir):
    return _leads(spark, sf_dir).select(
        "lead_id", F.array_join(L.intent_signals("notes"), "|").alias("intent_signals"))


@register("translate_note", O.build("SELECT lead_id, notes_en, notes_fr FROM leads_enriched",
                                    ["leads_enriched"]))
def q_translate_note(spark, sf_dir):
    df = _leads(spark, sf_dir)
    return df.select("lead_id", L.translate_note("notes", "en").alias("notes_en"),
                     L.translate_note("notes", "fr").alias("notes_fr"))


@register("enrich_leads", O.build(
    "SELECT lead_id, company_size_band, lead_score, "
    "array_to_string(intent_signals, '|') AS intent_signals, notes_en, notes_fr "
    "FROM leads_enriched", ["leads_enriched"]))
def q_enrich_leads(spark, sf_dir):
    out = L.enrich_leads(_leads(spark, sf_dir))
    return out.withColumn("intent_signals", F.array_join("intent_signals", "|"))


@register("leads_view", O.build(
    "SELECT lead_id, company_size_band, lead_score, notes_fr AS notes FROM leads_enriched",
    ["leads_enriched"]))
def q_leads_view(spark, sf_dir):
    return C.leads_view(L.enrich_leads(_leads(spark, sf_dir)), "fr")


# ── reviews ─────────────────────────────────────────────────────────────────
from tidewater.operators import reviews as RV  # noqa: E402

_FKEY = "strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') || '|' || review_id"
O.cte("rv", f"""SELECT product_id, strftime(created_at, '%Y-%m') AS review_window,
  CAST(rating AS DOUBLE) AS rating, language, COALESCE(body, '') AS body,
  lower(COALESCE(title, '') || ' ' || COALESCE(body, '')) AS t, {_FKEY} AS fkey
FROM reviews_clean WHERE created_at IS NOT NULL""", ["reviews_clean"])
O.cte("rv_stats", "SELECT product_id, review_window, COUNT(*) AS n_reviews, "
      "CAST(ROUND(AVG(rating), 2) AS DECIMAL(3,2)) AS avg_rating, "
      + ", ".join(f"SUM(CASE WHEN {O.any_contains_sql('t', kws)} THEN 1 ELSE 0 END) AS th_{i}"
                  for i, kws in enumerate(lx.THEME_KEYWORDS.values()))
      + " FROM rv GROUP BY product_id, review_window", ["rv"])
O.cte("rv_themes", "SELECT product_id, review_window, string_agg(theme || ':' || "
      "CAST(weight AS VARCHAR), '|' ORDER BY rn) AS top_themes FROM ("
      " SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id, review_window "
      "ORDER BY weight DESC, ord) AS rn FROM ("
      + " UNION ALL ".join(f"SELECT product_id, review_window, {q(th)} AS theme, {i} AS ord, "
                           f"CAST(th_{i} AS BIGINT) AS weight FROM rv_stats"
                           for i, th in enumerate(lx.THEME_KEYWORDS))
      + ") WHERE weight > 0) WHERE rn <= 5 GROUP BY product_id, review_window", ["rv_stats"])
O.cte("rv_ranked", """SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id, review_window, scope
                               ORDER BY cnt DESC, fkey) AS rank
  FROM (
    SELECT product_id, review_window, language AS scope, body, COUNT(*) AS cnt, MIN(fkey) AS fkey
    FROM rv WHERE language IN ('en', 'fr') GROUP BY ALL
    UNION ALL
    SELECT product_id, review_window, 'all', body, COUNT(*), MIN(fkey) FROM rv GROUP BY ALL))
WHERE rank <= 2""", ["rv"])
O.cte("rv_summary", """SELECT product_id, review_window,
  COALESCE(NULLIF(COALESCE(string_agg(body, ' ' ORDER BY rank) FILTER (WHERE scope = 'en'), ''), ''),
           string_agg(body, ' ' ORDER BY rank) FILTER (WHERE scope = 'all')) AS summary_en,
  COALESCE(NULLIF(COALESCE(string_agg(body, ' ' ORDER BY rank) FILTER (WHERE scope = 'fr'), ''), ''),
           string_agg(body, ' ' ORDER BY rank) FILTER (WHERE scope = 'all')) AS summary_fr
FROM rv_ranked GROUP BY product_id, review_window""", ["rv_ranked"])
O.cte("rv_out", """SELECT s.product_id, s.review_window, s.n_reviews, s.avg_rating,
  COALESCE(m.summary_en, '') AS summary_en, COALESCE(m.summary_fr, '') AS summary_fr,
  COALESCE(t.top_themes, '') AS top_themes
FROM rv_stats s
LEFT JOIN rv_summary m USING (product_id, review_window)
LEFT JOIN rv_themes t USING (product_id, review_window)""", ["rv_stats", "rv_summary", "rv_themes"])


def _review_rows(spark, sf_dir):
    return RV._review_rows(cleaned(spark, sf_dir, "product_reviews"))  # noqa: SLF001


@register("review_group_stats", O.build(
    "SELECT product_id, review_window, n_reviews, avg_rating FROM rv_stats", ["rv_stats"]))
def q_review_group_stats(spark, sf_dir):
    return RV.review_group_stats(_review_rows(spark, sf_dir)).select(
        "product_id", "review_window", "n_reviews", "avg_rating")


@register("top_themes", O.build(
    "SELECT product_id, review_window, COALESCE(top_themes, '') AS top_themes "
    "FROM rv_stats LEFT JOIN rv_themes USING (product_id, review_window)",
    ["rv_stats", "rv_themes"]))
def q_top_themes(spark, sf_dir):
    stats = RV.review_group_stats(_review_rows(spark, sf_dir))
    themes = RV.top_themes_from_counts([f"th_{i}" for i in range(len(RV.THEMES))])
    return stats.select("product_id", "review_window", RV.themes_flat(themes).alias("top_themes"))


@register("extractive_summary", O.build(
    "SELECT product_id, review_window, scope, CAST(rank AS INTEGER) AS rank, md5(body) AS body_md5, "
    "CAST(cnt AS BIGINT) AS cnt FROM rv_ranked", ["rv_ranked"]))
def q_extractive_summary(spark, sf_dir):
    ranked = RV.ranked_bodies(_review_rows(spark, sf_dir))
    return ranked.select("product_id", "review_window", "scope", "rank",
                         F.md5("body").alias("body_md5"), "cnt")


@register("summarize_reviews", O.build(
    "SELECT product_id, review_window, n_reviews, avg_rating, md5(summary_en) AS summary_en_md5, "
    "md5(summary_fr) AS summary_fr_md5, length(summary_en) AS summary_en_chars, top_themes "
    "FROM rv_out", ["rv_out"]))
def q_summarize_reviews(spark, sf_dir):
    out = RV.summarize_reviews(cleaned(spark, sf_dir, "product_reviews"))
    return out.select("product_id", "review_window", "n_reviews", "avg_rating",
                      F.md5("summary_en").alias("summary_en_md5"),
                      F.md5("summary_fr").alias("summary_fr_md5"),
                      F.length("summary_en").cast("long").alias("summary_en_chars"),
                      RV.themes_flat("top_themes").alias("top_themes"))


# ── data quality ────────────────────────────────────────────────────────────
from tidewater.operators import quality as QC  # noqa: E402
from tidewater.operators import revenue as R  # noqa: E402
from tidewater.plans.registry import source  # noqa: E402
from tidewater.sinks import warehouse as W  # noqa: E402
from tidewater.sources import adapters as AD  # noqa: E402
from tidewater.sources.files import source_row_counts  # noqa: E402

NN_ORDERS = ["order_id", "customer_id", "order_date", "channel", "region", "currency",
             "gross_revenue_eur", "discount_eur", "net_revenue_eur", "units"]


@register("check_primary_key", O.build(
    "SELECT 'support_tickets' AS \"table\", 'primary_key' AS \"constraint\", "
    "'ticket_id' AS columns, CAST(COUNT_IF(n > 1) AS BIGINT) AS violations "
    "FROM (SELECT ticket_id, COUNT(*) AS n FROM tickets_clean GROUP BY ticket_id)",
    ["tickets_clean"]))
def q_check_pk(spark, sf_dir):
    return QC.check_primary_key(cleaned(spark, sf_dir, "support_tickets"), "support_tickets",
                                ["ticket_id"])


@register("check_foreign_key", O.build(
    "SELECT 'lineitem' AS \"table\", 'foreign_key' AS \"constraint\", 'l_orderkey' AS columns, "
    "CAST(COALESCE(SUM(n), 0) AS BIGINT) AS violations FROM (SELECT l_orderkey, COUNT(*) AS n "
    "FROM lineitem GROUP BY l_orderkey) c WHERE NOT EXISTS "
    "(SELECT 1 FROM orders p WHERE p.o_orderkey = c.l_orderkey)", []))
def q_check_fk(spark, sf_dir):
    return QC.check_foreign_key(read_table(spark, sf_dir, "lineitem"),
                                read_table(spark, sf_dir, "orders"), "lineitem",
                                ["l_orderkey"], ["o_orderkey"])


@register("check_not_null", O.build(" UNION ALL ".join(
    f"SELECT 'orders_src' AS \"table\", 'not_null' AS \"constraint\", '{c}' AS columns, "
    f"CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS violations FROM orders_src" for c in NN_ORDERS),
    ["orders_src"]))
def q_check_not_null(spark, sf_dir):
    return QC.check_not_null(source(spark, sf_dir, "orders"), "orders_src", NN_ORDERS)


@register("check_range", "SELECT 'lineitem' AS \"table\", 'range[1,50]' AS \"constraint\", "
                         "'l_quantity' AS columns, CAST(COUNT_IF(l_quantity IS NOT NULL AND NOT "
                         "(l_quantity BETWEEN 1 AND 50)) AS BIGINT) AS violations FROM lineitem")
def q_check_range(spark, sf_dir):
    return QC.check_range(read_table(spark, sf_dir, "lineitem"), "lineitem", "l_quantity", 1, 50)


# ── sources, sinks, ledger ──────────────────────────────────────────────────
_SRC = {"orders": "orders_src", "support_tickets": "tickets_src",
        "product_reviews": "reviews_src", "web_analytics": "web_src", "crm_leads": "leads_src"}


@register("source_row_counts", O.build(
    "SELECT source, CAST(n_rows AS BIGINT) AS n_rows FROM ("
    + " UNION ALL ".join(f"SELECT '{k}' AS source, COUNT(*) AS n_rows FROM {v}"
                         for k, v in _SRC.items())
    + " UNION ALL SELECT 'total', (" + " + ".join(f"(SELECT COUNT(*) FROM {v})"
                                                  for v in _SRC.values()) + "))",
    list(_SRC.values())))
def q_source_row_counts(spark, sf_dir):
    return source_row_counts({k: source(spark, sf_dir, k) for k in _SRC})


@register("upsert_by_key", O.build("""SELECT * FROM orders_clean
WHERE order_id NOT IN (SELECT order_id FROM orders_clean WHERE currency <> 'EUR')
UNION ALL
SELECT order_id, customer_id, order_date, channel, region, currency,
  CAST(ROUND(gross_revenue_eur * r, 2) AS DECIMAL(26,6)), CAST(ROUND(discount_eur * r, 2) AS DECIMAL(26,6)),
  CAST(ROUND(net_revenue_eur * r, 2) AS DECIMAL(24,2)), units
FROM (SELECT *, CASE currency WHEN 'USD' THEN CAST(0.92 AS DECIMAL(10,4))
  WHEN 'GBP' THEN CAST(1.17 AS DECIMAL(10,4)) END AS r FROM orders_clean WHERE currency <> 'EUR')""",
    ["orders_clean"]))
def q_upsert_by_key(spark, sf_dir):
    current = staged(cleaned(spark, sf_dir, "orders"), "orders")
    corrections = C.to_eur(current.filter(F.col("currency") != "EUR"))
    return W.upsert_by_key(current, corrections.select(*[F.col(c).cast(current.schema[c].dataType) for c in current.columns]),
                           ["order_id"])


_REJECT_SQL = """SELECT 'orders' AS "table", COALESCE(order_id, '') AS row_key, reject_reason AS reason FROM orders_judged
WHERE reject_reason IS NOT NULL
UNION ALL SELECT 'product_reviews', COALESCE(review_id, ''), reject_reason FROM reviews_judged WHERE reject_reason IS NOT NULL
UNION ALL SELECT 'review_summaries', review_id, 'created_at' FROM reviews_judged
WHERE reject_reason IS NULL AND created_at IS NULL
UNION ALL SELECT 'web_analytics', concat_ws('|', CAST(event_date AS VARCHAR), page_path, country, device), reject_reason
FROM web_judged WHERE reject_reason IS NOT NULL"""


@register("rejected_rows", O.build(_REJECT_SQL, ["orders_judged", "reviews_judged", "web_judged"]))
def q_rejected_rows(spark, sf_dir):
    return C.rejected_rows({n: source(spark, sf_dir, n) for n in C.JUDGES}).drop("row")


O.cte("run_tasks", """SELECT run_id, task_id, n_events, first_ts, last_ts,
  CASE WHEN worst >= 300 THEN 'failed' ELSE 'success' END AS state
FROM (SELECT 'run-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, event_type AS task_id,
  MAX(CASE WHEN event_type = 'error' THEN value END) AS worst, COUNT(*) AS n_events,
  MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events GROUP BY ALL)""")
O.cte("run_view", """SELECT run_id,
  CASE WHEN CAST(right(run_id, 2) AS INTEGER) % 3 = 2 THEN 1 ELSE 2 END AS attempt, started_at, finished_at,
  CASE WHEN failed THEN 'failed' ELSE 'success' END AS status, 'mock' AS enrichment_mode,
  CAST(NULL AS VARCHAR) AS llm_provider, CAST(NULL AS VARCHAR) AS llm_model,
  CAST(0 AS INTEGER) AS llm_calls, CAST(0 AS DECIMAL(18,4)) AS llm_cost_estimate,
  CAST(rows_extracted AS BIGINT) AS rows_extracted, CAST(rows_extracted AS BIGINT) AS rows_loaded,
  CAST(rows_enriched AS BIGINT) AS rows_enriched,
  CASE WHEN NOT failed THEN 'reports/run_' || run_id || '.pdf' END AS report_path,
  NOT failed AS slack_sent, CASE WHEN failed THEN 'Upstream task failed' END AS error
FROM (SELECT run_id, MIN(first_ts) AS started_at, MAX(last_ts) AS finished_at,
  SUM(n_events) AS rows_extracted,
  SUM(CASE WHEN task_id <> 'error' THEN n_events ELSE 0 END) AS rows_enriched,
  bool_or(state = 'failed') AS failed FROM run_tasks GROUP BY run_id)""", ["run_tasks"])


def _ledger_view(spark, sf_dir):
    _, rows = AD.run_events_source(spark, sf_dir)
    return W.run_ledger(rows)


def _ntz(df, *cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@register("run_ledger", O.build("SELECT * FROM run_view", ["run_view"]))
def q_run_ledger(spark, sf_dir):
    return _ntz(_ledger_view(spark, sf_dir), "started_at", "finished_at")


@register("run_status", O.build(
    "SELECT run_id, CASE WHEN bool_or(state = 'failed') THEN 'failed' ELSE 'success' END "
    "AS status FROM run_tasks GROUP BY run_id", ["run_tasks"]))
def q_run_status(spark, sf_dir):
    tasks, _ = AD.run_events_source(spark, sf_dir)
    return W.run_status(tasks)


@register("run_message", O.build(
    "SELECT run_id, status, CASE WHEN status = 'success' THEN 'Pipeline run ' || run_id || "
    "' completed successfully. Enriched ' || CAST(COALESCE(rows_enriched, 0) AS VARCHAR) || "
    "' rows.' ELSE 'Pipeline run ' || run_id || ' failed. Please check Airflow logs.' END "
    "AS message FROM run_view", ["run_view"]))
def q_run_message(spark, sf_dir):
    return D.run_message(_ledger_view(spark, sf_dir))


@register("recent_runs", O.build(
    "SELECT run_id, started_at, finished_at, status, enrichment_mode, rows_extracted, "
    "rows_enriched, report_path, error, (CASE WHEN status = 'success' THEN '🟢' WHEN status = "
    "'failed' THEN '🔴' ELSE '🟡' END) || ' Run: ' || strftime(started_at, '%Y-%m-%d %H:%M:%S') "
    "|| ' UTC (' || upper(status) || ')' AS title FROM run_view "
    "ORDER BY started_at DESC, run_id LIMIT 5", ["run_view"]))
def q_recent_runs(spark, sf_dir):
    return _ntz(D.recent_runs(_ledger_view(spark, sf_dir)), "started_at", "finished_at")


# ── delivery ────────────────────────────────────────────────────────────────
@register("dashboard_kpis", O.build(
    "SELECT (SELECT CAST(COALESCE(SUM(net_revenue_eur), 0) AS DECIMAL(30,2)) FROM orders_clean) "
    "AS total_revenue, (SELECT COUNT(*) FROM orders_clean) AS total_orders, "
    "(SELECT COUNT(*) FROM ticket_cls) AS total_tickets, "
    "(SELECT COUNT(*) FROM leads_enriched) AS total_leads",
    ["orders_clean", "ticket_cls", "leads_enriched"]))
def q_dashboard_kpis(spark, sf_dir):
    return D.dashboard_kpis(cleaned(spark, sf_dir, "orders"),
                            T.classify_tickets(cleaned(spark, sf_dir, "support_tickets")),
                            L.enrich_leads(cleaned(spark, sf_dir, "crm_leads")))


def _anomalies(spark, sf_dir):
    return R.detect_anomalies(R.daily_revenue_by_segment(cleaned(spark, sf_dir, "orders")))


@register("anomaly_cards", O.build(
    "SELECT anomaly_id, (CASE WHEN severity = 'critical' THEN '🚨' ELSE '⚠️' END) || ' ' || "
    "CAST(detected_date AS VARCHAR) AS headline, dimension || ': ' || dimension_value AS subject, "
    "upper(left(direction, 1)) || lower(substr(direction, 2)) || ' in ' || metric || "
    "' | Exp: ' || CAST(expected_value AS VARCHAR) || ' | Act: ' || "
    "CAST(observed_value AS VARCHAR) AS detail FROM anomalies", ["anomalies"]))
def q_anomaly_cards(spark, sf_dir):
    return D.anomaly_cards(_anomalies(spark, sf_dir))


@register("report_top_anomalies", O.build(
    "SELECT anomaly_id, dimension, dimension_value, severity, deviation FROM anomalies "
    "ORDER BY deviation DESC, anomaly_id LIMIT 3", ["anomalies"]))
def q_report_top_anomalies(spark, sf_dir):
    return D.report_top_anomalies(_anomalies(spark, sf_dir))


_RUN_OF_TICKET = "'run-' || CAST(CAST(created_at AS DATE) AS VARCHAR)"
_RUN_OF_ANOMALY = "'run-' || CAST(detected_date AS VARCHAR)"
# Runs of the report: the ledger's, and one per even day of the month with orders. Anomalies of
# the other days belong to runs that don't exist.
O.cte("report_runs", """SELECT run_id FROM run_view UNION
SELECT DISTINCT 'run-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders WHERE day(o_orderdate) % 2 = 0""", ["run_view"])


@register("run_report", O.build(f"""SELECT f.run_id, f.section, COALESCE(l.rank, 1) AS rank, COALESCE(l.line, f.line) AS line
FROM (SELECT run_id, section, line FROM report_runs CROSS JOIN (VALUES
    ('categories', 'No tickets classified in this run.'),
    ('anomalies', 'No significant revenue anomalies detected.')) AS s(section, line)) f
LEFT JOIN (
  SELECT run_id, 'categories' AS section, CAST(rn AS INTEGER) AS rank,
    category || ': ' || CAST(n AS VARCHAR) AS line
  FROM (SELECT run_id, category, COUNT(*) AS n,
          ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY COUNT(*) DESC, category) AS rn
        FROM (SELECT {_RUN_OF_TICKET} AS run_id, c.category FROM ticket_cls c
              JOIN tickets_clean t USING (ticket_id))
        GROUP BY run_id, category) WHERE rn <= 3
  UNION ALL
  SELECT run_id, 'anomalies', CAST(rn AS INTEGER),
    upper(severity) || ' anomaly in ' || dimension || ' (' || dimension_value || '): '
    || CAST(round_even(deviation, 1) AS VARCHAR) || ' std dev'
  FROM (SELECT *, {_RUN_OF_ANOMALY} AS run_id, ROW_NUMBER() OVER (
          PARTITION BY {_RUN_OF_ANOMALY} ORDER BY deviation DESC, anomaly_id) AS rn
        FROM anomalies) WHERE rn <= 3) l
  ON l.run_id = f.run_id AND l.section = f.section""",
    ["ticket_cls", "tickets_clean", "anomalies", "report_runs"]))
def q_run_report(spark, sf_dir):
    tickets = cleaned(spark, sf_dir, "support_tickets").withColumn(
        "run_id", F.concat(F.lit("run-"), F.col("created_at").cast("date").cast("string")))
    classified = T.classify_tickets(tickets, keep=("run_id",))
    days = read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).where(F.day("d") % 2 == 0)
    runs = _ledger_view(spark, sf_dir).select("run_id").unionByName(days.select(F.concat(F.lit("run-"), F.col("d").cast("string")).alias("run_id")))
    return D.run_report(runs, classified, _anomalies_with_run(spark, sf_dir))


def _anomalies_with_run(spark, sf_dir):
    return _anomalies(spark, sf_dir).withColumn("run_id", F.concat(F.lit("run-"), F.col("detected_date").cast("string")))


# C11: the reports of one run, the first that has something to report.
_FIRST_TICKET_RUN = f"(SELECT MIN({_RUN_OF_TICKET}) FROM tickets_clean)"


@register("report_top_categories_run", O.build(
    "SELECT category, COUNT(*) AS count FROM ticket_cls c JOIN tickets_clean t USING (ticket_id) "
    f"WHERE {_RUN_OF_TICKET} = {_FIRST_TICKET_RUN} GROUP BY category ORDER BY count DESC, category LIMIT 3",
    ["ticket_cls", "tickets_clean"]))
def q_report_top_categories_run(spark, sf_dir):
    tickets = _tickets(spark, sf_dir).withColumn(
        "run_id", F.concat(F.lit("run-"), F.col("created_at").cast("date").cast("string")))
    first = tickets.agg(F.min("run_id")).first()[0]
    return D.report_top_categories(T.classify_tickets(tickets, keep=("run_id",)), run_id=first)


@register("report_top_anomalies_run", O.build(
    "SELECT anomaly_id, dimension, dimension_value, severity, deviation FROM anomalies "
    "WHERE detected_date = (SELECT MIN(detected_date) FROM anomalies) ORDER BY deviation DESC, anomaly_id LIMIT 3", ["anomalies"]))
def q_report_top_anomalies_run(spark, sf_dir):
    anomalies = staged(_anomalies_with_run(spark, sf_dir), "anomalies")
    first = anomalies.agg(F.min("run_id")).first()[0]
    return D.report_top_anomalies(anomalies, run_id=first or "")


@register("enrichment_counts", O.build(
    "SELECT \"table\", CAST(n_rows AS BIGINT) AS n_rows FROM ("
    "SELECT 'ticket_classifications' AS \"table\", COUNT(*) AS n_rows FROM ticket_cls "
    "UNION ALL SELECT 'review_summaries', COUNT(*) FROM rv_out "
    "UNION ALL SELECT 'revenue_anomalies', COUNT(*) FROM anomalies "
    "UNION ALL SELECT 'lead_enrichments', COUNT(*) FROM leads_enriched "
    "UNION ALL SELECT 'total', (SELECT COUNT(*) FROM ticket_cls) + (SELECT COUNT(*) FROM rv_out) "
    "+ (SELECT COUNT(*) FROM anomalies) + (SELECT COUNT(*) FROM leads_enriched))",
    ["ticket_cls", "rv_out", "anomalies", "leads_enriched"]))
def q_enrichment_counts(spark, sf_dir):
    return W.enrichment_counts({
        "ticket_classifications": T.classify_tickets(cleaned(spark, sf_dir, "support_tickets")),
        "review_summaries": RV.summarize_reviews(cleaned(spark, sf_dir, "product_reviews")),
        "revenue_anomalies": _anomalies(spark, sf_dir),
        "lead_enrichments": L.enrich_leads(cleaned(spark, sf_dir, "crm_leads"))})


# ── constraints of the warehouse tables ─────────────────────────────────────
from tidewater import schemas as SC  # noqa: E402

_TABLE_SQL = {  # warehouse table -> its rows in SQL
    "orders": "orders_clean", "support_tickets": "tickets_clean", "product_reviews": "reviews_clean",
    "web_analytics": "web_clean", "crm_leads": "leads_clean", "pipeline_runs": "run_view",
    "ticket_classifications": f"(SELECT c.*, {_RUN_OF_TICKET} AS run_id FROM ticket_cls c JOIN tickets_clean t USING (ticket_id))",
    "review_summaries": "(SELECT *, 'run-2024-01-03' AS run_id FROM rv_out)",
    "revenue_anomalies": f"(SELECT *, {_RUN_OF_ANOMALY} AS run_id FROM anomalies)",
    "lead_enrichments": "(SELECT *, 'run-' || lead_id AS run_id FROM leads_enriched)"}


def _warehouse_sql() -> str:
    parts = []
    for t, src in _TABLE_SQL.items():
        keys = ", ".join(SC.TABLE_KEYS[t])
        parts.append(f"SELECT '{t}' AS \"table\", 'primary_key' AS \"constraint\", '{','.join(SC.TABLE_KEYS[t])}' AS columns, "
                     f"CAST(COUNT_IF(n > 1) AS BIGINT) AS violations FROM (SELECT {keys}, COUNT(*) AS n FROM {src} GROUP BY {keys})")
        parts += [f"SELECT '{t}', 'not_null', '{c}', CAST(COUNT_IF({c} IS NULL) AS BIGINT) FROM {src}" for c in SC.required_columns(t)]
        parts += [f"SELECT '{t}', 'range[{lo},{hi}]', '{c}', CAST(COUNT_IF({c} NOT BETWEEN {lo} AND {hi}) AS BIGINT) FROM {src}"
                  for c, (lo, hi) in SC.RANGES.get(t, {}).items()]
    parts += [f"SELECT '{t}', 'foreign_key', '{c}', CAST(COUNT(*) AS BIGINT) FROM {_TABLE_SQL[t]} x WHERE {c} IS NOT NULL "
              f"AND NOT EXISTS (SELECT 1 FROM {_TABLE_SQL[p]} p WHERE p.{pc} = x.{c})" for t, c, p, pc in SC.FOREIGN_KEYS]
    return "\nUNION ALL\n".join(parts)


def _raw_columns(df, name):
    return df.select(*[c for c in SC.RAW_SCHEMAS[name].names if c != "loaded_at"])


def _warehouse_tables(spark, sf_dir):
    """The ten tables as a run would write them, so raw ones without the helper ``text``. Those are
    written once, as the marts read them again; each mart is read once, by the report."""
    raw = staged_all({n: _raw_columns(cleaned(spark, sf_dir, n), n) for n in SC.RAW_SCHEMAS})
    day = F.concat(F.lit("run-"), F.col("created_at").cast("date").cast("string"))
    marts = {
        "ticket_classifications": T.classify_tickets(raw["support_tickets"].withColumn("run_id", day), keep=("run_id",)),
        "review_summaries": RV.summarize_reviews(raw["product_reviews"]).withColumn("run_id", F.lit("run-2024-01-03")),
        "revenue_anomalies": R.detect_anomalies(R.daily_revenue_by_segment(raw["orders"])).withColumn(
            "run_id", F.concat(F.lit("run-"), F.col("detected_date").cast("string"))),
        "lead_enrichments": L.enrich_leads(raw["crm_leads"]).withColumn("run_id", F.concat(F.lit("run-"), F.col("lead_id"))),
        "pipeline_runs": _ledger_view(spark, sf_dir)}
    return {**raw, **marts}


@register("quality_report", O.build(_warehouse_sql(), ["orders_clean", "tickets_clean", "reviews_clean", "web_clean", "leads_clean",
                                                       "run_view", "ticket_cls", "rv_out", "anomalies", "leads_enriched"]))
def q_quality_report(spark, sf_dir):
    return QC.warehouse_report(_warehouse_tables(spark, sf_dir))


_FIRST_DAY = "(SELECT MIN(CAST(created_at AS DATE)) FROM tickets_clean)"


@register("upsert_mart", O.build(f"""SELECT c.ticket_id,
  CASE WHEN CAST(t.created_at AS DATE) = {_FIRST_DAY} THEN 'account' ELSE category END AS category, sentiment, urgency, confidence,
  detected_language, CASE WHEN CAST(t.created_at AS DATE) = {_FIRST_DAY} AND category <> 'account' THEN 'second' ELSE 'first' END AS run_id
FROM ticket_cls c JOIN tickets_clean t USING (ticket_id)""", ["ticket_cls", "tickets_clean"]))
def q_upsert_mart(spark, sf_dir):
    """The ticket mart written by one run, the tickets of its first day corrected by a
    second one, read back."""
    out = shared_folder(spark, "upsert-mart")
    tickets = staged(_tickets(spark, sf_dir), "tickets")
    first = CM.RunWrites(spark, out, "first")
    W.put_mart(first, T.classify_tickets(tickets), "ticket_classifications")
    first.publish()
    day = tickets.agg(F.min(F.col("created_at").cast("date")).alias("d")).scalar()
    late = T.classify_tickets(tickets.where(F.col("created_at").cast("date") == day)).withColumn("category", F.lit("account"))
    second = CM.RunWrites(spark, out, "second")
    W.put_mart(second, late, "ticket_classifications", mode="upsert")
    second.publish()
    return CM.read_table(spark, out, "mart/ticket_classifications").drop("enriched_at")


_LOADED = {"raw/orders": "orders_clean", "raw/support_tickets": "tickets_clean", "raw/product_reviews": "reviews_clean",
           "raw/web_analytics": "web_clean", "raw/crm_leads": "leads_clean", "mart/ticket_classifications": "ticket_cls",
           "mart/review_summaries": "rv_out", "mart/revenue_anomalies": "anomalies", "mart/lead_enrichments": "leads_enriched"}
_KEY_MD5 = {t: " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in SC.TABLE_KEYS[t.split("/")[1]]) for t in _LOADED}


@register("warehouse_tables", O.build("\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(md5({_KEY_MD5[t]})) AS least_key, MAX(md5({_KEY_MD5[t]})) AS greatest_key FROM {src}"
    for t, src in _LOADED.items()), list(_LOADED.values())))
def q_warehouse_tables(spark, sf_dir):
    """The sources as CSV files, loaded, enriched and committed by one
    run; rows and keys of each of its tables, read back."""
    from tidewater.plans.pipeline import run_pipeline
    src, out = shared_folder(spark, "csv"), shared_folder(spark, "warehouse")
    for name in SC.SOURCE_COLUMNS:
        (source(spark, sf_dir, name).select(*SC.SOURCE_COLUMNS[name]).write.option("header", True).option("escape", '"')
         .option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{src}/{name}.csv"))
    run_pipeline(spark, src, out, "run", multiline=True)
    parts = [CM.read_table(spark, out, t).select(F.lit(t).alias("table"), F.md5(F.concat_ws("|", *SC.TABLE_KEYS[t.split("/")[1]])).alias("key")) for t in _LOADED]
    every = spark.createDataFrame([(t,) for t in _LOADED], "t string")
    counts = reduce(lambda a, b: a.unionByName(b), parts).groupBy("table").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("least_key"), F.max("key").alias("greatest_key"))
    return every.join(counts, F.col("t") == F.col("table"), "left").select(
        F.col("t").alias("table"), F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"), "least_key", "greatest_key")


@register("detect_anomalies_incremental", O.build("SELECT * FROM anomalies", ["anomalies"]))
def q_anomalies_incremental(spark, sf_dir):
    """A6, W1, W2 from kept state: all days but the last without every tenth order, then these late
    orders with the last day."""
    from tidewater.plans.incremental import add_orders, current_anomalies
    orders = staged(cleaned(spark, sf_dir, "orders"), "orders")
    last = orders.agg(F.max("order_date").alias("d")).scalar()
    first_part = (F.col("order_date") < last) & (F.crc32("order_id") % 10 != 0)
    out = shared_folder(spark, "history")
    for run, part in (("first", first_part), ("second", ~F.coalesce(first_part, F.lit(False)))):
        writes = CM.RunWrites(spark, out, run)
        add_orders(writes, orders.where(part))
        writes.publish()
    return current_anomalies(CM.RunWrites(spark, out))


@register("summarize_reviews_incremental", O.build(
    "SELECT product_id, review_window, n_reviews, avg_rating, md5(summary_en) AS summary_en_md5, "
    "md5(summary_fr) AS summary_fr_md5, top_themes FROM rv_out", ["rv_out"]))
def q_summarize_reviews_incremental(spark, sf_dir):
    """T7-T9 from kept state: two deliveries, the second with late reviews of most months; the mart gets the
    summaries of the months that changed."""
    from tidewater.plans.incremental import add_reviews
    reviews = staged(cleaned(spark, sf_dir, "product_reviews"), "reviews")
    out = shared_folder(spark, "history")
    late = F.crc32("review_id") % 4 == 0
    for run, part in (("first", ~late), ("second", late)):
        writes = CM.RunWrites(spark, out, run)
        writes.upsert("mart/review_summaries", add_reviews(writes, reviews.where(part)), RV.GROUP)
        writes.publish()
    kept = CM.read_table(spark, out, "mart/review_summaries")
    return kept.select("product_id", "review_window", "n_reviews", "avg_rating", F.md5("summary_en").alias("summary_en_md5"),
                       F.md5("summary_fr").alias("summary_fr_md5"), RV.themes_flat("top_themes").alias("top_themes"))


@register("conform", O.build("SELECT order_id, customer_id, order_date, channel, region, 'EUR' AS currency, "
                             "CAST(ROUND(gross_revenue_eur, 2) AS DECIMAL(24,2)) AS gross_revenue_eur, "
                             "CAST(0 AS DECIMAL(24,2)) AS discount_eur, net_revenue_eur, units, "
                             "TIMESTAMP '2026-01-01 00:00:00' AS loaded_at FROM orders_clean", ["orders_clean"]))
def q_conform(spark, sf_dir):
    import datetime as dt
    given = cleaned(spark, sf_dir, "orders").drop("currency", "discount_eur")
    out = W.conform(given, SC.RAW_SCHEMAS["orders"], dt.datetime(2026, 1, 1), SC.DEFAULTS["orders"])
    return _ntz(out, "loaded_at")


@register("with_text", O.build(
    "SELECT 'subject_description' AS form, ticket_id AS id, md5(COALESCE(subject, '') || '. ' || COALESCE(description, '')) AS text_md5 FROM tickets_clean "
    "UNION ALL SELECT 'title_body', review_id, md5(COALESCE(title, '') || '. ' || COALESCE(body, '')) FROM reviews_clean "
    "UNION ALL SELECT 'none', lead_id, md5('') FROM leads_clean", ["tickets_clean", "reviews_clean", "leads_clean"]))
def q_with_text(spark, sf_dir):
    """C8's branches that the other queries don't reach."""
    def part(form, name, key):
        df = C.with_text(cleaned(spark, sf_dir, name).drop("text"))
        return df.select(F.lit(form).alias("form"), F.col(key).alias("id"), F.md5("text").alias("text_md5"))
    return (part("subject_description", "support_tickets", "ticket_id").unionByName(part("title_body", "product_reviews", "review_id"))
            .unionByName(part("none", "crm_leads", "lead_id")))


# ── model responses ─────────────────────────────────────────────────────────
from tidewater.operators import responses as RS  # noqa: E402

def _batch_sql(name: str, src: str, key: str, payload: str, prefix: str) -> None:
    half = RS.BATCH_BYTES // 2
    O.cte(f"{name}_rows", f"SELECT {key} AS id, COALESCE({payload}, '') AS payload FROM {src}", [src])
    O.cte(f"{name}_num", f"""WITH numbered AS (
  SELECT *, (ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY id, md5(payload)) - 1) // {lx.TICKETS_PER_BATCH} AS k
  FROM (SELECT *, CAST(('0x' || substr(md5(id || chr(1) || payload), 1, 8)) AS BIGINT)
          % (SELECT CAST(greatest(1, ceil(COUNT(*) / {RS.BUCKET_ROWS}), ceil(SUM(strlen(payload)) / {RS.BUCKET_BYTES})) AS BIGINT) FROM {name}_rows) AS bucket
        FROM (SELECT DISTINCT * FROM {name}_rows))),
 sized AS (SELECT *, SUM(strlen(payload)) OVER (PARTITION BY bucket, k) AS total,
    SUM(CASE WHEN strlen(payload) > {half} THEN 0 ELSE strlen(payload) END) OVER w
      - CASE WHEN strlen(payload) > {half} THEN 0 ELSE strlen(payload) END AS before, ROW_NUMBER() OVER w AS i
  FROM numbered WINDOW w AS (PARTITION BY bucket, k ORDER BY id, md5(payload) ROWS UNBOUNDED PRECEDING)),
 pieces AS (SELECT *, CASE WHEN total <= {RS.BATCH_BYTES} THEN 0 WHEN strlen(payload) > {half} THEN -i ELSE CAST(before // {half} AS BIGINT) END AS piece FROM sized)
SELECT id, payload, bucket || '-' || k || CASE WHEN total <= {RS.BATCH_BYTES} THEN '' ELSE '-' || MIN(i) OVER (PARTITION BY bucket, k, piece) END AS batch_id
FROM pieces""", [f"{name}_rows"])
    item = f"'{{\"id\":' || CAST(to_json(id) AS VARCHAR) || ',\"{payload}\":' || CAST(to_json(payload) AS VARCHAR) || '}}'"
    O.cte(name, f"""SELECT batch_id, CAST(COUNT(*) AS INTEGER) AS n_items,
  md5(string_agg(id, ',' ORDER BY id, md5(payload))) AS items_md5,
  md5({q(prefix)} || '[' || string_agg({item}, ',' ORDER BY id, md5(payload)) || ']') AS user_message_md5
FROM {name}_num GROUP BY batch_id""", [f"{name}_num"])


_batch_sql("tbatch", "tickets_clean", "ticket_id", "text", lx.TICKET_BATCH_PROMPT_PREFIX)
_batch_sql("lbatch", "leads_clean", "lead_id", "notes", lx.LEAD_BATCH_PROMPT_PREFIX)


def _ticket_batches(spark, sf_dir):
    return RS.build_ticket_batches(_tickets(spark, sf_dir))


def _batch_view(b):
    return b.select("batch_id", "n_items", F.md5(F.array_join("items.id", ",")).alias("items_md5"),
                    F.md5("user_message").alias("user_message_md5"), F.md5("system_message").alias("system_message_md5"))


def _batch_view_sql(name: str, system: str) -> str:
    return f"SELECT *, md5({q(system)}) AS system_message_md5 FROM {name}"


@register("build_ticket_batches", O.build(_batch_view_sql("tbatch", RS.TICKET_SYSTEM), ["tbatch"]))
def q_build_ticket_batches(spark, sf_dir):
    return _batch_view(_ticket_batches(spark, sf_dir))


@register("build_lead_batches", O.build(_batch_view_sql("lbatch", RS.LEAD_SYSTEM), ["lbatch"]))
def q_build_lead_batches(spark, sf_dir):
    return _batch_view(RS.build_lead_batches(_leads(spark, sf_dir)))


O.cte("rv_themes_repr", "SELECT product_id, review_window, '[' || COALESCE(string_agg("
      "'{''theme'': ''' || theme || ''', ''weight'': ' || CAST(weight AS VARCHAR) || '}', "
      "', ' ORDER BY rn), '') || ']' AS themes FROM ("
      " SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id, review_window "
      "ORDER BY weight DESC, ord) AS rn FROM ("
      + " UNION ALL ".join(f"SELECT product_id, review_window, {q(th)} AS theme, {i} AS ord, "
                           f"CAST(th_{i} AS BIGINT) AS weight FROM rv_stats"
                           for i, th in enumerate(lx.THEME_KEYWORDS))
      + ") WHERE weight > 0) WHERE rn <= 5 GROUP BY product_id, review_window", ["rv_stats"])


@register("build_review_prompts", O.build(
    "SELECT s.product_id, s.review_window, 'Product ' || s.product_id || ' (' || s.review_window "
    "|| '): ' || CAST(s.n_reviews AS VARCHAR) || ' reviews, avg rating ' || "
    "CAST(CAST(s.avg_rating AS DOUBLE) AS VARCHAR) || '/5, themes: ' || COALESCE(t.themes, '[]') "
    "|| '.' AS user_message FROM rv_stats s LEFT JOIN rv_themes_repr t "
    "USING (product_id, review_window)", ["rv_stats", "rv_themes_repr"]))
def q_build_review_prompts(spark, sf_dir):
    prompts = RS.build_review_prompts(RV.summarize_reviews(cleaned(spark, sf_dir, "product_reviews")))
    return prompts.drop("system_message")


def _ticket_responses_sql(broken: bool) -> str:
    def pick_(values, idx):
        return O.pick(values, idx)

    def obj(id_part, cat_idx):
        return (f"'{{' || {id_part} || CASE WHEN n % 29 = 0 THEN {q(AD.DECOY)} ELSE '' END || '\"category\": \"' || {pick_(AD.RESPONSE_CATEGORIES, cat_idx)}"
                f" || '\", \"sentiment\": \"' || {pick_(AD.RESPONSE_SENTIMENTS, 'n % 4')}"
                f" || '\", \"urgency\": \"' || {pick_(AD.RESPONSE_URGENCIES, 'n % 5')}"
                f" || '\", \"confidence\": ' || {pick_(AD.RESPONSE_CONFIDENCES, 'n % 6')} || '}}'")

    own = "'\"id\": \"' || id || '\", '"
    unknown = "'\"id\": \"UNKNOWN-' || id || '\", '"
    per_item = (f"NULLIF(concat_ws(', ', CASE WHEN n % 11 <> 3 THEN CASE WHEN n % 17 = 0 THEN "
                f"{obj(q(''), 'n % 7')} ELSE {obj(own, 'n % 7')} END END, "
                f"CASE WHEN n % 19 = 0 THEN {obj(own, '4')} END, "
                f"CASE WHEN n % 13 = 0 THEN {obj(unknown, '0')} END), '')")
    body = "'{\"results\": [' || COALESCE(string_agg(o, ', ' ORDER BY id), '') || ']}'"
    style = "CAST(('0x' || substr(md5(batch_id), 1, 2)) AS INTEGER) % 4"
    content = (f"CASE WHEN {style} = 1 THEN '```json' || chr(10) || {body} || chr(10) || '```' "
               f"WHEN {style} = 2 THEN 'Here are the results: ' || {body} || "
               f"' Let me know if you need more.' ELSE {body} END")
    if broken:
        content = (f"CASE WHEN {style} = 3 THEN '' WHEN substr(md5(batch_id), 1, 1) = '0' "
                   f"THEN 'Sorry, no JSON' ELSE {content} END")
    return (f"SELECT batch_id, {content} AS content FROM (SELECT batch_id, id, {per_item} AS o "
            f"FROM (SELECT batch_id, id, CAST(regexp_extract(id, '(\\d+)$', 1) AS BIGINT) AS n "
            f"FROM tbatch_num)) GROUP BY batch_id")


O.cte("tresp", _ticket_responses_sql(False), ["tbatch_num"])
O.cte("tresp_broken", _ticket_responses_sql(True), ["tbatch_num"])


def _parsed_sql(src: str, keys: str) -> str:
    # json_extract takes the first of repeated keys, the rule is the last: the decoys go beforehand.
    return (f"SELECT {keys}, blob, blob <> '' AND json_valid(blob) AS is_valid FROM "
            f"(SELECT {keys}, replace(regexp_extract(COALESCE(content, ''), '(?s)\\{{.*\\}}', 0), "
            f"{q(AD.DECOY)}, '') AS blob FROM {src})")


def _coerce_sql(v: str, allowed: list[str], default: str) -> str:
    x = f"replace(lower({O.strip(v)}), ' ', '_')"
    return f"CASE WHEN {x} IN ({', '.join(q(a) for a in allowed)}) THEN {x} ELSE {q(default)} END"


def _merge_tickets_sql(resp: str) -> str:
    d = lx.RESPONSE_DEFAULTS
    conf = "TRY_CAST(json_extract_string(r, '$.confidence') AS DOUBLE)"
    return f"""WITH parsed AS ({_parsed_sql(resp, 'batch_id')}),
res AS (SELECT batch_id, idx, r FROM (
  SELECT batch_id, generate_subscripts(arr, 1) AS idx, unnest(arr) AS r
  FROM (SELECT batch_id, json_extract(blob, '$.results[*]') AS arr FROM parsed WHERE is_valid))),
rows AS (SELECT batch_id, idx, json_extract_string(r, '$.id') AS ticket_id,
  {_coerce_sql("json_extract_string(r, '$.category')", lx.CATEGORY_LABELS, d['category'])} AS category,
  {_coerce_sql("json_extract_string(r, '$.sentiment')", lx.SENTIMENT_LABELS, d['sentiment'])} AS sentiment,
  {_coerce_sql("json_extract_string(r, '$.urgency')", lx.URGENCY_LABELS, d['urgency'])} AS urgency,
  CAST(CASE WHEN {conf} IS NULL THEN {d['confidence']}
       ELSE LEAST(1.0, GREATEST(0.0, ROUND({conf}, 3))) END AS DECIMAL(4,3)) AS confidence
  FROM res),
known AS (SELECT r.* FROM rows r JOIN tbatch_num b ON r.batch_id = b.batch_id AND r.ticket_id = b.id),
model AS (SELECT ticket_id, category, sentiment, urgency, confidence FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ticket_id ORDER BY batch_id DESC, idx DESC) AS k
  FROM known) WHERE k = 1),
merged AS (
  SELECT m.ticket_id, m.category, m.sentiment, m.urgency, m.confidence,
    {lang_sql('t.text')} AS detected_language
  FROM model m JOIN tickets_clean t USING (ticket_id)
  UNION ALL
  SELECT * FROM ticket_cls WHERE ticket_id NOT IN (SELECT ticket_id FROM model)),
flag AS (SELECT COUNT(*) > 0 AS fell_back FROM (SELECT DISTINCT batch_id FROM tbatch_num) b
  LEFT JOIN parsed p USING (batch_id) WHERE NOT COALESCE(p.is_valid, false))
SELECT * FROM merged WHERE NOT (SELECT fell_back FROM flag)
UNION ALL
SELECT * FROM ticket_cls WHERE (SELECT fell_back FROM flag)"""


def _with_prefix(sql: str, needs: list[str]) -> str:
    """Put a statement that starts with its own WITH after the shared CTEs."""
    shared = O.build("SELECT 1", needs)
    head = shared[: shared.rindex("\nSELECT 1")]
    return head + ",\n" + sql[len("WITH "):]


@register("parse_response", O.build(
    "SELECT batch_id, is_valid, CAST(CASE WHEN is_valid THEN COALESCE(json_array_length(blob, "
    "'$.results'), 0) END AS INTEGER) AS n_results FROM (" + _parsed_sql("tresp_broken", "batch_id")
    + ")", ["tresp_broken"]))
def q_parse_response(spark, sf_dir):
    batches = staged(_ticket_batches(spark, sf_dir), "batches")
    parsed = RS.parse_response(AD.ticket_responses_source(batches, broken=True))
    return parsed.select("batch_id", "is_valid", F.when(F.col("is_valid"), F.coalesce(
        F.size("payload.results"), F.lit(0))).cast("int").alias("n_results"))


def _ticket_round(spark, sf_dir, broken: bool):
    """Tickets, batches and parsed responses, each computed once."""
    tickets = staged(_tickets(spark, sf_dir), "tickets")
    batches = staged(RS.build_ticket_batches(tickets), "batches")
    return tickets, batches, staged(RS.parse_response(AD.ticket_responses_source(batches, broken)), "responses")


@register("merge_ticket_responses", _with_prefix(_merge_tickets_sql("tresp"),
                                                 ["tresp", "tbatch_num", "ticket_cls",
                                                  "tickets_clean"]))
def q_merge_ticket_responses(spark, sf_dir):
    return RS.merge_ticket_responses(*_ticket_round(spark, sf_dir, False))


@register("merge_ticket_responses_fallback", _with_prefix(
    _merge_tickets_sql("tresp_broken"), ["tresp_broken", "tbatch_num", "ticket_cls",
                                         "tickets_clean"]))
def q_merge_ticket_responses_fallback(spark, sf_dir):
    return RS.merge_ticket_responses(*_ticket_round(spark, sf_dir, True))


@register("with_fallback", O.build(
    "SELECT 'classify_tickets' AS operation, COUNT(*) > 0 AS fell_back, CASE WHEN COUNT(*) > 0 "
    "THEN 'classify_tickets: no usable response for ' || CAST(COUNT(*) AS VARCHAR) || "
    "' call(s), first ' || MIN(b.batch_id) END AS error FROM (SELECT DISTINCT batch_id FROM "
    "tbatch_num) b LEFT JOIN (" + _parsed_sql("tresp_broken", "batch_id") + ") p USING (batch_id) "
    "WHERE NOT COALESCE(p.is_valid, false)", ["tresp_broken", "tbatch_num"]))
def q_with_fallback(spark, sf_dir):
    batches = staged(_ticket_batches(spark, sf_dir), "batches")
    resp = AD.ticket_responses_source(batches, broken=True)
    return RS.fallback_status("classify_tickets", batches, resp, ["batch_id"])


def _review_resp_sql() -> str:
    k = "product_id || ' ' || review_window"
    h = f"CAST(('0x' || substr(md5({k}), 1, 2)) AS INTEGER) % 3"
    en = f"'\"summary_en\": \"Model summary of ' || {k} || '\"'"
    fr = f"'\"summary_fr\": \"Résumé du modèle pour ' || {k} || '\"'"
    return (f"SELECT product_id, review_window, CASE WHEN {h} = 0 THEN '{{' || {en} || ', ' || {fr} "
            f"|| '}}' WHEN {h} = 1 THEN '```json' || chr(10) || '{{' || {en} || '}}' || chr(10) || "
            f"'```' ELSE 'Voici: {{' || {fr} || ', ' || {en} || '}} fin' END AS content FROM rv_out")


O.cte("rresp", _review_resp_sql(), ["rv_out"])


@register("merge_review_responses", O.build(f"""SELECT b.product_id, b.review_window,
  md5(COALESCE(json_extract_string(p.blob, '$.summary_en'), b.summary_en)) AS summary_en_md5,
  md5(COALESCE(json_extract_string(p.blob, '$.summary_fr'), b.summary_fr)) AS summary_fr_md5
FROM rv_out b LEFT JOIN ({_parsed_sql('rresp', 'product_id, review_window')}) p
  ON p.product_id = b.product_id AND p.review_window = b.review_window AND p.is_valid""",
    ["rv_out", "rresp"]))
def q_merge_review_responses(spark, sf_dir):
    base = staged(RV.summarize_reviews(cleaned(spark, sf_dir, "product_reviews")), "summaries")
    merged = RS.merge_review_responses(base, AD.review_responses_source(base))
    return merged.select("product_id", "review_window",
                         F.md5("summary_en").alias("summary_en_md5"),
                         F.md5("summary_fr").alias("summary_fr_md5"))


def _lead_resp_sql(broken: bool) -> str:
    en = "CASE WHEN n % 5 = 1 THEN '' ELSE 'EN note for ' || id END"
    fr = "CASE WHEN n % 7 = 2 THEN '' ELSE 'Note FR pour ' || id END"
    one = (f"'{{\"id\": \"' || id || '\", \"notes_en\": \"' || {en} || '\", \"notes_fr\": \"' "
           f"|| {fr} || '\"}}'")
    again = ("CASE WHEN n % 23 = 0 THEN '{\"id\": \"' || id || "
             "'\", \"notes_en\": \"Repeated note\", \"notes_fr\": \"\"}' END")
    foreign = ("CASE WHEN bool_or(id = 'LD-1') THEN '' ELSE "
               "', {\"id\": \"LD-1\", \"notes_en\": \"not asked\", \"notes_fr\": \"pas demandé\"}' END")
    content = f"'{{\"results\": [' || string_agg(concat_ws(', ', {one}, {again}), ', ' ORDER BY id) || {foreign} || ']}}'"
    if broken:
        content = f"CASE WHEN batch_id = '0-0' THEN 'no answer' ELSE {content} END"
    return (f"SELECT batch_id, {content} AS content FROM (SELECT batch_id, id, "
            f"CAST(regexp_extract(id, '(\\d+)$', 1) AS BIGINT) AS n FROM lbatch_num) GROUP BY batch_id")


O.cte("lresp", _lead_resp_sql(False), ["lbatch_num"])
O.cte("lresp_broken", _lead_resp_sql(True), ["lbatch_num"])


def _merge_leads_sql(resp: str) -> str:
    return f"""WITH parsed AS ({_parsed_sql(resp, 'batch_id')}),
res AS (SELECT batch_id, idx, r FROM (
  SELECT batch_id, generate_subscripts(arr, 1) AS idx, unnest(arr) AS r
  FROM (SELECT batch_id, json_extract(blob, '$.results[*]') AS arr FROM parsed WHERE is_valid))),
latest AS (SELECT lead_id, m_en, m_fr FROM (
  SELECT b.id AS lead_id, NULLIF(json_extract_string(r, '$.notes_en'), '') AS m_en,
    NULLIF(json_extract_string(r, '$.notes_fr'), '') AS m_fr,
    ROW_NUMBER() OVER (PARTITION BY b.id ORDER BY res.batch_id DESC, idx DESC) AS k
  FROM res JOIN lbatch_num b ON b.batch_id = res.batch_id AND b.id = json_extract_string(r, '$.id')) WHERE k = 1),
flag AS (SELECT COUNT(*) > 0 AS fell_back FROM (SELECT DISTINCT batch_id FROM lbatch_num) b
  LEFT JOIN parsed p USING (batch_id) WHERE NOT COALESCE(p.is_valid, false))
SELECT b.lead_id, COALESCE(l.m_en, b.notes_en) AS notes_en, COALESCE(l.m_fr, b.notes_fr) AS notes_fr
FROM leads_enriched b LEFT JOIN latest l ON b.lead_id = l.lead_id AND NOT (SELECT fell_back FROM flag)"""


def _merged_leads(spark, sf_dir, broken: bool):
    leads = staged(_leads(spark, sf_dir), "leads")
    batches = staged(RS.build_lead_batches(leads), "batches")
    parsed = staged(RS.parse_response(AD.lead_responses_source(batches, broken), RS.LEAD_RESULT), "responses")
    return RS.merge_lead_responses(L.enrich_leads(leads), batches, parsed).select("lead_id", "notes_en", "notes_fr")


@register("merge_lead_responses", _with_prefix(_merge_leads_sql("lresp"), ["lresp", "lbatch_num", "leads_enriched"]))
def q_merge_lead_responses(spark, sf_dir):
    return _merged_leads(spark, sf_dir, False)


@register("merge_lead_responses_fallback", _with_prefix(
    _merge_leads_sql("lresp_broken"), ["lresp_broken", "lbatch_num", "leads_enriched"]))
def q_merge_lead_responses_fallback(spark, sf_dir):
    return _merged_leads(spark, sf_dir, True)


def _cost_sql(billed: str) -> str:
    rates = " ".join(f"WHEN {q(k)} THEN CAST({v} AS DECIMAL(10,4))"
                     for k, v in lx.RATE_PER_1K_TOKENS.items())
    provider = O.pick(AD.RESPONSE_PROVIDERS, "k % 12 % 5")
    return f"""SELECT run_id, CAST(SUM(n_calls) AS BIGINT) AS llm_calls,
  CAST(SUM(ROUND(CAST({billed} AS DECIMAL(18,0)) * {lx.TOKENS_PER_CALL} / 1000
       * COALESCE(CASE provider {rates} END, CAST(0 AS DECIMAL(10,4))), 6)) AS DECIMAL(18,6))
    AS llm_cost_estimate
FROM (SELECT 'run-' || CAST(k % 12 AS VARCHAR) AS run_id, {provider} AS provider, 1 AS n_calls, k % 2 AS billed
      FROM (SELECT CAST(split_part(batch_id, '-', 2) AS INTEGER) AS k FROM tbatch))
GROUP BY run_id"""


@register("estimate_cost", O.build(_cost_sql("n_calls"), ["tbatch"]))
def q_estimate_cost(spark, sf_dir):
    return RS.estimate_cost(AD.call_log_source(_ticket_batches(spark, sf_dir)))


@register("estimate_cost_reference", O.build(_cost_sql("billed"), ["tbatch"]))
def q_estimate_cost_reference(spark, sf_dir):
    return RS.estimate_cost(AD.call_log_source(_ticket_batches(spark, sf_dir)), mode="reference")


# ── source normalisation and nested export ─────────────────────────────────
@register("normalize_nulls", O.build("SELECT * FROM orders_src", ["orders_src"]))
def q_normalize_nulls(spark, sf_dir):
    return source(spark, sf_dir, "orders")


@register("encode_nested", O.build(
    "SELECT lead_id, CAST(to_json(intent_signals) AS VARCHAR) AS intent_signals "
    "FROM leads_enriched",
    ["leads_enriched"]))
def q_encode_nested(spark, sf_dir):
    enriched = L.enrich_leads(_leads(spark, sf_dir)).select("lead_id", "intent_signals")
    return W.encode_nested(enriched)


O.cte("rv_themes_json", "SELECT product_id, review_window, to_json(list(json_object('theme', "
      "theme, 'weight', weight) ORDER BY rn)) AS top_themes FROM ("
      " SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id, review_window "
      "ORDER BY weight DESC, ord) AS rn FROM ("
      + " UNION ALL ".join(f"SELECT product_id, review_window, {q(th)} AS theme, {i} AS ord, "
                           f"CAST(th_{i} AS BIGINT) AS weight FROM rv_stats"
                           for i, th in enumerate(lx.THEME_KEYWORDS))
      + ") WHERE weight > 0) WHERE rn <= 5 GROUP BY product_id, review_window", ["rv_stats"])


@register("encode_nested_reviews", O.build(
    "SELECT s.product_id, s.review_window, COALESCE(CAST(t.top_themes AS VARCHAR), '[]') "
    "AS top_themes "
    "FROM rv_stats s LEFT JOIN rv_themes_json t USING (product_id, review_window)",
    ["rv_stats", "rv_themes_json"]))
def q_encode_nested_reviews(spark, sf_dir):
    out = RV.summarize_reviews(cleaned(spark, sf_dir, "product_reviews"))
    return W.encode_nested(out.select("product_id", "review_window", "top_themes"))
