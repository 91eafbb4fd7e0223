"""Oracle SQL (DuckDB dialect) mirroring every registered query.

The checker runs each query's SQL against the same parquet tables and
compares row count, schema and values with the Spark result. Each recipe
here restates, in plain SQL, the definition the Spark code implements;
named CTEs are resolved with their dependencies by ``build``.
"""

from __future__ import annotations

from collections import Counter

from tidewater.functions import lexicon as lx
from tidewater.schemas import SOURCE_COLUMNS
from tidewater.sources import vocabulary as vocab


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def pick(values: list[str], idx: str) -> str:
    return f"({sql_list(values)})[({idx}) + 1]"


def fill(template: str, values: dict[str, str]) -> str:
    out = template
    for k, v in values.items():
        out = f"replace({out}, {q('{' + k + '}')}, CAST({v} AS VARCHAR))"
    return out


def normalize(name: str, src: str) -> str:
    tokens = ", ".join(q(t) for t in lx.NA_TOKENS)
    cols = ", ".join(f"CASE WHEN {c} IN ({tokens}) THEN NULL ELSE {c} END AS {c}"
                     for c in SOURCE_COLUMNS[name])
    return f"SELECT {cols} FROM {src}"


def strip(expr: str) -> str:
    from tidewater.functions.text import WHITESPACE
    return f"trim({expr}, {q(WHITESPACE)})"


CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (sql, deps or [])


def build(final: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order) + "\n" + final


# ── adapters ────────────────────────────────────────────────────────────────
cte("geo", """SELECT c_custkey, r_name FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

cte("orders_raw", """SELECT
  'ORD-' || CAST(o.o_orderkey AS VARCHAR) AS order_id,
  'C-' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
  CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date,
  CASE WHEN o.o_orderstatus = 'F' THEN 'web' WHEN o.o_orderstatus = 'O' THEN 'mobile'
       ELSE 'marketplace' END AS channel,
  g.r_name AS region,
  CASE WHEN o.o_orderkey % 10 = 7 THEN 'USD' WHEN o.o_orderkey % 10 = 8 THEN 'GBP'
       ELSE 'EUR' END AS currency,
  CASE WHEN o.o_orderkey % 9973 = 5 THEN CAST(CAST(li.gross + 2345678901234.5 AS DECIMAL(22,2)) AS VARCHAR)
       WHEN o.o_orderkey % 997 = 6 THEN CAST(li.gross AS VARCHAR) || '5'
       WHEN o.o_orderkey % 1009 = 8 THEN '1e30' ELSE CAST(li.gross AS VARCHAR) END AS gross_revenue_eur,
  CASE WHEN o.o_orderkey % 499 = 17 THEN 'abc' WHEN o.o_orderkey % 499 = 18
       THEN CAST(li.discount AS VARCHAR) || '4' ELSE CAST(li.discount AS VARCHAR) END AS discount_eur,
  CAST(li.gross - li.discount AS VARCHAR) AS net_revenue_eur,
  CASE WHEN o.o_orderkey % 97 = 3 THEN 'NA' WHEN o.o_orderkey % 991 = 4 THEN '3000000000'
       WHEN o.o_orderkey % 991 = 9 THEN '99999999999999999999' ELSE CAST(li.units AS VARCHAR) END AS units
FROM orders o
LEFT JOIN (
  SELECT l_orderkey,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS gross,
    CAST(SUM(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2))
         AS DECIMAL(18,2)) AS discount,
    CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units
  FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey
LEFT JOIN geo g ON g.c_custkey = o.o_custkey""", ["geo"])
cte("orders_src", normalize("orders", "orders_raw"), ["orders_raw"])


def _ticket_raw() -> str:
    cats = list(vocab.TICKET_SUBJECTS)
    subjects = [s for c in cats for lang in lx.TICKET_LANGS for s in vocab.TICKET_SUBJECTS[c][lang]]
    descs = [vocab.TICKET_DESCRIPTIONS[c][lang] for c in cats for lang in lx.TICKET_LANGS]
    lang_i = "(CASE WHEN event_id % 20 < 11 THEN 0 ELSE 1 END)"
    subject = pick(subjects, f"(event_id % 6) * 8 + {lang_i} * 4 + (event_id // 6) % 4")
    desc = fill(pick(descs, f"(event_id % 6) * 2 + {lang_i}"), {
        "amt": "20 + user_id % 381", "exp": "10 + event_id % 291",
        "oid": "50000 + event_id % 50000", "dt": "strftime(ts, '%Y-%m-%d')",
        "delay": "2 + event_id % 8"})
    sla = ["true", "false", "True", "1", "YES", "no", "NA", "false", "false"]
    return f"""SELECT
  'TKT-' || CAST(event_id AS VARCHAR) AS ticket_id,
  'C-' || CAST(user_id AS VARCHAR) AS customer_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_at,
  {pick(lx.TICKET_CHANNELS, "user_id % 4")} AS channel,
  {pick(lx.TICKET_LANGS, lang_i)} AS language,
  CASE WHEN event_id % 13 = 5 THEN '  ' || chr(9) || {subject} || chr(10) || ' '
       ELSE {subject} END AS subject,
  CASE WHEN event_id % 41 = 7 THEN 'N/A' ELSE {desc} END AS description,
  {pick(["open", "pending", "solved"], "event_id % 3")} AS status,
  {pick(sla, "event_id % 9")} AS sla_breached
FROM events"""


cte("tickets_raw", _ticket_raw())
cte("tickets_src", normalize("support_tickets", "tickets_raw"), ["tickets_raw"])


def _reviews_raw() -> str:
    t = vocab.REVIEW_TITLES
    rating = ("(CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 1 THEN 4 + d.doc_id % 2 "
              "WHEN l.quality = 0 THEN 1 + d.doc_id % 2 ELSE 3 END)")
    tl = "(CASE WHEN d.lang = 'fr' THEN 'fr' ELSE 'en' END)"
    title = f"""CASE WHEN {rating} >= 4 AND {tl} = 'en' THEN {pick(t['positive']['en'], 'd.doc_id % 4')}
    WHEN {rating} >= 4 THEN {pick(t['positive']['fr'], 'd.doc_id % 4')}
    WHEN {rating} = 3 AND {tl} = 'en' THEN {pick(t['neutral']['en'], 'd.doc_id % 2')}
    WHEN {rating} = 3 THEN {pick(t['neutral']['fr'], 'd.doc_id % 2')}
    WHEN {tl} = 'en' THEN {pick(t['negative']['en'], 'd.doc_id % 2')}
    ELSE {pick(t['negative']['fr'], 'd.doc_id % 2')} END"""
    return f"""SELECT
  'REV-' || CAST(d.doc_id AS VARCHAR) AS review_id,
  d.source AS product_id,
  'Product ' || d.source AS product_name,
  strftime(DATE '2024-01-01' + CAST(d.doc_id % 90 AS INTEGER), '%Y-%m-%dT%H') AS created_at,
  CASE WHEN l.quality IS NULL AND d.doc_id % 23 = 4 THEN 'N/A'
       ELSE CAST({rating} AS VARCHAR) END AS rating,
  d.lang AS language,
  {title} AS title,
  d.text AS body,
  CASE WHEN d.doc_id % 5 < 3 THEN 'true' ELSE 'false' END AS verified
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


cte("reviews_raw", _reviews_raw())
cte("reviews_src", normalize("product_reviews", "reviews_raw"), ["reviews_raw"])

cte("web_raw", f"""SELECT CAST(d AS VARCHAR) AS event_date, page_path, country, device,
  CAST(n AS VARCHAR) AS sessions,
  CASE WHEN n % 11 = 4 THEN 'NA' WHEN n % 13 = 6 THEN CAST(pv + 3000000000 AS VARCHAR)
       WHEN n % 17 = 7 THEN '1e25' ELSE CAST(pv AS VARCHAR) END AS pageviews,
  CAST(CAST(vmin AS DECIMAL(10,2)) AS VARCHAR) AS bounce_rate,
  CAST(CAST(vmax AS DECIMAL(10,2)) AS VARCHAR) AS avg_session_sec
FROM (
  SELECT CAST(ts AS DATE) AS d, '/' || event_type AS page_path,
    {pick(lx.REGIONS, "user_id % 4")} AS country,
    {pick(lx.WEB_DEVICES, "user_id % 3")} AS device,
    COUNT(*) AS n, CAST(SUM(floor(value)) AS BIGINT) AS pv, MIN(value) AS vmin, MAX(value) AS vmax
  FROM events GROUP BY ALL)""")
cte("web_src", normalize("web_analytics", "web_raw"), ["web_raw"])


def _leads_raw() -> str:
    templates = vocab.LEAD_NOTES["en"] + vocab.LEAD_NOTES["fr"]
    notes = fill(pick(templates, "(c_custkey % 2) * 5 + (c_custkey // 2) % 5"), {
        "role": pick(vocab.LEAD_ROLES, "(c_custkey // 3) % 5"),
        "src": pick(lx.LEAD_SOURCES, "(c_custkey // 5) % 4"),
        "comp": pick(vocab.LEAD_COMPETITORS, "(c_custkey // 7) % 6"),
        "sz": pick(vocab.LEAD_SIZES, "(c_custkey // 11) % 8")})
    return f"""SELECT
  'LD-' || CAST(c_custkey AS VARCHAR) AS lead_id,
  c_name AS company_name,
  c_mktsegment AS industry,
  {pick(lx.REGIONS, "c_nationkey % 4")} AS region,
  strftime(DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER), '%Y-%m-%dT%H') AS created_at,
  {pick(lx.LEAD_SOURCES, "c_custkey % 4")} AS source,
  {pick(lx.LEAD_STATUSES, "(c_custkey // 4) % 5")} AS status,
  CASE WHEN c_custkey % 31 = 9 THEN 'NA' WHEN c_custkey % 211 = 7 THEN '123456789012.345'
       ELSE CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 7 AS DECIMAL(12,2)) AS VARCHAR) END
       AS est_value_eur,
  CASE WHEN c_custkey % 37 = 11 THEN '' ELSE {notes} END AS notes
FROM customer"""


cte("leads_raw", _leads_raw())
cte("leads_src", normalize("crm_leads", "leads_raw"), ["leads_raw"])

# ── cleaning ────────────────────────────────────────────────────────────────
def whole_sql(c: str) -> str:
    """Number text -> BIGINT toward zero, 0 where it is no number, null where it does not fit."""
    return (f"CASE WHEN TRY_CAST({c} AS DOUBLE) IS NULL THEN 0 ELSE "
            f"TRY_CAST(trunc(TRY_CAST({c} AS DECIMAL(38,6))) AS BIGINT) END")


cte("orders_typed", f"""SELECT *, CAST(ROUND(gross_revenue_eur - discount_eur, 2) AS DECIMAL(24,2)) AS net_revenue_eur
FROM (SELECT order_id, customer_id, TRY_CAST(order_date AS DATE) AS order_date, channel, region, currency,
    TRY_CAST(gross_revenue_eur AS DECIMAL(26,6)) AS gross_revenue_eur,
    TRY_CAST(discount_eur AS DECIMAL(26,6)) AS discount_eur, {whole_sql("units")} AS units
  FROM orders_src)""", ["orders_src"])
cte("orders_judged", """SELECT *, CASE WHEN order_id IS NULL THEN 'order_id' WHEN order_date IS NULL THEN 'order_date'
  WHEN channel IS NULL THEN 'channel' WHEN region IS NULL THEN 'region'
  WHEN net_revenue_eur IS NULL THEN 'net_revenue_eur' WHEN units IS NULL THEN 'units' END AS reject_reason
FROM orders_typed""", ["orders_typed"])
cte("orders_clean", """SELECT order_id, customer_id, order_date, channel, region, currency, gross_revenue_eur,
  discount_eur, net_revenue_eur, units FROM orders_judged WHERE reject_reason IS NULL""", ["orders_judged"])

cte("tickets_clean", f"""SELECT ticket_id, customer_id,
  COALESCE(TRY_CAST(created_at AS TIMESTAMP), try_strptime(created_at, '%Y-%m-%dT%H')) AS created_at, channel, language,
  {strip("COALESCE(subject, '')")} AS subject,
  {strip("COALESCE(description, '')")} AS description,
  status,
  COALESCE(lower(sla_breached) IN ('true', '1', 'yes'), false) AS sla_breached,
  {strip(strip("COALESCE(subject, '')") + " || '. ' || " + strip("COALESCE(description, '')"))}
    AS text
FROM tickets_src""", ["tickets_src"])

cte("reviews_judged", f"""SELECT *, CASE WHEN review_id IS NULL THEN 'review_id' WHEN product_id IS NULL
    THEN 'product_id' WHEN rating IS NULL THEN 'rating' END AS reject_reason FROM (
  SELECT review_id, product_id, product_name,
    COALESCE(TRY_CAST(created_at AS TIMESTAMP), try_strptime(created_at, '%Y-%m-%dT%H')) AS created_at,
    CASE WHEN TRY_CAST(rating AS DOUBLE) = floor(TRY_CAST(rating AS DOUBLE))
         THEN TRY_CAST(TRY_CAST(rating AS DOUBLE) AS INTEGER) END AS rating,
    language,
    {strip("COALESCE(title, '')")} AS title,
    {strip("COALESCE(body, '')")} AS body,
    COALESCE(lower(verified) IN ('true', '1', 'yes'), false) AS verified,
    {strip(strip("COALESCE(title, '')") + " || '. ' || " + strip("COALESCE(body, '')"))} AS text
  FROM reviews_src)""", ["reviews_src"])
cte("reviews_clean", "SELECT * EXCLUDE (reject_reason) FROM reviews_judged WHERE reject_reason IS NULL", ["reviews_judged"])

cte("web_judged", f"""SELECT *, CASE WHEN event_date IS NULL THEN 'event_date' WHEN page_path IS NULL THEN 'page_path'
  WHEN country IS NULL THEN 'country' WHEN device IS NULL THEN 'device' WHEN sessions IS NULL THEN 'sessions'
  WHEN pageviews IS NULL THEN 'pageviews' END AS reject_reason
FROM (SELECT TRY_CAST(event_date AS DATE) AS event_date, page_path, country, device,
    {whole_sql("sessions")} AS sessions, {whole_sql("pageviews")} AS pageviews,
    TRY_CAST(bounce_rate AS DECIMAL(10,2)) AS bounce_rate,
    TRY_CAST(avg_session_sec AS DECIMAL(10,2)) AS avg_session_sec FROM web_src)""", ["web_src"])
cte("web_clean", "SELECT * EXCLUDE (reject_reason) FROM web_judged WHERE reject_reason IS NULL", ["web_judged"])

cte("leads_clean", f"""SELECT lead_id, company_name, industry, region,
  COALESCE(TRY_CAST(created_at AS TIMESTAMP), try_strptime(created_at, '%Y-%m-%dT%H')) AS created_at, source, status,
  CAST(ROUND(TRY_CAST(est_value_eur AS DECIMAL(26,6)), 2) AS DECIMAL(24,2)) AS est_value_eur,
  {strip("COALESCE(notes, '')")} AS notes
FROM leads_src""", ["leads_src"])

# ── revenue ─────────────────────────────────────────────────────────────────
cte("rev_fine", """SELECT order_date, channel, region, SUM(net_revenue_eur) AS net,
  SUM(units) AS units, COUNT(order_id) AS n
FROM orders_clean WHERE order_date IS NOT NULL GROUP BY order_date, channel, region""",
    ["orders_clean"])


def _segment_sql(rollups: bool) -> str:
    parts = ["SELECT order_date, channel, region, net, units, n FROM rev_fine "
             "WHERE channel IS NOT NULL AND region IS NOT NULL",
             "SELECT order_date, 'all', 'all', SUM(net), SUM(units), SUM(n) FROM rev_fine "
             "GROUP BY order_date"]
    if rollups:
        parts += ["SELECT order_date, channel, 'all', SUM(net), SUM(units), SUM(n) FROM rev_fine "
                  "WHERE channel IS NOT NULL GROUP BY order_date, channel",
                  "SELECT order_date, 'all', region, SUM(net), SUM(units), SUM(n) FROM rev_fine "
                  "WHERE region IS NOT NULL GROUP BY order_date, region"]
    union = "\nUNION ALL\n".join(parts)
    return f"""SELECT order_date, channel, region,
  CAST(COALESCE(net, 0) AS DECIMAL(30,2)) AS net_revenue_eur,
  CAST(COALESCE(units, 0) AS BIGINT) AS units,
  CAST(COALESCE(n, 0) AS BIGINT) AS n_orders
FROM ({union}) AS s(order_date, channel, region, net, units, n)"""


cte("segment", _segment_sql(False), ["rev_fine"])
cte("segment_rollups", _segment_sql(True), ["rev_fine"])


def anomalies_sql(segment: str = "segment", threshold: float = 3.0) -> str:
    crit = threshold + lx.ANOMALY_CRITICAL_MARGIN
    return f"""SELECT
  CAST(order_date AS VARCHAR) || ':' || dimension || ':' || dimension_value || ':' || metric
    AS anomaly_id,
  order_date AS detected_date, dimension, dimension_value, metric,
  CAST(ROUND(value, 2) AS DECIMAL(30,2)) AS observed_value,
  CAST(ROUND(mu, 2) AS DECIMAL(30,2)) AS expected_value,
  CAST(ROUND(z, 3) AS DECIMAL(10,3)) AS deviation,
  CASE WHEN z > 0 THEN 'spike' ELSE 'drop' END AS direction,
  CASE WHEN abs(z) >= {crit} THEN 'critical' ELSE 'warning' END AS severity
FROM (
  SELECT *, (value - mu) / sigma AS z,
    CASE WHEN channel = 'all' AND region = 'all' THEN 'overall'
         WHEN region = 'all' THEN 'channel' WHEN channel = 'all' THEN 'region'
         ELSE 'channel_region' END AS dimension,
    CASE WHEN channel = 'all' AND region = 'all' THEN region
         WHEN region = 'all' THEN channel WHEN channel = 'all' THEN region
         ELSE channel || '/' || region END AS dimension_value
  FROM (
    SELECT *, AVG(value) OVER w AS mu, STDDEV_POP(value) OVER w AS sigma
    FROM (
      SELECT order_date, channel, region, 'net_revenue_eur' AS metric,
             CAST(net_revenue_eur AS DOUBLE) AS value FROM {segment}
      UNION ALL
      SELECT order_date, channel, region, 'units', CAST(units AS DOUBLE) FROM {segment})
    WINDOW w AS (PARTITION BY channel, region, metric))
  WHERE sigma > 0 AND NOT isnan(sigma))
WHERE abs(z) >= {float(threshold)}"""


cte("anomalies", anomalies_sql("segment"), ["segment"])


def weighted_hits_sql(text: str, words: list[str]) -> str:
    terms = [f"(CASE WHEN contains({text}, {q(w)}) THEN {n} ELSE 0 END)"
             for w, n in Counter(words).items()]
    return "(" + " + ".join(terms) + ")"


def any_contains_sql(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(w)})" for w in dict.fromkeys(words)) + ")"


def unicode_boundaries(pattern: str) -> str:
    """RE2 form of a pattern whose ``\\b`` must be Unicode-aware: each ``\\b``
    becomes a start/end-or-non-word-character group (fine for a match test)."""
    word = r"[^\pL\pN_]"
    out, i, first = [], 0, True
    while i < len(pattern):
        if pattern.startswith(r"\b", i):
            out.append(f"(^|{word})" if first else f"($|{word})")
            first = not first
            i += 2
        else:
            if pattern[i] == "|":
                first = True
            out.append(pattern[i])
            i += 1
    return "".join(out)
