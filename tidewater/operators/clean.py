"""Cleaning and typing of the five sources.

Narrow, shuffle-free projections: ``try_cast`` for every string -> number
(ANSI mode stays on), ``coalesce`` for defaults. Rows without a required value
are kept apart with a reason (``rejected_rows``), never dropped unseen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.functions.text import empty_if_null, strip_all

MONEY_IN = "decimal(26,6)"  # as read: rounded once, at the end
MONEY = "decimal(24,2)"
REJECT = "reject_reason"


def normalize_money(df: DataFrame, cols: list[str], dtype: str = MONEY_IN) -> DataFrame:
    """Listed money columns that exist -> decimal; unparseable -> null."""
    present = set(df.columns)
    return df.select(*[
        F.col(c).cast("string").try_cast(dtype).alias(c) if c in cols and c in present else F.col(c)
        for c in df.columns])


def _whole(c: Column) -> Column:
    """Number text -> bigint toward zero; 0 where it is no number, null where it does not fit."""
    text = c.cast("string")
    number = text.try_cast("double")
    return (F.when(number.isNull() | F.isnan(number), F.lit(0).cast("bigint"))
            .otherwise(text.try_cast("decimal(38,6)").try_cast("bigint")))


WIDE = "wide_"


def _fitting(name: str, dtype: str) -> tuple[Column, Column]:
    """An optional number: (its value, null where the source has none; whether it is a number that
    ``dtype`` can't keep, under the name ``wide_<name>``)."""
    text = F.col(name).cast("string")
    value, number = text.try_cast(dtype), text.try_cast("double")
    return value.alias(name), (value.isNull() & number.isNotNull() & ~F.isnan(number)).alias(WIDE + name)


def _judged(df: DataFrame, required: list[str], wide: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``reject_reason``: the first required column that is null, then the first optional one whose
    number doesn't fit (``wide_<name>``, dropped here), else null."""
    reason = F.lit(None).cast("string")
    for c in reversed(wide):
        reason = F.when(F.col(WIDE + c), F.lit(c)).otherwise(reason)
    for c in reversed(required):
        reason = F.when(F.col(c).isNull(), F.lit(c)).otherwise(reason)
    return df.withColumn(REJECT, reason).drop(*[WIDE + c for c in wide])


def judge_orders(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """C2 with every row: money typed, net := round(gross - discount, 2) (rounded once), units
    null -> 0; ``reject_reason`` names what a row lacks, a value too large to keep included.
    Here and below, columns named in ``carry`` pass through."""
    df = normalize_money(df, ["gross_revenue_eur", "discount_eur"])
    return _judged(df.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("order_date").cast("string").try_cast("date").alias("order_date"),
        "channel", "region", "currency", "gross_revenue_eur", "discount_eur",
        F.round(F.col("gross_revenue_eur") - F.col("discount_eur"), 2).cast(MONEY)
         .alias("net_revenue_eur"),
        _whole(F.col("units")).alias("units"), *carry),
        ["order_id", "order_date", "channel", "region", "net_revenue_eur", "units"])


def clean_orders(df: DataFrame) -> DataFrame:
    """The accepted rows of judge_orders."""
    return judge_orders(df).where(F.col(REJECT).isNull()).drop(REJECT)


def judge_tickets(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """C3 with every row: subject/description null -> '' and stripped; ``text`` helper column;
    sla_breached true only for true / 1 / yes (any case). No ticket is rejected."""
    subject = strip_all(empty_if_null("subject"))
    desc = strip_all(empty_if_null("description"))
    sla = F.lower(F.col("sla_breached").cast("string")).isin(lx.TRUE_TOKENS)
    return _judged(df.select(
        "ticket_id", "customer_id",
        F.col("created_at").cast("string").try_cast("timestamp_ntz").alias("created_at"),
        "channel", "language",
        subject.alias("subject"), desc.alias("description"), "status",
        F.coalesce(sla, F.lit(False)).alias("sla_breached"),
        strip_all(F.concat(subject, F.lit(". "), desc)).alias("text"), *carry), [])


def clean_tickets(df: DataFrame) -> DataFrame:
    """The rows of judge_tickets."""
    return judge_tickets(df).drop(REJECT)


def judge_reviews(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """C4 with every row: title/body null -> '' stripped, ``text`` helper, rating integer.

    A fractional rating fails the whole load in the original; here the row is
    rejected like the other rows without a required value.
    """
    title = strip_all(empty_if_null("title"))
    body = strip_all(empty_if_null("body"))
    r = F.col("rating").cast("string").try_cast("double")
    rating = F.when(r == F.floor(r), r.try_cast("int"))
    verified = F.lower(F.col("verified").cast("string")).isin(lx.TRUE_TOKENS)
    return _judged(df.select(
        "review_id", "product_id", "product_name",
        F.col("created_at").cast("string").try_cast("timestamp_ntz").alias("created_at"),
        rating.alias("rating"), "language",
        title.alias("title"), body.alias("body"),
        F.coalesce(verified, F.lit(False)).alias("verified"),
        strip_all(F.concat(title, F.lit(". "), body)).alias("text"), *carry),
        ["review_id", "product_id", "rating"])


def clean_reviews(df: DataFrame) -> DataFrame:
    """C4: the accepted rows of judge_reviews."""
    return judge_reviews(df).where(F.col(REJECT).isNull()).drop(REJECT)


def judge_web(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """C5 with every row: sessions/pageviews whole numbers (no number -> 0), rates numeric
    (null where the source has none); a row without a key or with a count or rate too large to
    keep is rejected."""
    return _judged(df.select(
        F.col("event_date").cast("string").try_cast("date").alias("event_date"),
        "page_path", "country", "device",
        _whole(F.col("sessions")).alias("sessions"),
        _whole(F.col("pageviews")).alias("pageviews"),
        *_fitting("bounce_rate", "decimal(10,2)"), *_fitting("avg_session_sec", "decimal(10,2)"), *carry),
        ["event_date", "page_path", "country", "device", "sessions", "pageviews"], ("bounce_rate", "avg_session_sec"))


def clean_web(df: DataFrame) -> DataFrame:
    """The accepted rows of judge_web."""
    return judge_web(df).where(F.col(REJECT).isNull()).drop(REJECT)


def judge_leads(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """C6 with every row: notes null -> '' stripped; est_value_eur numeric (null where the source has
    none); a row whose value is too large to keep is rejected."""
    value, wide = _fitting("est_value_eur", MONEY_IN)
    return _judged(df.select(
        "lead_id", "company_name", "industry", "region",
        F.col("created_at").cast("string").try_cast("timestamp_ntz").alias("created_at"),
        "source", "status",
        F.round(value, 2).cast(MONEY).alias("est_value_eur"),
        strip_all(empty_if_null("notes")).alias("notes"), wide, *carry), [], ("est_value_eur",))


def clean_leads(df: DataFrame) -> DataFrame:
    """The accepted rows of judge_leads."""
    return judge_leads(df).where(F.col(REJECT).isNull()).drop(REJECT)


CLEANERS = {
    "orders": clean_orders,
    "support_tickets": clean_tickets,
    "product_reviews": clean_reviews,
    "web_analytics": clean_web,
    "crm_leads": clean_leads,
}


# (judge, key columns of the reject table) of each source.
JUDGES = {
    "orders": (judge_orders, ["order_id"]),
    "support_tickets": (judge_tickets, ["ticket_id"]),
    "product_reviews": (judge_reviews, ["review_id"]),
    "web_analytics": (judge_web, ["event_date", "page_path", "country", "device"]),
    "crm_leads": (judge_leads, ["lead_id"]),
}
NEVER_REJECTED = ["support_tickets"]
ACCEPTED, REJECTED, UNREADABLE = "accepted", "rejected", "unreadable"
OUTCOMES = {ACCEPTED, REJECTED, UNREADABLE}


def judged_rows(df: DataFrame, name: str, corrupt: str | None = None) -> DataFrame:
    """Every row of a source, typed, with ``reject_reason``, ``outcome`` and ``raw_row``: accepted, rejected
    (with its reason) or unreadable (``corrupt`` holds the raw row, which ``raw_row`` keeps)."""
    judge, _ = JUDGES[name]
    raw = F.col(corrupt) if corrupt else F.lit(None).cast("string")
    rows = judge(df.withColumn("raw_row", raw), carry=("raw_row",))
    outcome = F.when(F.col("raw_row").isNotNull(), UNREADABLE).when(F.col(REJECT).isNotNull(), REJECTED).otherwise(ACCEPTED)
    return rows.withColumn("outcome", outcome)


def rejects_of(rows: DataFrame, name: str) -> DataFrame:
    """The reject table's rows from the written ``judged_rows`` of a source (see rejected_rows), the
    unreadable ones with their raw text."""
    _, keys = JUDGES[name]
    typed = [c for c in rows.columns if c not in (REJECT, "text", "outcome", "raw_row", "loaded_at")]
    unreadable = F.col("outcome") == UNREADABLE
    cases = F.when(unreadable, F.lit("fields do not match the header")).when(F.col("outcome") == REJECTED, F.col(REJECT))
    table = F.lit(name)
    if name == "product_reviews":
        undated = (F.col("outcome") == ACCEPTED) & F.col("created_at").isNull()
        table, cases = F.when(undated, "review_summaries").otherwise(table), cases.when(undated, "created_at")
    return rows.select(table.alias("table"), F.when(unreadable, F.col(keys[0]).cast("string")).otherwise(F.concat_ws("|", *keys)).alias("row_key"),
                       cases.alias("reason"), F.when(unreadable, F.col("raw_row")).otherwise(F.to_json(F.struct(*typed))).alias("row")
                       ).where(F.col("reason").isNotNull())


def rejected_rows(sources: dict[str, DataFrame]) -> DataFrame:
    """Every row that cleaning or summarising leaves out: ``table``, ``row_key``, ``reason`` and
    the typed row as JSON. An accepted review without a timestamp has no month and is listed
    under ``review_summaries``. Sources without a required value reject nothing."""
    parts = []
    for name, df in sources.items():
        if name in NEVER_REJECTED:
            continue
        judge, keys = JUDGES[name]
        rows = judge(df)
        checks = [(name, rows.where(F.col(REJECT).isNotNull()), F.col(REJECT))]
        if name == "product_reviews":
            checks.append(("review_summaries", rows.where(F.col(REJECT).isNull() & F.col("created_at").isNull()), F.lit("created_at")))
        for table, bad, reason in checks:
            kept = [c for c in rows.columns if c not in (REJECT, "text")]
            parts.append(bad.select(F.lit(table).alias("table"), F.concat_ws("|", *keys).alias("row_key"),
                                    reason.alias("reason"), F.to_json(F.struct(*kept)).alias("row")))
    if not parts:
        raise ValueError("no source that can reject rows")
    return reduce(DataFrame.unionByName, parts)


def to_eur(orders: DataFrame, rates: dict[str, str] | None = None) -> DataFrame:
    """Convert money columns to EUR by ``currency`` (opt-in; the original
    declares the rates but never applies them). Unknown currency -> null, and so an amount
    that doesn't fit (the checks of required columns name such rows).

    The rate table is a literal map folded into the projection: no join.
    """
    rates = rates or lx.FX_TO_EUR
    rate_map = F.create_map(*[x for k, v in rates.items()
                              for x in (F.lit(k), F.lit(v).cast("decimal(10,4)"))])
    rate = F.try_element_at(rate_map, F.col("currency"))
    money = ["gross_revenue_eur", "discount_eur", "net_revenue_eur"]
    return orders.select(*[
        F.round(F.col(c) * rate, 2).try_cast(MONEY).alias(c) if c in money else F.col(c)
        for c in orders.columns])


def with_text(df: DataFrame) -> DataFrame:
    """The text an enricher reads: existing ``text``, else subject + '. ' +
    description, else title + '. ' + body, else ''. Nulls -> '', not stripped."""
    cols = set(df.columns)
    if "text" in cols:
        t = empty_if_null("text")
    elif {"subject", "description"} <= cols:
        t = F.concat(empty_if_null("subject"), F.lit(". "), empty_if_null("description"))
    elif {"title", "body"} <= cols:
        t = F.concat(empty_if_null("title"), F.lit(". "), empty_if_null("body"))
    else:
        t = F.lit("")
    return df.withColumn("text", t)


def leads_view(leads_enriched: DataFrame, lang: str = "en") -> DataFrame:
    """Dashboard lead table in one language."""
    if lang not in ("en", "fr"):
        raise ValueError("lang must be 'en' or 'fr'")
    return leads_enriched.select("lead_id", "company_size_band", "lead_score",
                                 F.col(f"notes_{lang}").alias("notes"))
