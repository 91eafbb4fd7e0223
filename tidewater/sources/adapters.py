"""Adapters: the driver's TPC-H-style tables -> the five business sources.

Each adapter returns the *source* form of one business table: every column a
string, as a CSV reader would hand it over (money as ``123.45``, dates as ISO
text), with a deterministic sprinkle of null tokens and junk so the cleaning
operators have real work. Every row of the output derives from a row of a
driver table, so the work grows with the tables.

The identical recipes are written in SQL in ``tidewater.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.functions import sqlexpr as sx
from tidewater.sources import vocabulary as vocab
from tidewater.sources.tables import read_table


def pick(values: list[str], index: Column | str) -> Column:
    """``values[index]`` for a 0-based integer column or SQL expression."""
    if isinstance(index, str):
        return F.expr(sx.pick(values, index))
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey -> region name. No join hints: the planner broadcasts a side only
    when its estimated size (from file statistics) is below
    ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks the measured
    size at runtime, keeping a sort-merge join beyond it. nation/region are
    a few KB and broadcast; customer broadcasts only while it is small."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (cust.join(nr, cust.c_nationkey == nr.n_nationkey)
            .select(F.col("c_custkey"), F.col("r_name")))


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders (+ lineitem sums, + customer region) as the ``orders`` source."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"),
        F.col("l_quantity").cast("int").alias("qty"))
    # Pre-aggregate the largest table on its key before any join.
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("price").cast("decimal(18,2)").alias("gross"),
        F.sum(F.round(F.col("price") * F.col("disc"), 2)).cast("decimal(18,2)").alias("discount"),
        F.sum("qty").cast("long").alias("units"))
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    j = (o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
         .join(_geo(spark, sf_dir), o.o_custkey == F.col("c_custkey"), "left"))
    return j.selectExpr(
        "concat('ORD-', CAST(o_orderkey AS STRING)) AS order_id",
        "concat('C-', CAST(o_custkey AS STRING)) AS customer_id",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date",
        "CASE o_orderstatus WHEN 'F' THEN 'web' WHEN 'O' THEN 'mobile' ELSE 'marketplace' END"
        " AS channel",
        "r_name AS region",
        "CASE o_orderkey % 10 WHEN 7 THEN 'USD' WHEN 8 THEN 'GBP' ELSE 'EUR' END AS currency",
        "CASE WHEN o_orderkey % 9973 = 5 THEN CAST(gross + 2345678901234.5 AS STRING) "
        "WHEN o_orderkey % 997 = 6 THEN concat(CAST(gross AS STRING), '5') "
        "WHEN o_orderkey % 1009 = 8 THEN '1e30' ELSE CAST(gross AS STRING) END AS gross_revenue_eur",
        "CASE WHEN o_orderkey % 499 = 17 THEN 'abc' WHEN o_orderkey % 499 = 18 "
        "THEN concat(CAST(discount AS STRING), '4') ELSE CAST(discount AS STRING) END"
        " AS discount_eur",
        "CAST(gross - discount AS STRING) AS net_revenue_eur",
        "CASE WHEN o_orderkey % 97 = 3 THEN 'NA' WHEN o_orderkey % 991 = 4 THEN '3000000000' "
        "WHEN o_orderkey % 991 = 9 THEN '99999999999999999999' ELSE CAST(units AS STRING) END AS units",
    )


def _ticket_arrays() -> tuple[list[str], list[str]]:
    cats = list(vocab.TICKET_SUBJECTS)
    subjects = [s for c in cats for lang in lx.TICKET_LANGS for s in vocab.TICKET_SUBJECTS[c][lang]]
    descs = [vocab.TICKET_DESCRIPTIONS[c][lang] for c in cats for lang in lx.TICKET_LANGS]
    return subjects, descs


def tickets_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> ``support_tickets`` source (text from the ticket templates)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    lang_i = "(CASE WHEN event_id % 20 < 11 THEN 0 ELSE 1 END)"
    subjects, descs = _ticket_arrays()
    subject = sx.pick(subjects, f"(event_id % 6) * 8 + {lang_i} * 4 + (event_id div 6) % 4")
    desc = sx.fill(sx.pick(descs, f"(event_id % 6) * 2 + {lang_i}"), {
        "amt": "20 + user_id % 381", "exp": "10 + event_id % 291",
        "oid": "50000 + event_id % 50000", "dt": "date_format(ts, 'yyyy-MM-dd')",
        "delay": "2 + event_id % 8"})
    sla_tokens = ["true", "false", "True", "1", "YES", "no", "NA", "false", "false"]
    return ev.selectExpr(
        "concat('TKT-', CAST(event_id AS STRING)) AS ticket_id",
        "concat('C-', CAST(user_id AS STRING)) AS customer_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS created_at",
        f"{sx.pick(lx.TICKET_CHANNELS, 'user_id % 4')} AS channel",
        f"{sx.pick(lx.TICKET_LANGS, lang_i)} AS language",
        f"CASE WHEN event_id % 13 = 5 THEN concat('  \\t', {subject}, '\\n ') "
        f"ELSE {subject} END AS subject",
        f"CASE WHEN event_id % 41 = 7 THEN 'N/A' ELSE {desc} END AS description",
        f"{sx.pick(['open', 'pending', 'solved'], 'event_id % 3')} AS status",
        f"{sx.pick(sla_tokens, 'event_id % 9')} AS sla_breached",
    )


def reviews_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents (+ labels) -> ``product_reviews`` source; body = the whole text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("l_doc_id"), "quality", "toxic")
    j = docs.join(labels, docs.doc_id == labels.l_doc_id, "left")
    did = F.col("doc_id")
    rating = (F.when(F.col("toxic") == 1, F.lit(1))
              .when(F.col("quality") == 1, 4 + did % 2)
              .when(F.col("quality") == 0, 1 + did % 2)
              .otherwise(F.lit(3)))
    tl = F.when(F.col("lang") == "fr", F.lit("fr")).otherwise(F.lit("en"))
    t = vocab.REVIEW_TITLES
    title = (F.when((rating >= 4) & (tl == "en"), pick(t["positive"]["en"], did % 4))
             .when(rating >= 4, pick(t["positive"]["fr"], did % 4))
             .when((rating == 3) & (tl == "en"), pick(t["neutral"]["en"], did % 2))
             .when(rating == 3, pick(t["neutral"]["fr"], did % 2))
             .when(tl == "en", pick(t["negative"]["en"], did % 2))
             .otherwise(pick(t["negative"]["fr"], did % 2)))
    created = F.date_add(F.lit("2024-01-01").cast("date"), (did % 90).cast("int"))
    return j.select(
        F.concat(F.lit("REV-"), did.cast("string")).alias("review_id"),
        F.col("source").alias("product_id"),
        F.concat(F.lit("Product "), F.col("source")).alias("product_name"),
        F.date_format(created, "yyyy-MM-dd'T'HH").alias("created_at"),
        F.when(F.col("quality").isNull() & (did % 23 == 4), F.lit("N/A"))
         .otherwise(rating.cast("string")).alias("rating"),
        F.col("lang").alias("language"),
        title.alias("title"),
        F.col("text").alias("body"),
        F.when(did % 5 < 3, F.lit("true")).otherwise(F.lit("false")).alias("verified"),
    )


def web_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events aggregated per (day, page, country, device) -> ``web_analytics``."""
    ev = read_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    keyed = ev.select(
        F.col("ts").cast("date").alias("d"),
        F.concat(F.lit("/"), F.col("event_type")).alias("page_path"),
        pick(lx.REGIONS, F.col("user_id") % 4).alias("country"),
        pick(lx.WEB_DEVICES, F.col("user_id") % 3).alias("device"),
        F.col("value"))
    agg = keyed.groupBy("d", "page_path", "country", "device").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.floor("value")).cast("long").alias("pv"),
        F.min("value").alias("vmin"),
        F.max("value").alias("vmax"))
    return agg.select(
        F.col("d").cast("string").alias("event_date"), "page_path", "country", "device",
        F.col("n").cast("string").alias("sessions"),
        F.when(F.col("n") % 11 == 4, F.lit("NA"))
         .when(F.col("n") % 13 == 6, (F.col("pv") + 3000000000).cast("string"))
         .when(F.col("n") % 17 == 7, F.lit("1e25")).otherwise(F.col("pv").cast("string"))
         .alias("pageviews"),
        F.col("vmin").cast("decimal(10,2)").cast("string").alias("bounce_rate"),
        F.col("vmax").cast("decimal(10,2)").cast("string").alias("avg_session_sec"),
    )


def leads_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> ``crm_leads`` source (notes from the lead-note templates)."""
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    templates = vocab.LEAD_NOTES["en"] + vocab.LEAD_NOTES["fr"]
    notes = sx.fill(sx.pick(templates, "(c_custkey % 2) * 5 + (c_custkey div 2) % 5"), {
        "role": sx.pick(vocab.LEAD_ROLES, "(c_custkey div 3) % 5"),
        "src": sx.pick(lx.LEAD_SOURCES, "(c_custkey div 5) % 4"),
        "comp": sx.pick(vocab.LEAD_COMPETITORS, "(c_custkey div 7) % 6"),
        "sz": sx.pick(vocab.LEAD_SIZES, "(c_custkey div 11) % 8")})
    value = "CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 7 AS DECIMAL(12,2))"
    return cust.selectExpr(
        "concat('LD-', CAST(c_custkey AS STRING)) AS lead_id",
        "c_name AS company_name",
        "c_mktsegment AS industry",
        f"{sx.pick(lx.REGIONS, 'c_nationkey % 4')} AS region",
        "date_format(date_add(DATE'2024-01-01', CAST(c_custkey % 60 AS INT)), "
        "\"yyyy-MM-dd'T'HH\") AS created_at",
        f"{sx.pick(lx.LEAD_SOURCES, 'c_custkey % 4')} AS source",
        f"{sx.pick(lx.LEAD_STATUSES, '(c_custkey div 4) % 5')} AS status",
        f"CASE WHEN c_custkey % 31 = 9 THEN 'NA' WHEN c_custkey % 211 = 7 THEN '123456789012.345' ELSE CAST({value} AS STRING) END AS est_value_eur",
        f"CASE WHEN c_custkey % 37 = 11 THEN '' ELSE {notes} END AS notes",
    )


SOURCE_ADAPTERS = {
    "orders": orders_source,
    "support_tickets": tickets_source,
    "product_reviews": reviews_source,
    "web_analytics": web_source,
    "crm_leads": leads_source,
}


def run_events_source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """events -> (task states, ledger event rows) of one pipeline run per day.

    A run is a calendar day of events; its tasks are the event types of that
    day; a task fails when it holds an ``error`` event with value >= 300.
    Ledger rows: an opening and a closing row per attempt; two runs in three
    were tried twice, first with the opposite outcome.
    """
    from tidewater.sinks.warehouse import closing_rows, opening_rows

    ev = read_table(spark, sf_dir, "events").select("ts", "event_type", "value")
    run_id = F.concat(F.lit("run-"), F.col("ts").cast("date").cast("string"))
    tasks = (ev.groupBy(run_id.alias("run_id"), F.col("event_type").alias("task_id"))
             .agg(F.max(F.when(F.col("event_type") == "error", F.col("value"))).alias("worst"),
                  F.count(F.lit(1)).alias("n_events"),
                  F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
             .select("run_id", "task_id", "n_events", "first_ts", "last_ts",
                     F.when(F.col("worst") >= 300, F.lit("failed")).otherwise(F.lit("success"))
                     .alias("state")))
    runs = tasks.groupBy("run_id").agg(
        F.min("first_ts").alias("started_at"), F.max("last_ts").alias("finished_at"),
        F.sum("n_events").alias("rows_extracted"),
        F.sum(F.when(F.col("task_id") != "error", F.col("n_events")).otherwise(0))
         .alias("rows_enriched"),
        F.bool_or(F.col("state") == "failed").alias("failed"))
    runs = runs.withColumn("last", F.when(F.substring("run_id", -2, 2).cast("int") % 3 == 2, F.lit(1)).otherwise(F.lit(2)))
    attempts = runs.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.col("last"))))
    # An attempt before the last ended the other way round.
    failed = F.when(F.col("attempt") == F.col("last"), F.col("failed")).otherwise(~F.col("failed"))
    attempts = attempts.withColumn("failed", failed)
    opened = attempts.select("run_id", "attempt", "started_at", F.lit("mock").alias("enrichment_mode"))
    ok = ~F.col("failed")
    closed = attempts.select(
        "run_id", "attempt", "finished_at", F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.lit(0).alias("llm_calls"), F.lit(0).alias("llm_cost_estimate"), "rows_extracted",
        F.col("rows_extracted").alias("rows_loaded"), "rows_enriched",
        F.when(ok, F.concat(F.lit("reports/run_"), F.col("run_id"), F.lit(".pdf"))).alias("report_path"),
        ok.alias("slack_sent"), F.when(~ok, F.lit("Upstream task failed")).alias("error"))
    return tasks, opening_rows(opened).unionByName(closing_rows(closed))


# ── synthetic model responses (deterministic, derived from the batches) ────
RESPONSE_CATEGORIES = ["billing", "Shipping", "bug", "Feature Request", "account", "spam", "other"]
RESPONSE_SENTIMENTS = ["positive", "neutral", "negative", "angry"]
RESPONSE_URGENCIES = ["low", "Medium", "high", "critical", "urgent"]
RESPONSE_CONFIDENCES = ["0.8", '"high"', "1.7", "0.456", "-0.2", "NaN"]
DECOY = '"category": "decoy", '  # a key that is given again: the last one counts
RESPONSE_PROVIDERS = ["nvidia", "ollama", "anthropic", "openai-compatible", "other"]


def _n_of(id_col: Column) -> Column:
    return F.regexp_extract(id_col, r"(\d+)$", 1).cast("long")


def ticket_responses_source(batches: DataFrame, broken: bool = False) -> DataFrame:
    """One response per ticket batch. Results cover most items with messy
    labels; some items are skipped, some ids repeated, unknown or missing; the
    JSON is plain, fenced or wrapped in prose. ``broken`` adds empty and
    non-JSON responses (any of which makes the whole operation fall back)."""
    items = batches.select("batch_id", F.inline("items"))
    n = _n_of(F.col("id"))

    def obj(id_part: Column, cat_i: Column) -> Column:
        return F.concat(F.lit("{"), id_part, F.when(n % 29 == 0, F.lit(DECOY)).otherwise(F.lit("")), F.lit('"category": "'),
                        pick(RESPONSE_CATEGORIES, cat_i), F.lit('", "sentiment": "'),
                        pick(RESPONSE_SENTIMENTS, n % 4), F.lit('", "urgency": "'),
                        pick(RESPONSE_URGENCIES, n % 5), F.lit('", "confidence": '),
                        pick(RESPONSE_CONFIDENCES, n % 6), F.lit("}"))

    own = F.concat(F.lit('"id": "'), F.col("id"), F.lit('", '))
    per_item = F.nullif(F.concat_ws(
        ", ",
        F.when(n % 11 != 3, F.when(n % 17 == 0, obj(F.lit(""), n % 7)).otherwise(obj(own, n % 7))),
        F.when(n % 19 == 0, obj(own, F.lit(4))),
        F.when(n % 13 == 0, obj(F.concat(F.lit('"id": "UNKNOWN-'), F.col("id"), F.lit('", ')),
                                F.lit(0)))), F.lit(""))
    objs = items.select("batch_id", "id", per_item.alias("o"))
    per_batch = objs.groupBy("batch_id").agg(F.sort_array(F.collect_list(
        F.struct("id", "o"))).alias("os"))
    body = F.concat(F.lit('{"results": ['),
                    F.array_join(F.transform("os", lambda x: x["o"]), ", "), F.lit("]}"))
    style = F.pmod(F.conv(F.substring(F.md5("batch_id"), 1, 2), 16, 10).cast("int"), F.lit(4))
    content = (F.when(style == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
               .when(style == 2, F.concat(F.lit("Here are the results: "), body,
                                          F.lit(" Let me know if you need more.")))
               .otherwise(body))
    if broken:
        content = (F.when(style == 3, F.lit(""))
                   .when(F.substring(F.md5("batch_id"), 1, 1) == "0", F.lit("Sorry, no JSON"))
                   .otherwise(content))
    return per_batch.select("batch_id", content.alias("content"))


def review_responses_source(summaries: DataFrame) -> DataFrame:
    """One response per (product, month); some lack summary_fr or are prose."""
    k = F.concat_ws(" ", "product_id", "review_window")
    h = F.pmod(F.conv(F.substring(F.md5(k), 1, 2), 16, 10).cast("int"), F.lit(3))
    en = F.concat(F.lit('"summary_en": "Model summary of '), k, F.lit('"'))
    fr = F.concat(F.lit('"summary_fr": "Résumé du modèle pour '), k, F.lit('"'))
    content = (F.when(h == 0, F.concat(F.lit("{"), en, F.lit(", "), fr, F.lit("}")))
               .when(h == 1, F.concat(F.lit("```json\n{"), en, F.lit("}\n```")))
               .otherwise(F.concat(F.lit("Voici: {"), fr, F.lit(", "), en, F.lit("} fin"))))
    return summaries.select("product_id", "review_window", content.alias("content"))


def lead_responses_source(batches: DataFrame, broken: bool = False) -> DataFrame:
    """One response per lead batch: translated notes for most leads, empty
    values for some (kept from the rules), a repeated id for a few, and in every
    batch a result for a lead it was not asked for. ``broken`` leaves one call empty."""
    items = batches.select("batch_id", F.inline("items"))
    n = _n_of(F.col("id"))
    en = F.when(n % 5 == 1, F.lit("")).otherwise(F.concat(F.lit("EN note for "), F.col("id")))
    fr = F.when(n % 7 == 2, F.lit("")).otherwise(F.concat(F.lit("Note FR pour "), F.col("id")))
    one = F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "notes_en": "'), en,
                   F.lit('", "notes_fr": "'), fr, F.lit('"}'))
    again = F.when(n % 23 == 0, F.concat(F.lit('{"id": "'), F.col("id"),
                                          F.lit('", "notes_en": "Repeated note", "notes_fr": ""}')))
    per_item = F.concat_ws(", ", one, again)
    per_batch = items.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("id", per_item.alias("o")))).alias("os"))
    foreign = F.lit(', {"id": "LD-1", "notes_en": "not asked", "notes_fr": "pas demandé"}')
    asked_one = F.exists("os", lambda x: x["id"] == "LD-1")
    content = F.concat(F.lit('{"results": ['), F.array_join(F.transform("os", lambda x: x["o"]), ", "),
                       F.when(asked_one, F.lit("")).otherwise(foreign), F.lit("]}"))
    if broken:
        content = F.when(F.col("batch_id") == "0-0", F.lit("no answer")).otherwise(content)
    return per_batch.select("batch_id", content.alias("content"))


def call_log_source(batches: DataFrame) -> DataFrame:
    """One model call per batch; the run follows the batch's number in its bucket, the provider
    the run. ``billed_calls``: every second call."""
    k = F.split("batch_id", "-").getItem(1).cast("int")
    return batches.select(F.concat(F.lit("run-"), (k % 12).cast("string")).alias("run_id"),
                          pick(RESPONSE_PROVIDERS, k % 12 % 5).alias("provider"),
                          F.lit(1).alias("n_calls"), (k % 2).alias("billed_calls"))
