"""Model-response operators: prompt batches, parsing, validation, merge,
fallback and cost accounting (E1-E11, J1-J4, U2, U3, W4, A15).

The HTTP client is outside this library. What remains is table work: build
request rows from the business tables, and merge a *responses table*
``(batch_id | keys, content)`` written by whatever called the model.

Batching at scale: rows are hashed into buckets (md5 of id and payload, so any
engine can reproduce it) whose number follows the number of rows and their bytes, so a
bucket stays as large as it is however the table or its texts grow. Copies collapse before the
payload is shuffled; batches are slices of a bucket's sorted items, split where their payload
exceeds a request's bytes.

Nothing here runs a job while a plan is built: row counts and fallback flags
are scalar subqueries of the plan that uses them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.functions.text import clamp_float, coerce_enum, detect_language, empty_if_null
from tidewater.operators.clean import with_text
from tidewater.operators.tickets import classify_tickets

BUCKET_ROWS = 4000
BUCKET_BYTES = 32 << 20      # of payload: what a task holds does not grow with the length of the texts
BATCH_BYTES = 256 << 10      # of payload in one request, unless a single text is longer

TICKET_SYSTEM = (
    "You label support tickets written in any language. Answer with one JSON object and nothing else: "
    '{"results": [{"id": text, "category": label, "sentiment": label, "urgency": label, "confidence": number}]}. '
    f"category is one of {', '.join(lx.CATEGORY_LABELS)}; sentiment one of {', '.join(lx.SENTIMENT_LABELS)}; "
    f"urgency one of {', '.join(lx.URGENCY_LABELS)}; confidence lies between 0 and 1. "
    "Give one result per ticket under its own id and leave the texts untranslated.")
REVIEW_SYSTEM = (
    "You sum up product reviews in two languages. Answer with one JSON object and nothing else: "
    '{"summary_en": English text, "summary_fr": French text}, at most 40 words each.')
LEAD_SYSTEM = (
    "You translate sales notes between English and French. Answer with one JSON object and nothing else: "
    '{"results": [{"id": text, "notes_en": English text, "notes_fr": French text}]}. '
    "Give one result per lead under its own id; keep a note that is already in the language.")

# What a response may hold, as from_json schemas: last of repeated keys wins, NaN is a number.
TICKET_RESULT = "results array<struct<id:string,category:string,sentiment:string,urgency:string,confidence:string>>"
LEAD_RESULT = "results array<struct<id:string,notes_en:string,notes_fr:string>>"
REVIEW_RESULT = "summary_en string, summary_fr string"


def key_bucket(key: Column, n_buckets: Column) -> Column:
    """Stable bucket of a string key: first 32 bits of its md5, mod n."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, n_buckets)


def bucket_count(rows: DataFrame, payload: str, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> Column:
    """Buckets for the rows of a table by their number and by their payload's bytes, as a scalar subquery."""
    size = rows.agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(bucket_rows)),
                               F.ceil(F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)) / F.lit(bucket_bytes))).alias("n")).scalar()
    return F.greatest(F.lit(1).cast("long"), size)


def _batches(df: DataFrame, key: str, payload: Column, payload_name: str, prefix: str, system: str,
             batch_size: int, n_buckets: int | None, max_bytes: int | None) -> DataFrame:
    """Items of a bucket in order of (id, md5 of the payload), ``batch_size`` at a time. Such a slice
    with more than ``max_bytes`` of payload is split further, into pieces that hold no more: an item
    that takes more than half of them is alone, the others go by the half in which the slice's
    running sum (of these) starts. No item is cut, so one larger than ``max_bytes`` stays so."""
    rows = df.select(F.col(key).cast("string").alias("id"), payload.alias(payload_name))
    buckets = bucket_count(rows, payload_name) if n_buckets is None else F.lit(n_buckets).cast("long")
    rows = rows.withColumn("bucket", key_bucket(F.concat_ws("\u0001", F.col("id"), F.col(payload_name)), buckets))
    # Copies merge before they are shuffled; sorts spill, so a task holds a bucket at most.
    items = rows.groupBy("bucket", "id", F.md5(payload_name).alias("digest")).agg(F.first(payload_name).alias(payload_name))
    in_bucket = Window.partitionBy("bucket").orderBy("id", "digest")
    items = items.withColumn("k", F.floor((F.row_number().over(in_bucket) - 1) / F.lit(batch_size)).cast("int"))
    group = ["bucket", "k"]
    if max_bytes:
        half, size = max(1, max_bytes // 2), F.octet_length(payload_name)
        in_slice = Window.partitionBy(*group).orderBy("id", "digest")
        small = F.when(size > half, 0).otherwise(size)
        items = items.withColumns({"total": F.sum(size).over(Window.partitionBy(*group)), "i": F.row_number().over(in_slice),
                                   "before": F.sum(small).over(in_slice) - small})
        piece = F.when(F.col("total") <= max_bytes, 0).when(size > half, -F.col("i")).otherwise(F.floor(F.col("before") / half))
        items = items.withColumn("piece", piece.cast("long"))
        group = [*group, "piece"]
    batch = items.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("id", "digest", payload_name))).alias("all"),
                                      *([F.when(F.max("total") > max_bytes, F.min("i").cast("string")).alias("first")] if max_bytes else []))
    names = ["bucket", "k", *(["first"] if max_bytes else [])]  # a slice that is whole has no third part
    batch = batch.withColumn("items", F.transform("all", lambda x: F.struct(x["id"].alias("id"), x[payload_name].alias(payload_name))))
    return batch.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in names]).alias("batch_id"),
        F.size("items").alias("n_items"), "items", F.lit(system).alias("system_message"),
        F.concat(F.lit(prefix), F.to_json("items")).alias("user_message"))


def _cut(text: Column, max_chars: int | None) -> Column:
    return text if max_chars is None else F.substring(text, 1, max_chars)


def build_ticket_batches(tickets: DataFrame, batch_size: int = lx.TICKETS_PER_BATCH,
                         n_buckets: int | None = None, key: str = "ticket_id",
                         max_chars: int | None = None, max_bytes: int | None = BATCH_BYTES) -> DataFrame:
    """E1 + W4: batches of <= ``batch_size`` tickets and <= ``max_bytes`` of text (a longer text is a
    batch of its own); items ``{id, text}``; user message = prefix + JSON array. Whole texts, unless ``max_chars`` asks for a cut (the original's
    calls cut at 500); copies are recognised on whole texts either way where ids differ."""
    df = with_text(tickets)
    return _batches(df, key, _cut(empty_if_null("text"), max_chars), "text", lx.TICKET_BATCH_PROMPT_PREFIX,
                    TICKET_SYSTEM, batch_size, n_buckets, max_bytes)


def build_lead_batches(leads: DataFrame, batch_size: int = lx.TICKETS_PER_BATCH,
                       n_buckets: int | None = None, max_chars: int | None = None,
                       max_bytes: int | None = BATCH_BYTES) -> DataFrame:
    """Whole lead notes (or ``max_chars`` of them) in batches of <= ``batch_size`` and <= ``max_bytes``.
    All leads are batched (the original sent only the first 40)."""
    return _batches(leads, "lead_id", _cut(empty_if_null("notes"), max_chars), "notes", lx.LEAD_BATCH_PROMPT_PREFIX,
                    LEAD_SYSTEM, batch_size, n_buckets, max_bytes)


def themes_repr(themes: Column) -> Column:
    """A themes array as the list-of-dicts text the prompt shows."""
    inner = F.transform(themes, lambda t: F.concat(
        F.lit("{'theme': '"), t["theme"], F.lit("', 'weight': "), t["weight"].cast("string"),
        F.lit("}")))
    return F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]"))


def build_review_prompts(summaries: DataFrame) -> DataFrame:
    """One user message per (product, month) with n, average and themes."""
    msg = F.format_string("Product %s (%s): %s reviews, avg rating %s/5, themes: %s.",
                          F.col("product_id"), F.col("review_window"),
                          F.col("n_reviews").cast("string"),
                          F.col("avg_rating").cast("double").cast("string"),
                          themes_repr(F.col("top_themes")))
    return summaries.select("product_id", "review_window", F.lit(REVIEW_SYSTEM).alias("system_message"),
                            msg.alias("user_message"))


def parse_response(responses: DataFrame, schema: str = TICKET_RESULT, content: str = "content") -> DataFrame:
    """The JSON object of each response: from the first ``{`` to the last ``}`` (code
    fences and prose around it are ignored). Adds ``payload`` (a struct of ``schema``, null when
    unusable) and ``is_valid``. Of repeated keys the last counts; NaN is accepted; anything
    after the object, or a value of another shape, makes the response unusable."""
    blob = F.regexp_extract(empty_if_null(content), r"(?s)\{.*\}", 0)
    # Inside an array, text after the object is an error instead of being ignored.
    struct = "struct<" + ",".join(_struct_fields(schema)) + ">"
    parsed = F.from_json(F.concat(F.lit('{"x":['), blob, F.lit("]}")), f"x array<{struct}>, bad string",
                         {"columnNameOfCorruptRecord": "bad", "allowNonNumericNumbers": "true"})
    out = responses.withColumn("payload", parsed)
    good = (F.col("payload.bad").isNull() & (F.size("payload.x") == 1) & F.get("payload.x", F.lit(0)).isNotNull() & (blob != ""))
    out = out.withColumn("is_valid", F.coalesce(good, F.lit(False)))
    return out.withColumn("payload", F.when(F.col("is_valid"), F.get("payload.x", F.lit(0))))


def _struct_fields(schema: str) -> list[str]:
    """``a string, b array<..>`` -> ``a:string`` .. (commas inside <> stay)."""
    out, depth, part = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += ch
    return [":".join(p.strip().split(" ", 1)) for p in [*out, part]]


def _parsed(responses: DataFrame, schema: str) -> DataFrame:
    """Responses parsed already pass; so one parse can serve the merge, the flag and the ledger."""
    return responses if "is_valid" in responses.columns else parse_response(responses, schema)


def _results(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """Valid responses -> one row per result object, with its position."""
    return parsed.filter("is_valid").select(*keys, F.posexplode("payload.results").alias("pos", "r"))


def _last_per_id(df: DataFrame, id_col: str, order_cols: list[str]) -> DataFrame:
    """Q11: one row per id, the last one in response order (an aggregate,
    so a repeated id never concentrates more than its own rows)."""
    others = [c for c in df.columns if c != id_col]
    order = F.struct(*[F.col(c) for c in order_cols])
    latest = df.groupBy(id_col).agg(F.max_by(F.struct(*others), order).alias("x"))
    return latest.select(id_col, "x.*")


def _asked(batches: DataFrame, id_col: str) -> DataFrame:
    return batches.select("batch_id", F.explode("items.id").alias(id_col))


def ticket_model_rows(batches: DataFrame, responses: DataFrame) -> DataFrame:
    """E5-E7 (model half): results matched to the ids their batch asked for,
    enums coerced, confidence clamped, last repeat wins."""
    res = _results(_parsed(responses, TICKET_RESULT), ["batch_id"])
    confidence = F.regexp_replace("r.confidence", '"', "")
    rows = res.select(
        "batch_id", "pos", F.col("r.id").alias("ticket_id"),
        coerce_enum(F.col("r.category"), lx.CATEGORY_LABELS, lx.RESPONSE_DEFAULTS["category"]).alias("category"),
        coerce_enum(F.col("r.sentiment"), lx.SENTIMENT_LABELS, lx.RESPONSE_DEFAULTS["sentiment"]).alias("sentiment"),
        coerce_enum(F.col("r.urgency"), lx.URGENCY_LABELS, lx.RESPONSE_DEFAULTS["urgency"]).alias("urgency"),
        clamp_float(confidence, 0.0, 1.0, lx.RESPONSE_DEFAULTS["confidence"]).cast("decimal(4,3)").alias("confidence"),
    ).filter(F.col("ticket_id").isNotNull())
    known = rows.join(_asked(batches, "ticket_id"), ["batch_id", "ticket_id"], "inner")
    return _last_per_id(known, "ticket_id", ["batch_id", "pos"]).drop("batch_id", "pos")


def batch_failures(batches: DataFrame, responses: DataFrame, keys: list[str], schema: str = TICKET_RESULT) -> DataFrame:
    """One row: ``fell_back`` when any requested call has no usable response,
    with the failing keys listed in ``failed_keys``."""
    parsed = _parsed(responses, schema).filter("is_valid").select(*keys).distinct()
    bad = batches.select(*keys).distinct().join(parsed, keys, "left_anti")
    # A count and the smallest failing key: bounded, however many calls fail.
    return bad.agg(
        (F.count(F.lit(1)) > 0).alias("fell_back"),
        F.concat(F.count(F.lit(1)).cast("string"), F.lit(" call(s), first "),
                 F.min(F.concat_ws("/", *keys))).alias("failed_keys"))


def all_answered(batches: DataFrame, responses: DataFrame, keys: list[str], schema: str) -> Column:
    """E11 decision, all-or-nothing per operation as in the original: true when every call has
    a usable response. A scalar subquery: decided inside the plan that uses it."""
    return batch_failures(batches, responses, keys, schema).select(~F.col("fell_back")).scalar()


def merge_ticket_responses(tickets: DataFrame, batches: DataFrame, responses: DataFrame,
                           *, fallback: bool = True) -> DataFrame:
    """E7 + E11: model classifications where the model answered, rules for the
    rest (J2/U2/U3); language always from the ticket text. With ``fallback``
    any failed batch reverts the whole operation to rules."""
    base = with_text(tickets)
    model = ticket_model_rows(batches, responses)
    if fallback:
        model = model.where(all_answered(batches, responses, ["batch_id"], TICKET_RESULT))
    rules = classify_tickets(base)
    given = ["category", "sentiment", "urgency", "confidence"]
    joined = rules.join(model.select("ticket_id", *[F.col(c).alias(f"m_{c}") for c in given]), "ticket_id", "left")
    answered = F.col("m_category").isNotNull()
    return joined.select(*[F.when(answered, F.col(f"m_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
                           for c in rules.columns])


def merge_review_responses(base: DataFrame, responses: DataFrame, *,
                           fallback: bool = True, max_chars: int | None = None) -> DataFrame:
    """E8 (J4): replace summary_en / summary_fr where the response carries the key (whole,
    unless ``max_chars`` asks for a cut). Responses are keyed by (product_id,
    review_window); a failed call with ``fallback`` keeps all rule rows."""
    keys = ["product_id", "review_window"]
    parsed = _parsed(responses, REVIEW_RESULT).filter("is_valid").select(
        *keys, _cut(F.col("payload.summary_en"), max_chars).alias("m_en"), _cut(F.col("payload.summary_fr"), max_chars).alias("m_fr"))
    if fallback:
        parsed = parsed.where(all_answered(base, responses, keys, REVIEW_RESULT))
    joined = base.join(parsed, keys, "left")
    return joined.select(*[
        F.coalesce(F.col("m_en"), F.col("summary_en")).alias("summary_en") if c == "summary_en"
        else F.coalesce(F.col("m_fr"), F.col("summary_fr")).alias("summary_fr")
        if c == "summary_fr" else F.col(c) for c in base.columns])


def merge_lead_responses(base: DataFrame, batches: DataFrame, responses: DataFrame, *,
                         fallback: bool = True, max_chars: int | None = None) -> DataFrame:
    """E9 (J1): replace notes_en / notes_fr where a result for a lead its batch asked for has a
    non-empty value (whole, unless ``max_chars`` asks for a cut); last duplicate id wins. With
    ``fallback`` a failed call keeps all base rows."""
    res = _results(_parsed(responses, LEAD_RESULT), ["batch_id"])
    rows = res.select("batch_id", "pos", F.col("r.id").alias("lead_id"),
                      _cut(F.nullif(F.col("r.notes_en"), F.lit("")), max_chars).alias("m_en"),
                      _cut(F.nullif(F.col("r.notes_fr"), F.lit("")), max_chars).alias("m_fr")
                      ).filter(F.col("lead_id").isNotNull())
    rows = rows.join(_asked(batches, "lead_id"), ["batch_id", "lead_id"], "inner")
    latest = _last_per_id(rows, "lead_id", ["batch_id", "pos"]).select("lead_id", "m_en", "m_fr")
    if fallback:
        latest = latest.where(all_answered(batches, responses, ["batch_id"], LEAD_RESULT))
    joined = base.join(latest, "lead_id", "left")
    return joined.select(*[
        F.coalesce(F.col("m_en"), F.col("notes_en")).alias("notes_en") if c == "notes_en"
        else F.coalesce(F.col("m_fr"), F.col("notes_fr")).alias("notes_fr")
        if c == "notes_fr" else F.col(c) for c in base.columns])


def fallback_status(operation: str, batches: DataFrame, responses: DataFrame,
                    keys: list[str], schema: str = TICKET_RESULT) -> DataFrame:
    """E11 ledger side: ``(operation, fell_back, error)`` for one operation."""
    flags = batch_failures(batches, responses, keys, schema)
    return flags.select(
        F.lit(operation).alias("operation"), "fell_back",
        F.when(F.col("fell_back"), F.concat(F.lit(f"{operation}: no usable response for "),
                                            F.col("failed_keys"))).alias("error"))


def ticket_call_log(run_id: str, provider: str, n_results: DataFrame) -> DataFrame:
    """The original's accounting of one ticket operation: a count of ``results // 5 + 1`` calls,
    one of them billed. For ``estimate_cost(mode="reference")``."""
    return n_results.agg((F.floor(F.count(F.lit(1)) / 5) + 1).cast("int").alias("n_calls")).select(
        F.lit(run_id).alias("run_id"), F.lit(provider).alias("provider"), "n_calls", F.lit(1).alias("billed_calls"))


def estimate_cost(call_log: DataFrame, *, tokens_per_call: int = lx.TOKENS_PER_CALL,
                  mode: str = "per_call") -> DataFrame:
    """E10 + A15: per run, calls and USD estimate = round(calls * tokens / 1000
    * rate, 6); unknown provider -> rate 0. ``call_log``: run_id, provider,
    n_calls, and for ``mode="reference"`` ``billed_calls``: what the original
    bills instead of the calls it counts (see ticket_call_log)."""
    if mode not in ("per_call", "reference"):
        raise ValueError("mode must be 'per_call' or 'reference'")
    rate_map = F.create_map(*[x for k, v in lx.RATE_PER_1K_TOKENS.items()
                              for x in (F.lit(k), F.lit(str(v)).cast("decimal(10,4)"))])
    rate = F.coalesce(F.try_element_at(rate_map, F.col("provider")),
                      F.lit(0).cast("decimal(10,4)"))
    billed = F.col("billed_calls") if mode == "reference" else F.col("n_calls")
    cost = F.round(billed.cast("decimal(18,0)") * F.lit(tokens_per_call) / F.lit(1000) * rate, 6)
    return (call_log.withColumn("cost", cost).groupBy("run_id")
            .agg(F.sum("n_calls").cast("long").alias("llm_calls"),
                 F.sum("cost").cast("decimal(18,6)").alias("llm_cost_estimate")))
