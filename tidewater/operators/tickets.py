"""Rule-based ticket classification.

One narrow projection per ticket: ~100 ``contains`` tests over the
lower-cased text, fused into whole-stage codegen; no shuffle, no UDF.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.functions.text import any_contains, detect_language, weighted_hits
from tidewater.operators.clean import with_text

CATEGORIES = list(lx.CATEGORY_KEYWORDS)


def _hit_columns(lower_text: str) -> list[Column]:
    cols = [weighted_hits(lower_text, kws).alias(f"h_{cat}")
            for cat, kws in lx.CATEGORY_KEYWORDS.items()]
    cols += [weighted_hits(lower_text, lx.NEGATIVE_WORDS).alias("neg_hits"),
             weighted_hits(lower_text, lx.POSITIVE_WORDS).alias("pos_hits"),
             any_contains(lower_text, lx.URGENCY_CRITICAL).alias("is_critical"),
             any_contains(lower_text, lx.URGENCY_HIGH).alias("is_high")]
    return cols


def _category(best: Column) -> Column:
    expr = F.when(best <= 0, F.lit(lx.DEFAULT_CATEGORY))
    for cat in CATEGORIES:  # strict max: the first category reaching it wins
        expr = expr.when(F.col(f"h_{cat}") == best, F.lit(cat))
    return expr.otherwise(F.lit(lx.DEFAULT_CATEGORY))


def _sentiment() -> Column:
    neg, pos = F.col("neg_hits"), F.col("pos_hits")
    return (F.when(neg > pos, F.lit("negative")).when(pos > neg, F.lit("positive"))
            .otherwise(F.lit("neutral")))


def _urgency(sentiment: Column) -> Column:
    return (F.when(F.col("is_critical"), F.lit("critical"))
            .when(F.col("is_high"), F.lit("high"))
            .when(sentiment == "negative", F.lit("medium"))
            .otherwise(F.lit("low")))


def _confidence(best: Column, sentiment: Column) -> Column:
    raw = (F.lit(Decimal(lx.CONFIDENCE_BASE))
           + F.lit(Decimal(lx.CONFIDENCE_PER_HIT)) * best.cast("decimal(10,0)")
           + F.when(sentiment != "neutral", F.lit(Decimal(lx.CONFIDENCE_SENTIMENT_BONUS)))
              .otherwise(F.lit(Decimal("0.00"))))
    return F.round(F.least(F.lit(Decimal(lx.CONFIDENCE_CAP)), raw), 3).cast("decimal(4,3)")


def ticket_signals(tickets: DataFrame, key: str = "ticket_id",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Per ticket: category hit counts, sentiment hits, urgency flags, text."""
    df = with_text(tickets)
    lowered = df.select(F.col(key), *keep, F.col("text"), F.lower(F.col("text")).alias("t"))
    return lowered.select(F.col(key), *keep, F.col("text"), *_hit_columns("t"))


def classify_tickets(tickets: DataFrame, key: str = "ticket_id",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """ticket_id, category, sentiment, urgency, confidence, detected_language
    (plus any ``keep`` pass-through columns, e.g. ``run_id``)."""
    sig = ticket_signals(tickets, key, keep)
    best = F.greatest(*[F.col(f"h_{c}") for c in CATEGORIES])
    sig = sig.withColumn("best_hits", best).withColumn("sentiment", _sentiment())
    return sig.select(
        F.col(key),
        *keep,
        _category(F.col("best_hits")).alias("category"),
        F.col("sentiment"),
        _urgency(F.col("sentiment")).alias("urgency"),
        _confidence(F.col("best_hits"), F.col("sentiment")).alias("confidence"),
        detect_language(F.col("text")).alias("detected_language"))


def ticket_category(tickets: DataFrame) -> DataFrame:
    """Category and the winning hit count."""
    sig = ticket_signals(tickets)
    best = F.greatest(*[F.col(f"h_{c}") for c in CATEGORIES])
    sig = sig.withColumn("best_hits", best)
    return sig.select("ticket_id", _category(F.col("best_hits")).alias("category"),
                      F.col("best_hits").cast("int").alias("best_hits"))


def ticket_sentiment(tickets: DataFrame) -> DataFrame:
    """Sentiment from negative vs positive word hits."""
    sig = ticket_signals(tickets)
    return sig.select("ticket_id", _sentiment().alias("sentiment"),
                      F.col("neg_hits").cast("int").alias("neg_hits"),
                      F.col("pos_hits").cast("int").alias("pos_hits"))


def ticket_urgency(tickets: DataFrame) -> DataFrame:
    """Critical > high > (negative -> medium) > low."""
    sig = ticket_signals(tickets).withColumn("sentiment", _sentiment())
    return sig.select("ticket_id", _urgency(F.col("sentiment")).alias("urgency"))


def with_language(df: DataFrame, text_col: str = "text",
                  out: str = "detected_language") -> DataFrame:
    """T5 on any text column (whole text)."""
    return df.withColumn(out, detect_language(F.col(text_col)))
