"""Review summarisation per (product, month).

Plan: (1) one aggregate per (product, month) yields n_reviews, avg_rating and
the eight theme counts; the top-5 themes are then a per-row sort of eight
numbers — no second shuffle. (2) one aggregate per (product, month, body
hash) yields the body's count and first timestamp in each language scope (en, fr,
all), so review rows are shuffled once, without their texts. (3) a rank window per
(product, month, scope) keeps the candidates; Spark plans it with a partial group
limit before the shuffle, so a hot group never ships more than a few rows per map
task. (4) both sides join on (product, month).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.functions import sqlexpr as sx
from tidewater.functions.text import empty_if_null
from tidewater.schemas import THEME_STRUCT
from tidewater.sinks.commits import matching

THEMES = list(lx.THEME_KEYWORDS)
SCOPES = ["en", "fr"]
GROUP = ["product_id", "review_window"]


def _review_rows(reviews: DataFrame) -> DataFrame:
    cols = set(reviews.columns)
    if {"title", "body"} <= cols:  # one form, whether or not a helper ``text`` column is there
        text = F.concat(empty_if_null("title"), F.lit(" "), empty_if_null("body"))
    elif "text" in cols:
        text = empty_if_null("text")
    elif "body" in cols:
        text = empty_if_null("body")
    else:
        text = F.lit("")
    body = empty_if_null("body") if "body" in cols else F.lit("")
    lang = F.col("language") if "language" in cols else F.lit(None).cast("string")
    # Rows without a timestamp have no month; clean.rejected_rows lists them.
    return reviews.filter(F.col("created_at").isNotNull()).select(
        "product_id",
        F.date_format("created_at", "yyyy-MM").alias("review_window"),
        F.col("rating").cast("double").alias("rating"),
        lang.alias("language"),
        body.alias("body"),
        F.lower(text).alias("t"),
        F.struct(F.col("created_at"), F.col("review_id")).alias("first_seen"))


def theme_flags(lower_text: str = "t") -> list[Column]:
    """1 when any keyword of the theme occurs in the text (once per text)."""
    return [F.expr(f"IF({sx.contains_any(lower_text, kws)}, 1, 0)")
            for kws in lx.THEME_KEYWORDS.values()]


def top_themes_from_counts(counts: list[str], top_n: int = lx.TOP_THEMES_N) -> Column:
    """Top-n themes by count (columns named in ``counts``), ties by theme
    order; zero counts dropped."""
    entries = ", ".join(
        f"named_struct('weight', CAST({c} AS BIGINT), 'neg_order', {-i}, 'theme', {sx.s(th)})"
        for i, (th, c) in enumerate(zip(THEMES, counts)))
    return F.expr(
        f"transform(slice(sort_array(filter(array({entries}), e -> e.weight > 0), false), 1, "
        f"{top_n}), e -> named_struct('theme', e.theme, 'weight', e.weight))")


def review_group_stats(rows: DataFrame) -> DataFrame:
    """A3 + A5: n_reviews, avg_rating and theme counts per (product, month)."""
    flags = theme_flags("t")
    return rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.round(F.avg("rating"), 2).cast("decimal(3,2)").alias("avg_rating"),
        *[F.sum(f).alias(f"th_{i}") for i, f in enumerate(flags)])


def ranked_bodies(rows: DataFrame, n: int = lx.SUMMARY_MAX_BODIES) -> DataFrame:
    """A4 + W3: the n most frequent bodies per (product, month, scope), ties
    by first appearance (created_at, then review_id). Scopes: en, fr and all.

    Counting is a hash aggregate on two 64-bit hashes of the body, so no text is
    shuffled or sorted to count it. The ranking by count and first timestamp keeps
    ties; only rows of those candidates bring their text and review_id, which
    settle the ties (the planner broadcasts the candidates while they are few)."""
    keyed = rows.withColumns({"h1": F.xxhash64("body"), "h2": F.xxhash64(F.lit("h2"), F.col("body")),
                              "seen": F.col("first_seen.created_at")})
    key = [*GROUP, "h1", "h2"]
    per_body = keyed.groupBy(*key).agg(
        *[F.count_if(F.col("language") == s).alias(f"cnt_{s}") for s in SCOPES],
        F.count(F.lit(1)).alias("cnt_all"),
        *[F.min(F.when(F.col("language") == s, F.col("seen"))).alias(f"first_{s}") for s in SCOPES],
        F.min("seen").alias("first_all"))
    scopes = F.array(*[F.struct(F.lit(s).alias("scope"), F.col(f"cnt_{s}").alias("cnt"),
                                F.col(f"first_{s}").alias("first"))
                       for s in SCOPES + ["all"]])
    exploded = per_body.select(*key, F.inline(scopes)).filter(F.col("cnt") > 0)
    by_time = Window.partitionBy(*GROUP, "scope").orderBy(F.desc("cnt"), F.asc("first"))
    candidates = exploded.withColumn("place", F.rank().over(by_time)).filter(F.col("place") <= n).drop("place")
    firsts = keyed.select(*key, "seen", "language", F.col("first_seen.review_id").alias("review_id"), "body")
    found = (firsts.join(candidates, key)
             .where((F.col("seen") == F.col("first")) & ((F.col("scope") == "all") | (F.col("scope") == F.col("language"))))
             .groupBy(*key, "scope", "cnt", "first").agg(F.min(F.struct("review_id", "body")).alias("x")))
    w = Window.partitionBy(*GROUP, "scope").orderBy(F.desc("cnt"), F.asc("first"), F.asc("x.review_id"))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select(*GROUP, "scope", "rank", F.col("x.body").alias("body"), F.col("cnt").cast("long").alias("cnt")))


def extractive_summaries(ranked: DataFrame) -> DataFrame:
    """Per (product, month) the ranked bodies of each scope joined by a
    space; a language with no bodies (or an empty result) falls back to all."""
    def joined(scope: str) -> Column:
        picked = F.collect_list(F.when(F.col("scope") == scope,
                                       F.struct(F.col("rank"), F.col("body"))))
        return F.array_join(F.transform(F.array_sort(picked), lambda x: x["body"]), " ")

    per = ranked.groupBy(*GROUP).agg(*[joined(s).alias(f"s_{s}") for s in SCOPES + ["all"]])
    return per.select(*GROUP, *[
        F.coalesce(F.nullif(F.col(f"s_{s}"), F.lit("")), F.col("s_all")).alias(f"summary_{s}")
        for s in SCOPES])


def summarize_reviews(reviews: DataFrame) -> DataFrame:
    """product_id, review_window, n_reviews, avg_rating, summary_en,
    summary_fr, top_themes (array<struct<theme, weight>>)."""
    rows = _review_rows(reviews)
    stats = review_group_stats(rows)
    themes = top_themes_from_counts([f"th_{i}" for i in range(len(THEMES))])
    stats = stats.select(*GROUP, "n_reviews", "avg_rating", themes.alias("top_themes"))
    return _with_summaries(stats, extractive_summaries(ranked_bodies(rows)))


def _with_summaries(stats: DataFrame, summaries: DataFrame) -> DataFrame:
    return stats.join(summaries, GROUP, "left").select(
        *GROUP, "n_reviews", "avg_rating",
        F.coalesce("summary_en", F.lit("")).alias("summary_en"),
        F.coalesce("summary_fr", F.lit("")).alias("summary_fr"),
        F.coalesce(F.col("top_themes"), F.array().cast(f"array<{THEME_STRUCT.simpleString()}>"))
         .alias("top_themes"))


# ── counts that merge: summaries without a pass over old reviews ────────────
BODY = [*GROUP, "h1", "h2"]
TOP = [*GROUP, "scope", "rank"]


def review_facts(reviews: DataFrame) -> DataFrame:
    """Per review with a month: its group, rating, language, body with two 64-bit hashes, when and
    as which id it was seen, and a 0/1 per theme."""
    flags = [f.alias(f"th_{i}") for i, f in enumerate(theme_flags("t"))]
    return _review_rows(reviews).select(
        *GROUP, "rating", "language", "body", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit("h2"), F.col("body")).alias("h2"),
        F.struct(F.col("first_seen.created_at").alias("seen"), F.col("first_seen.review_id").alias("review_id")).alias("first_seen"), *flags)


def group_counts(facts: DataFrame) -> DataFrame:
    """Per (product, month): what A3 and A5 are made of, as sums."""
    return facts.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_reviews"), F.count("rating").alias("n_ratings"),
        F.coalesce(F.sum(F.col("rating").cast("decimal(20,6)")), F.lit(0)).cast("decimal(38,6)").alias("rating_sum"),
        *[F.sum(f"th_{i}").alias(f"th_{i}") for i in range(len(THEMES))])


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    rows = a.unionByName(b)
    return rows.groupBy(*GROUP).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in GROUP])


def body_counts(facts: DataFrame) -> DataFrame:
    """Per distinct body of a (product, month) and scope: its count and the first (time, id) it was seen as."""
    per = facts.groupBy(*BODY)
    inside = {s: F.col("language") == s for s in SCOPES} | {"all": F.lit(True)}
    return per.agg(*[F.count_if(c).alias(f"cnt_{s}") for s, c in inside.items()],
                   *[F.min(F.when(c, F.col("first_seen"))).alias(f"first_{s}") for s, c in inside.items()])


def merge_bodies(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy(*BODY).agg(*[F.sum(f"cnt_{s}").alias(f"cnt_{s}") for s in [*SCOPES, "all"]],
                                               *[F.min(f"first_{s}").alias(f"first_{s}") for s in [*SCOPES, "all"]])


def top_bodies(bodies: DataFrame, added: DataFrame, facts: DataFrame, before: DataFrame | None = None,
               n: int = lx.SUMMARY_MAX_BODIES) -> DataFrame:
    """A4 + W3 from counts: the top ``n`` bodies per (product, month, scope) after new reviews, given
    as ``facts`` and their counts ``added``. ``bodies``: all counts of the bodies among them; ``before``: the
    tops until now. A body only gains counts and earlier times, so one that is new among the tops
    is one of ``bodies``; no other count is needed, and no text but that of the tops."""
    scopes = F.array(*[F.struct(F.lit(s).alias("scope"), F.col(f"cnt_{s}").alias("cnt"), F.col(f"first_{s}").alias("first"))
                       for s in [*SCOPES, "all"]])
    rows = bodies.select(*BODY, F.inline(scopes)).where("cnt > 0")
    if before is not None:
        rows = rows.unionByName(matching(before, bodies, BODY, "left_anti").select(*rows.columns))
    w = Window.partitionBy(*GROUP, "scope").orderBy(F.desc("cnt"), F.asc("first"), "h1", "h2")
    ranked = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    wanted = matching(added.select(*BODY, F.col("first_all").alias("own")), ranked, BODY)
    if before is not None:
        wanted = matching(wanted, before, BODY, "left_anti")
    other = wanted.select(*[F.col(k).alias(f"w_{k}") for k in BODY], "own")
    found = facts.join(other, [*[F.col(k).eqNullSafe(F.col(f"w_{k}")) for k in BODY], F.col("first_seen").eqNullSafe(F.col("own"))])
    texts = found.select(*BODY, "body")
    if before is not None:
        texts = texts.unionByName(before.select(*BODY, "body"))
    texts = texts.dropDuplicates(BODY).select(*[F.col(k).alias(f"w_{k}") for k in BODY], "body")
    return (ranked.join(texts, [F.col(k).eqNullSafe(F.col(f"w_{k}")) for k in BODY])
            .select(*TOP, "h1", "h2", "cnt", "first", "body"))


def summaries_from_counts(counts: DataFrame, tops: DataFrame) -> DataFrame:
    """T9 from kept counts and tops: the rows of ``summarize_reviews``."""
    themes = top_themes_from_counts([f"th_{i}" for i in range(len(THEMES))])
    mean = F.col("rating_sum").cast("double") / F.nullif(F.col("n_ratings"), F.lit(0))
    stats = counts.select(*GROUP, "n_reviews", F.round(mean, 2).cast("decimal(3,2)").alias("avg_rating"), themes.alias("top_themes"))
    return _with_summaries(stats, extractive_summaries(tops))


def themes_flat(c: Column) -> Column:
    """``theme:weight|...`` text form of a themes array (for value hashing)."""
    return F.array_join(F.transform(c, lambda x: F.concat(x["theme"], F.lit(":"),
                                                          x["weight"].cast("string"))), "|")
