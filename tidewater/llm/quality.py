"""Quality rules by distribution divergence (DataFrame functions only).

Each document's character-class histogram and common-word histogram are compared
with those of its language by Jensen-Shannon distance (base 2, so 0 to 1). The
language references are sums over all documents; documents without a language
are held against the reference of all languages together.

References come from one aggregation, verdicts from a narrow projection: texts are never
shuffled and nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import let, table, written
from tidewater.llm.registry import register

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
CHAR_CLASSES = ("lower", "space", "upper", "letter", "digit", "mark", "other")
CHAR_PATTERNS = ("[a-z]+", SPACE, "[A-Z]+", r"\p{L}+", "[0-9]+", r"[.,;:!?'\"()-]+")

MIN_CHARS = 150           # shorter texts are not judged by character classes
MIN_WORDS = 30            # shorter texts are not judged by common words
MAX_CHAR_DISTANCE = 0.25  # plus CHAR_NOISE / sqrt(characters): short texts scatter more
CHAR_NOISE = 1.0
MAX_WORD_DISTANCE = 0.20  # plus WORD_NOISE / sqrt(n_words)
WORD_NOISE = 1.5
MIN_WORD_SHARE = 0.005    # a common word makes up this share of its language's words
MIN_LANG_SHARE = 0.0005   # a language with a reference makes up this share of all words
BUCKETS = 4096            # word hashes counted to find what can be common at all


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and \\x09-\\x0D."""
    return F.array_remove(F.split(text, SPACE), "")


def char_counts(text: Column) -> Column:
    """Character counts, one per class of CHAR_CLASSES, then the count of SYMBOLS. Each class is
    removed from what the classes before it left, so only the first pattern sees the whole text."""
    def step(rest: Column, patterns: tuple[str, ...]) -> Column:
        if not patterns:
            symbols = F.length(rest) - F.length(F.translate(rest, SYMBOLS, ""))
            return F.array(F.length(rest).cast("double"), symbols.cast("double"))
        return let(F.regexp_replace(rest, patterns[0], ""), lambda left: F.concat(
            F.array((F.length(rest) - F.length(left)).cast("double")), step(left, patterns[1:])))
    return let(text, lambda t: step(t, CHAR_PATTERNS))


def repeated_words(words: Column) -> Column:
    """Words inside WINDOW-word windows found twice or more in the text (overlaps count, the
    first occurrence too). Windows are compared by a 64-bit hash of their words' hashes."""
    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))))

    def again(s: Column) -> Column:
        return F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))

    def covered(s: Column) -> Column:
        gaps = F.transform(s, lambda x, i: F.least(F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def count(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = F.sort_array(F.transform(let(placed, again), lambda x: x["i"]))
        # most texts repeat no window: the sorts are for the others
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(starts, covered))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), count)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays of equal size; null if one sums to 0."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def distance(sums: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: let(F.struct(
            (a / sums["p"]).alias("a"), (b / sums["q"]).alias("b")), lambda r: let(
                (r["a"] + r["b"]) / 2, lambda m: (part(r["a"], m) + part(r["b"], m)) / 2)))
        return F.sqrt(F.greatest(total(terms), F.lit(0.0)))

    return let(F.struct(total(p).alias("p"), total(q).alias("q")),
               lambda s: F.when((s["p"] > 0) & (s["q"] > 0), distance(s)))


def heavy_buckets(rows: DataFrame, min_word_share: float, min_lang_share: float) -> list[int]:
    """Hash buckets that hold min_word_share of the words of some language of min_lang_share of
    all words, or of all languages together: every common word is in one of them. At most
    (1/min_lang_share + 1)/min_word_share buckets, BUCKETS in any case."""
    buckets = F.transform(words_of(F.col("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    counts = written(rows.select("lang", F.explode(buckets).alias("b")).groupBy("lang", "b").agg(F.count("*").alias("n")), "buckets")
    all_words = counts.agg(F.sum("n")).first()[0] or 0
    totals = (counts.groupBy("lang").agg(F.sum("n").alias("total"))
              .where((F.col("total") >= min_lang_share * all_words) & F.col("lang").isNotNull()))
    of_lang = counts.join(F.broadcast(totals), "lang").where(F.col("n") >= min_word_share * F.col("total"))
    of_all = counts.groupBy("b").agg(F.sum("n").alias("n")).where(F.col("n") >= min_word_share * all_words)
    return sorted(r[0] for r in of_lang.select("b").union(of_all.select("b")).distinct().collect())


def language_references(rows: DataFrame, min_word_share: float = MIN_WORD_SHARE,
                        min_lang_share: float = MIN_LANG_SHARE) -> DataFrame:
    """From measured rows (``lang``, ``n_words``, ``chars``, ``heavy``): one row per language, and
    one with a null ``ref_lang`` for all together, with ``ref_chars``, ``ref_words`` (sorted) and
    ``ref_counts``, the count of all other words last.

    At most 1/min_lang_share languages of at most 1/min_word_share words come out, so the
    result may be broadcast. Smaller languages have no reference of their own.
    """
    sums = rows.groupBy("lang").agg(F.sum("n_words").cast("double").alias("total"), F.array(
        *(F.sum(F.col("chars")[k]) for k in range(len(CHAR_CLASSES)))).alias("ref_chars"))
    sums = sums.where("lang is not null").unionByName(rows.agg(
        F.sum("n_words").cast("double").alias("total"), F.array(
            *(F.sum(F.col("chars")[k]) for k in range(len(CHAR_CLASSES)))).alias("ref_chars"))
        .withColumn("lang", F.lit(None).cast("string")))
    all_words = rows.agg(F.sum("n_words")).first()[0] or 0
    totals = sums.where((F.col("total") > 0) & (F.col("total") >= min_lang_share * all_words)).withColumnRenamed("lang", "ref_lang")
    counts = rows.select("lang", F.explode("heavy").alias("w")).groupBy("lang", "w").agg(F.count("*").cast("double").alias("n"))
    counts = counts.where("lang is not null").unionByName(
        counts.groupBy("w").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(None).cast("string")))
    common = (counts.join(F.broadcast(totals), F.col("lang").eqNullSafe(F.col("ref_lang")))
              .where(F.col("n") >= min_word_share * F.col("total"))
              .groupBy("ref_lang").agg(F.sort_array(F.collect_list(F.struct("w", "n"))).alias("x"))
              .withColumnRenamed("ref_lang", "lang"))
    known = F.coalesce(F.transform(F.col("x"), lambda r: r["n"]), F.array().cast("array<double>"))
    return totals.join(F.broadcast(common), F.col("lang").eqNullSafe(F.col("ref_lang")), "left").select(
        "ref_lang", "ref_chars",
        F.coalesce(F.transform(F.col("x"), lambda r: r["w"]), F.array().cast("array<string>")).alias("ref_words"),
        F.concat(known, F.array(F.col("total") - F.aggregate(known, F.lit(0.0), lambda a, n: a + n))).alias("ref_counts"))


def base_rules(docs: DataFrame) -> DataFrame:
    """Adds ``words``, ``chars`` (see char_counts) and the counts of the base rules to rows with ``text``."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.withColumns({"words": words_of(F.col("text")), "chars": char_counts(F.col("text"))})
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": (F.length("text") - F.col("chars")[1]).cast("long"),
        "n_symbols": F.col("chars")[len(CHAR_CLASSES)].cast("long"),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "n_repeat_words": let(F.col("words"), repeated_words),
        "chars": F.slice("chars", 1, len(CHAR_CLASSES))})
    return rows.withColumn("base_failed", (F.col("n_words") < 10)
                           | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, base counts, both distances and the verdict ``kept``.

    A null text counts as empty and fails the base rules. A distance is null, and does not
    count against the row, if the text is shorter than its guard. A text whose language is null or
    too small for a reference is held against all languages together. A null or repeated id
    changes nothing; other columns are not read; an empty table gives an empty result.

    The texts are read twice: to count words by hash, and to measure each row; the measures
    are written once, and the references and verdicts come from them.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    heavy = heavy_buckets(rows, MIN_WORD_SHARE, MIN_LANG_SHARE)
    measured = base_rules(rows).select(
        "doc_id", "lang", F.length("text").alias("n_chars"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "chars",
        F.filter("words", lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int").isin(heavy or [-1])).alias("heavy"))
    measured = written(measured, "measured")
    references = written(language_references(measured), "references")
    known = [r[0] for r in references.where("ref_lang is not null").select("ref_lang").collect()]  # at most 1 / MIN_LANG_SHARE
    held_against = F.when(F.col("lang").isin(known), F.col("lang"))  # else null: all languages together
    judged = measured.join(F.broadcast(references), held_against.eqNullSafe(F.col("ref_lang")), "left")
    places = F.transform("heavy", lambda w: F.array_position("ref_words", w))
    counts = let(places, lambda at: F.concat(
        F.transform("ref_words", lambda _, k: (F.size(at) - F.size(F.array_remove(at, (k + 1).cast("long")))).cast("double")),
        F.array((F.col("n_words") - F.size(F.array_remove(at, F.lit(0).cast("long")))).cast("double"))))
    judged = judged.withColumns({
        "js_chars": F.when(F.col("n_chars") >= MIN_CHARS, js_distance(F.col("chars"), F.col("ref_chars"))),
        "js_words": F.when(F.col("n_words") >= MIN_WORDS, let(counts, lambda p: js_distance(p, F.col("ref_counts"))))})
    bad_chars = F.coalesce(F.col("js_chars") > MAX_CHAR_DISTANCE + CHAR_NOISE / F.sqrt("n_chars"), F.lit(False))
    bad_words = F.coalesce(F.col("js_words") > MAX_WORD_DISTANCE + WORD_NOISE / F.sqrt("n_words"), F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~bad_chars & ~bad_words).alias("kept"),
        F.round("js_chars", 6).alias("js_chars"), F.round("js_words", 6).alias("js_words"))


def oracle() -> str:
    sql = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  regexp_replace(text, '[a-z]+', '', 'g') AS t1 FROM d),
c1 AS (SELECT *, regexp_replace(t1, '[\x20\x09-\x0D]+', '', 'g') AS t2 FROM w),
c2 AS (SELECT *, regexp_replace(t2, '[A-Z]+', '', 'g') AS t3 FROM c1),
c3 AS (SELECT *, regexp_replace(t3, '\p{L}+', '', 'g') AS t4 FROM c2),
c4 AS (SELECT *, regexp_replace(t4, '[0-9]+', '', 'g') AS t5 FROM c3),
c5 AS (SELECT *, regexp_replace(t5, '[.,;:!?''"()-]+', '', 'g') AS t6 FROM c4),
h AS (SELECT doc_id, lang, text, words, [length(text) - length(t1), length(t1) - length(t2),
  length(t2) - length(t3), length(t3) - length(t4), length(t4) - length(t5), length(t5) - length(t6),
  length(t6)]::DOUBLE[] AS chars FROM c5),
wl AS (SELECT lang, unnest(words) AS w FROM h),
wc AS (SELECT lang, w, count(*) AS n, false AS pooled FROM wl WHERE lang IS NOT NULL GROUP BY ALL
  UNION ALL SELECT NULL, w, count(*), true FROM wl GROUP BY w),
tot AS (SELECT lang, pooled, sum(n)::DOUBLE AS total FROM wc GROUP BY ALL),
big AS (SELECT * FROM tot WHERE total >= @LANG * (SELECT count(*) FROM wl)),
refw AS (SELECT b.lang, b.pooled, list(w ORDER BY w) AS rw, list(n::DOUBLE ORDER BY w) AS rn, any_value(total) AS total
  FROM wc JOIN big b ON wc.lang IS NOT DISTINCT FROM b.lang WHERE n >= @SHARE * total GROUP BY ALL),
cu AS (SELECT lang, generate_subscripts(chars, 1) AS k, unnest(chars) AS n FROM h),
cs AS (SELECT lang, k, sum(n) AS n FROM cu WHERE lang IS NOT NULL GROUP BY ALL
  UNION ALL SELECT NULL, k, sum(n) FROM cu GROUP BY k),
refc AS (SELECT lang, list(n ORDER BY k) AS rc FROM cs GROUP BY lang),
ref AS (SELECT r.lang, rw, list_append(rn, total - list_sum(rn)) AS rn, rc
  FROM refw r JOIN refc c ON r.lang IS NOT DISTINCT FROM c.lang),
pos AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i FROM h WHERE len(words) >= 5),
win AS (SELECT p.doc_id, i, words[i : i + 4] AS x FROM pos p JOIN h ON p.doc_id = h.doc_id),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
cov AS (SELECT doc_id, sum(g)::BIGINT AS n FROM (SELECT doc_id,
  least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS g FROM dup) GROUP BY doc_id),
base AS (SELECT h.*, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM h LEFT JOIN cov ON h.doc_id = cov.doc_id),
b2 AS (SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
m AS (SELECT b2.*, rw, rn, rc, list_append([(len(words) - len(list_filter(words, lambda y: y <> x)))::DOUBLE for x in rw],
  len(list_filter(words, lambda y: NOT list_contains(rw, y)))::DOUBLE) AS hist
  FROM b2 LEFT JOIN ref ON CASE WHEN b2.lang IN (SELECT lang FROM ref WHERE lang IS NOT NULL) THEN b2.lang END IS NOT DISTINCT FROM ref.lang),
pr AS (SELECT *, list_sum(chars) AS sc, list_sum(rc) AS src, list_sum(hist) AS sh, list_sum(rn) AS srn FROM m),
js AS (SELECT *, CASE WHEN length(text) >= @CHARS AND rc IS NOT NULL THEN sqrt(greatest(0, list_sum([
    (CASE WHEN z[1] > 0 THEN z[1] / sc * log2(z[1] / sc / ((z[1] / sc + z[2] / src) / 2)) ELSE 0 END
     + CASE WHEN z[2] > 0 THEN z[2] / src * log2(z[2] / src / ((z[1] / sc + z[2] / src) / 2)) ELSE 0 END) / 2
    for z in list_zip(chars, rc)]))) END AS jc,
  CASE WHEN n_words >= @WORDS AND rn IS NOT NULL THEN sqrt(greatest(0, list_sum([
    (CASE WHEN z[1] > 0 THEN z[1] / sh * log2(z[1] / sh / ((z[1] / sh + z[2] / srn) / 2)) ELSE 0 END
     + CASE WHEN z[2] > 0 THEN z[2] / srn * log2(z[2] / srn / ((z[1] / sh + z[2] / srn) / 2)) ELSE 0 END) / 2
    for z in list_zip(hist, rn)]))) END AS jw FROM pr)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(jc <= @MAXC + @CNOISE / sqrt(length(text)), true) AND coalesce(jw <= @MAXW + @NOISE / sqrt(n_words), true) AS kept,
  round(jc, 6) AS js_chars, round(jw, 6) AS js_words FROM js"""
    for name, value in (("@LANG", MIN_LANG_SHARE), ("@SHARE", MIN_WORD_SHARE), ("@CHARS", MIN_CHARS), ("@WORDS", MIN_WORDS),
                        ("@MAXC", MAX_CHAR_DISTANCE), ("@MAXW", MAX_WORD_DISTANCE), ("@CNOISE", CHAR_NOISE), ("@NOISE", WORD_NOISE)):
        sql = sql.replace(name, str(value))
    return sql


@register("op1_quality_divergence", oracle())
def op1_quality_divergence(spark, sf_dir):
    return judge_quality(table(spark, sf_dir, "documents"))
