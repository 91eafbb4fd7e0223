"""Lead enrichment: size band, score, intent signals, note translation.

All per-row column expressions; one narrow projection, no shuffle. The
keyword-heavy parts are assembled as SQL text (one JVM parse each).
Arguments name input columns (or are SQL expressions over them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.functions import sqlexpr as sx


def size_band_labels(top_label: str = lx.SIZE_BAND_TOP_LABEL) -> list[tuple[int, int, str]]:
    """Band bounds and labels; the open top band keeps the original's literal
    label unless ``top_label`` is given (e.g. ``"1000+"`` as the DDL says)."""
    out = []
    for lo, hi in lx.SIZE_BANDS:
        label = f"{lo}-{hi}" if hi < 10**6 else top_label
        out.append((lo, hi, label))
    return out


def _lower(notes: str) -> str:
    return f"lower(coalesce({notes}, ''))"


def company_size_band(notes: str = "notes", top_label: str = lx.SIZE_BAND_TOP_LABEL) -> Column:
    """First run of digits anywhere in the notes, read whole -> band; none
    or 0 -> the default band; a number beyond the top band belongs to it."""
    digits = f"ltrim('0', regexp_extract({_lower(notes)}, '([0-9]+)', 1))"
    n = f"(CASE WHEN {digits} = '' THEN 0 WHEN length({digits}) > 9 THEN {lx.SIZE_BANDS[-1][1]} ELSE CAST({digits} AS INT) END)"
    # Bands don't overlap, so the places add up to the one that fits. Every term is always evaluated,
    # which lets Spark compute the number once for all of them.
    bands = size_band_labels(top_label)
    place = " + ".join(f"IF({n} >= {lo} AND {n} <= {hi}, {k}, 0)" for k, (lo, hi, _) in enumerate(bands, 2))
    labels = ", ".join(sx.s(label) for label in [lx.SIZE_BAND_DEFAULT, *[label for _, _, label in bands]])
    return F.expr(f"coalesce(element_at(array({labels}), greatest(1, {place})), {sx.s(lx.SIZE_BAND_DEFAULT)})")


def lead_score(status: str = "status", source: str = "source", value: str = "est_value_eur",
               notes: str = "notes") -> Column:
    """30 + status + source + value points (capped) + signal bonus -
    objection malus, clamped to 0..100."""
    t = _lower(notes)
    value_pts = (f"(CASE WHEN {value} IS NULL THEN 0 ELSE "
                 f"CAST(least({lx.VALUE_POINTS_CAP}, greatest(-1000000, CAST({value} AS DECIMAL(28,4)) / {lx.VALUE_POINTS_DIVISOR})) AS INT) END)")
    score = (f"{lx.LEAD_SCORE_BASE} + {sx.case_map(status, lx.STATUS_POINTS, '0')} "
             f"+ {sx.case_map(source, lx.SOURCE_POINTS, '0')} + {value_pts} "
             f"+ IF({sx.contains_any(t, lx.POSITIVE_SIGNAL_WORDS)}, "
             f"{lx.POSITIVE_SIGNAL_POINTS}, 0) "
             f"+ IF({sx.contains_any(t, lx.OBJECTION_WORDS)}, {lx.OBJECTION_POINTS}, 0)")
    return F.expr(f"CAST(greatest(0, least(100, {score})) AS SMALLINT)")


# Word boundaries as in the original's regex engine: Unicode-aware, so a digit
# run glued to an accented letter is not a separate word.
TIMELINE_REGEX = "(?U)" + lx.TIMELINE_PATTERN


def intent_signals(notes: str = "notes") -> Column:
    """Ordered list of matched intent labels, else ``[no_clear_signal]``."""
    t = _lower(notes)
    flags = []
    for label, words in lx.INTENT_SIGNALS:
        cond = (f"{t} RLIKE {sx.s(TIMELINE_REGEX)}" if words is None
                else sx.contains_any(t, words))
        flags.append(f"IF({cond}, {sx.s(label)}, NULL)")
    # Labels hold no comma. As text the list is found once, by generated code (array functions with
    # lambdas are interpreted, each test on a new lower-cased copy of the notes).
    found = f"concat_ws(',', {', '.join(flags)})"
    return F.expr(f"split(coalesce(nullif({found}, ''), {sx.s(lx.NO_SIGNAL_LABEL)}), ',')")


def glossary(target_lang: str) -> list[tuple[str, str]]:
    """Replacement pairs in application order: longest source phrase first
    (stable for equal lengths)."""
    if target_lang == "fr":
        pairs = dict(lx.GLOSSARY_EN_FR)
    elif target_lang == "en":
        pairs = {v: k for k, v in lx.GLOSSARY_EN_FR.items()}
    else:
        raise ValueError("target_lang must be 'en' or 'fr'")
    return [(src, pairs[src]) for src in sorted(pairs, key=len, reverse=True)]


def translate_note(notes: str, target_lang: str) -> Column:
    """Case-sensitive phrase replacement, applied sequentially."""
    out = f"coalesce({notes}, '')"
    for src, dst in glossary(target_lang):
        out = f"replace({out}, {sx.s(src)}, {sx.s(dst)})"
    return F.expr(out)


def enrich_leads(leads: DataFrame) -> DataFrame:
    """lead_id, company_size_band, lead_score, intent_signals, notes_en, notes_fr."""
    return leads.select(
        "lead_id",
        company_size_band("notes").alias("company_size_band"),
        lead_score("status", "source", "est_value_eur", "notes").alias("lead_score"),
        intent_signals("notes").alias("intent_signals"),
        translate_note("notes", "en").alias("notes_en"),
        translate_note("notes", "fr").alias("notes_fr"))
