"""Column-expression building blocks for the text operators.

All helpers return ``pyspark.sql.Column`` expressions evaluated inside the
JVM (whole-stage codegen); none of them is a Python UDF.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions import lexicon as lx
from tidewater.functions import sqlexpr as sx


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's ``str.strip()`` removes, derived from its own
# definition (``str.isspace``) rather than listed by hand.
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def strip_all(c: Column | str) -> Column:
    """Strip leading/trailing Unicode whitespace. ``trim(BOTH set FROM s)`` is
    linear in the string length (a regex ``\\s+$`` is quadratic on long
    interior whitespace runs); plain ``trim`` would only drop spaces."""
    return F.btrim(col_or_name(c), F.lit(WHITESPACE))


def empty_if_null(c: Column | str) -> Column:
    return F.coalesce(col_or_name(c), F.lit(""))


def contains_lit(text: Column, word: str) -> Column:
    return F.contains(text, F.lit(word))


def any_contains(text: Column | str, words: Iterable[str]) -> Column:
    """True when any word occurs as a substring (each word tested once).
    ``text`` may be a SQL expression string (one parse on the JVM side)."""
    if isinstance(text, str):
        return F.expr(sx.contains_any(text, words))
    unique = list(dict.fromkeys(words))
    return reduce(lambda a, b: a | b, [contains_lit(text, w) for w in unique])


def weighted_hits(text: Column | str, words: Iterable[str]) -> Column:
    """Number of listed words occurring as substrings; a word listed k times
    counts k times (the lists rely on that for weighting)."""
    if isinstance(text, str):
        return F.expr(sx.weighted_hits(text, words))
    weights = Counter(words)
    terms = [F.when(contains_lit(text, w), F.lit(n)).otherwise(F.lit(0))
             for w, n in weights.items()]
    return reduce(lambda a, b: a + b, terms)


def _marker_regex() -> str:
    """Whole-token match of a marker word: a maximal run of token letters that
    equals the marker. Markers holding a non-letter can never be a token, so
    they are left out (they never match in the original either)."""
    letters = lx.TOKEN_LETTERS
    valid = [m for m in lx.FR_MARKERS if re.fullmatch(f"[{letters}]+", m)]
    alt = "|".join(sorted(valid, key=len, reverse=True))
    return f"(?<![{letters}])(?:{alt})(?![{letters}])"


def detect_language(text: Column | str) -> Column:
    """``fr`` / ``en`` by the accent + marker-word rule.

    No token letters -> en; any accented letter -> fr; at least two marker
    tokens -> fr; else en. Runs on the whole text: the marker count is a
    ``regexp_count`` over the lower-cased string, so no token array is built.
    """
    t = F.lower(empty_if_null(col_or_name(text)))
    has_token = t.rlike(f"[{lx.TOKEN_LETTERS}]")
    has_accent = t.rlike(f"[{lx.ACCENT_LETTERS}]")
    marker_hits = F.regexp_count(t, F.lit(_marker_regex()))
    return (F.when(~has_token, F.lit("en"))
            .when(has_accent, F.lit("fr"))
            .when(marker_hits >= lx.FR_MARKER_MIN_HITS, F.lit("fr"))
            .otherwise(F.lit("en")))


def coerce_enum(value: Column, allowed: list[str], default: str) -> Column:
    """trim, lower, spaces -> '_', then keep only allowed labels."""
    v = F.replace(F.lower(strip_all(value.cast("string"))), F.lit(" "), F.lit("_"))
    return F.when(v.isin(allowed), v).otherwise(F.lit(default))


def clamp_float(value: Column, lo: float, hi: float, default: float) -> Column:
    """Parse as double (unparseable -> default), round to 3, clamp to [lo, hi]."""
    d = value.cast("string").try_cast("double")
    clamped = F.least(F.lit(hi), F.greatest(F.lit(lo), F.round(d, 3)))
    # NaN sorts above every number in least/greatest, so "nan" clamps to hi.
    return F.when(d.isNull(), F.lit(default)).otherwise(clamped)
