"""Spark SQL expression text for keyword-heavy expressions.

A rule over ~100 keywords built with the Column API costs several JVM
round trips per keyword on the driver; the same expression as SQL text is
parsed once by Catalyst and yields the identical plan. These helpers only
assemble expression strings from fixed values; evaluation stays in Spark.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def s(value: str) -> str:
    """Spark SQL string literal (backslash escapes)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(text: str, words: Iterable[str]) -> str:
    unique = list(dict.fromkeys(words))
    return "(" + " OR ".join(f"contains({text}, {s(w)})" for w in unique) + ")"


def weighted_hits(text: str, words: Iterable[str]) -> str:
    """Number of listed words found as substrings; a word listed k times counts k. A loop over the
    list, as one test per word makes a generated method so long that the JVM only interprets it."""
    return f"size(filter(array({', '.join(s(w) for w in words)}), w -> contains({text}, w)))"


def pick(values: list[str], index_sql: str) -> str:
    """``values[index]`` for a 0-based integer expression."""
    return f"element_at(array({', '.join(s(v) for v in values)}), CAST(({index_sql}) + 1 AS INT))"


def fill(template_sql: str, values: dict[str, str]) -> str:
    out = template_sql
    for key, val in values.items():
        out = f"replace({out}, {s('{' + key + '}')}, CAST({val} AS STRING))"
    return out


def case_map(col_sql: str, table: dict[str, int | str], default: str) -> str:
    whens = " ".join(f"WHEN {col_sql} = {s(k)} THEN {v if isinstance(v, int) else s(v)}"
                     for k, v in table.items())
    return f"(CASE {whens} ELSE {default} END)"


def expr(sql: str) -> Column:
    return F.expr(sql)
