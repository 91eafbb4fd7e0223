"""Secret scan: fixed patterns and sliding-window entropy.

The entropy method reads candidate strings (maximal runs of a character class),
slides a window over each and keeps its Shannon entropy by incremental counts;
windows above the class's threshold merge into spans. Allow-listed candidates
(words of one case or capitalised and of bounded length, UUIDs, documented sample keys) give no
entropy span; of a candidate with a placeholder, windows that overlap the placeholder give none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.llm.registry import register

KINDS = ("assign", "access", "hex", "entropy")  # order of spans that start together
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")


@dataclass(frozen=True)
class EntropyClass:
    candidates: re.Pattern  # maximal runs, at least one window long
    window: int
    bits: float             # a window of this entropy or more is a hit


CLASSES = (
    EntropyClass(re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}"), 24, 3.0),
    EntropyClass(re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"), 20, 3.8),
)
ALLOWED = tuple(re.compile(x) for x in (
    r"[-_=/+.]+", r"\d+(?:[-/]\d+)*",                    # rules, plain numbers and dates
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",         # documented sample key
))
WORD = re.compile(r"[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z]+")  # one case, capitalised, or with words of 3 letters or more joined to it
MAX_WORD = 32  # letters; a longer run is no word
SEPARATORS = re.compile(r"[-_/=]+")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
PLACEHOLDER = re.compile(r"(?i)example|placeholder|changeme|xxxx")


def allowed(s: str) -> bool:
    """Whether ``s`` as a whole is no secret: a fixed form, a stretch of the alphabet, or words."""
    return (any(a.fullmatch(s) for a in ALLOWED) or s.lower() in ALPHABET
            or all(len(w) <= MAX_WORD and WORD.fullmatch(w) for w in SEPARATORS.split(s) if w))


def window_hits(s: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged (start, end) of all windows whose character entropy is at least ``bits``.
    H = log2(w) - sum(c log2 c) / w; a step changes two counts of that sum."""
    if len(s) < window:
        return []
    xlog = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    most = window * (math.log2(window) - bits) + 1e-9  # the sum may be this large
    counts: dict[str, int] = {}
    total = 0.0
    spans: list[tuple[int, int]] = []
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += xlog[c + 1] - xlog[c] if c < window else 0.0
        counts[ch] = c + 1
        if i >= window:
            old = s[i - window]
            c = counts[old]
            total += xlog[c - 1] - xlog[c] if c <= window else 0.0
            counts[old] = c - 1
        if i >= window - 1 and total <= most:
            at = i - window + 1
            if spans and at <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((at, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns; leftmost, non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def judged_stretches(s: str) -> list[tuple[int, int]]:
    """(start, end) of what lies between the placeholders of candidate ``s``, without the separators next to them."""
    out, at = [], 0
    for word in PLACEHOLDER.finditer(s):
        out.append((at, word.start()))
        at = word.end()
    out.append((at, len(s)))
    return [(a + len(x) - len(x.lstrip("/_=-")) if a else a, a + len(x.rstrip("/_=-")) if b < len(s) else b)
            for a, b in out for x in [s[a:b]]]


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    found: list[tuple[int, int]] = []
    for cls in CLASSES:
        for m in cls.candidates.finditer(text):
            s = m.group()
            if allowed(s):
                continue
            for at, end in judged_stretches(s):
                own = s[at:end]
                if len(own) >= cls.window and not allowed(own):
                    found += [(m.start() + at + a, m.start() + at + b) for a, b in window_hits(own, cls.window, cls.bits)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):  # classes can overlap
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return [(a, 3, b) for a, b in merged]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``spans`` (array of kind, start, end; code points,
    end exclusive; sorted by start, then kind) and ``n_base``, how many are of fixed patterns.
    A null text counts as empty. Narrow: rows neither move nor wait for each other."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                base = base_spans(text)
                found.append((base, sorted(base + entropy_spans(text))))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "spans": [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in f[1]] for f in found],
                "n_base": [len(f[0]) for f in found]})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(scan, f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int>>, n_base int")


def mask_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text_col`` (fixed or entropy; overlapping ones as one)
    replaced by ``mask``; null texts stay null and other columns are kept as they are."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            out, at = [], 0
            for a, _, b in sorted(base_spans(text) + entropy_spans(text)):
                if a >= at:
                    out += [text[at:a], mask]
                at = max(at, b)
            return "".join([*out, text[at:]]) if out else text
        return texts.map(one)

    return docs.withColumn(text_col, masked(F.col(text_col)))


@register("op7_secret_scan")
def op7_secret_scan(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "entropy")

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))
