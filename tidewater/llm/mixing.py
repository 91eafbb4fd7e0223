"""Mixing to target weights by iterative proportional fitting.

Token masses per cell (source x language x topic) are raked until their marginals equal
the targets; each document is then kept with its cell's calibrated probability. The draw is
a hash of (id, text), so it is the same on every run and after lost tasks.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import prod
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import let, table
from tidewater.llm.registry import register

OTHER = "*"       # category of values (and nulls) that the targets don't name
MAX_CELLS = 100_000
SHARE = 0.5        # of the tokens is kept, or less where that is needed to meet the targets
ROUNDS, TOLERANCE = 500, 1e-9
STEPS, GAP = 10, 1e-3  # of the search for a share that meets the targets


def cell_of(value: Column, targets: dict[str, float]) -> Column:
    named = [k for k in targets if k != OTHER]
    return F.when(value.cast("string").isin(named), value.cast("string")).otherwise(OTHER) if named else F.lit(OTHER)


def rake(masses: dict[tuple[str, ...], float], targets: list[dict[str, float]], share: float,
         rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> dict[tuple[str, ...], float]:
    """Expected tokens per cell: ``share`` of all tokens, proportional to ``masses`` times one factor
    per category of each dimension, so that marginals are the targets (normalised over the
    categories that occur). No cell gives more than it has: where the targets ask for that, the
    cell stops at its mass and the others are raked around it."""
    cats = [sorted({k[d] for k, m in masses.items() if m > 0}) for d in range(len(targets))]
    if not masses or not all(cats):
        return {}
    has = np.zeros([len(c) for c in cats])
    for key, m in masses.items():
        if m > 0:
            has[tuple(c.index(k) for c, k in zip(cats, key))] = m
    total = has.sum()
    has /= total
    cube, wanted = has * share, []
    for c, t in zip(cats, targets):
        w = np.array([max(0.0, t.get(k, 0.0)) for k in c])
        wanted.append(share * (w / w.sum() if w.sum() > 0 else np.full(len(c), 1 / len(c))))
    axes = range(len(cats))
    for _ in range(rounds):
        before = cube
        for d in axes:
            now = cube.sum(axis=tuple(a for a in axes if a != d))
            factor = np.divide(wanted[d], now, out=np.zeros_like(now), where=now > 0)
            cube = np.minimum(cube * factor.reshape([-1 if a == d else 1 for a in axes]), has)
        if float(np.abs(cube - before).max()) < tolerance:
            break
    return {key: float(total * cube[tuple(c.index(k) for c, k in zip(cats, key))]) for key in product(*cats) if masses.get(key, 0) > 0}


def marginals(cells: dict[tuple[str, ...], float], targets: list[dict[str, float]]) -> list[tuple[int, str, float, float]]:
    """(dimension, category, target share, share that ``cells`` give) of every category that occurs; targets
    are normalised over those."""
    total, out = sum(cells.values()), []
    for d, t in enumerate(targets):
        got: dict[str, float] = {}
        for key, v in cells.items():
            got[key[d]] = got.get(key[d], 0.0) + v
        wanted = {k: max(0.0, t.get(k, 0.0)) for k in got}
        norm = sum(wanted.values())
        out += [(d, k, wanted[k] / norm if norm > 0 else 1 / len(got), got[k] / total if total > 0 else 0.0) for k in sorted(got)]
    return out


def worst_gap(cells: dict[tuple[str, ...], float], targets: list[dict[str, float]]) -> float:
    return max((abs(got - wanted) for _, _, wanted, got in marginals(cells, targets)), default=0.0)


def largest_share(masses: dict[tuple[str, ...], float], targets: list[dict[str, float]], share: float) -> float:
    """The largest share up to ``share`` (to one part in 2^STEPS of it) whose raked cells meet all targets
    to GAP. Targets that no share meets, as cells without tokens are in the way, are met as far as
    the smallest share tried meets them."""
    low, high = share / 2 ** STEPS, share
    bound = worst_gap(rake(masses, targets, low), targets) + GAP
    if worst_gap(rake(masses, targets, high), targets) <= bound:
        return high
    for _ in range(STEPS):
        middle = (low + high) / 2
        if worst_gap(rake(masses, targets, middle), targets) <= bound:
            low = middle
        else:
            high = middle
    return low


def uniform(*cols: str) -> Column:
    """A number in [0, 1) from the hash of the columns."""
    return F.pmod(F.xxhash64(*cols, F.lit("mix")), F.lit(1 << 52)) / float(1 << 52)


def mix_sources(docs: DataFrame, dims: dict[str, tuple[Column, dict[str, float]]], tokens: Column, draw: Column,
                share: float = SHARE, meet_targets: bool = False) -> DataFrame:
    """``docs`` with ``mix_cell``, ``mix_probability`` and ``mix_kept`` (replaced if present).

    ``share`` of the tokens is kept in expectation; with ``meet_targets`` less, where a category has too
    few tokens for that share: the largest share that meets all targets (see largest_share).
    ``dims``: name -> (value, target share per value; ``*`` for all others and nulls). One small
    aggregation gives the token mass per cell: at most the product of the target sizes, checked
    against MAX_CELLS, whatever the data. A cell without tokens, or with a target of 0, is not
    kept. An empty table stays empty.
    """
    targets = [t for _, t in dims.values()]
    if prod(len(t) + 1 for t in targets) > MAX_CELLS:
        raise ValueError("targets name more than MAX_CELLS cells")
    docs = docs.drop("mix_cell", "mix_probability", "mix_kept")
    cell = F.concat_ws("\x1f", *(cell_of(v, t) for v, t in dims.values()))
    sums = docs.groupBy(cell.alias("c")).agg(F.sum(tokens).cast("double").alias("m")).collect()
    masses = {tuple(r["c"].split("\x1f")): r["m"] or 0.0 for r in sums}
    if meet_targets:
        share = largest_share(masses, targets, share)
    probability = {k: min(1.0, x / masses[k]) for k, x in rake(masses, targets, share).items()}
    pairs = [x for k, p in sorted(probability.items()) for x in (F.lit("\x1f".join(k)), F.lit(p))]
    looked_up = F.coalesce(F.create_map(*pairs)[F.col("mix_cell")], F.lit(0.0)) if pairs else F.lit(0.0)
    return (docs.withColumn("mix_cell", cell).withColumn("mix_probability", looked_up)
            .withColumn("mix_kept", draw < F.col("mix_probability"))
            .withColumn("mix_cell", F.translate("mix_cell", "\x1f", "/")))


def achieved(mixed: DataFrame, targets: dict[str, dict[str, float]], tokens: Column) -> DataFrame:
    """(dimension, category, target, expected, kept) of a mix: the share of the tokens that each category
    was to get, gets in expectation and got by the draw. One aggregate per cell."""
    cells = mixed.groupBy("mix_cell").agg(F.sum(tokens * F.col("mix_probability")).alias("e"),
                                          F.sum(F.when(F.col("mix_kept"), tokens).otherwise(0)).cast("double").alias("k")).collect()
    parts = {tuple(r["mix_cell"].split("/")): (r["e"] or 0.0, r["k"] or 0.0) for r in cells}
    aims = list(targets.values())
    expected, kept = (marginals({c: v[n] for c, v in parts.items()}, aims) for n in (0, 1))
    names = list(targets)
    rows = [(names[d], k, wanted, got, drawn) for (d, k, wanted, got), (_, _, _, drawn) in zip(expected, kept)]
    return mixed.sparkSession.createDataFrame(rows, "dimension string, category string, target double, expected double, kept double")


# Targets of the query: the large source no longer rules, languages and kinds of text even out.
SOURCE_TARGETS = {"src0": 0.20, **{f"src{k}": 0.04 for k in range(1, 20)}, OTHER: 0.04}
LANG_TARGETS = {"en": 0.55, "fr": 0.17, "de": 0.16, "es": 0.12, OTHER: 0.01}
TOPIC_TARGETS = {"prose": 0.87, "licence": 0.03, "listing": 0.025, "contact": 0.04, "code": 0.035}


def topic_of(text: Column) -> Column:
    """Topic by what the text contains; the first that fits. A pattern is tried only on texts that
    hold what every match of it holds (its literals in lower case, where case is ignored), and takes
    linear time, also on very long runs without a space."""
    def holds(value: Column, *literals: str) -> Column:
        return reduce(or_, (F.contains(value, F.lit(x)) for x in literals))

    def of(low: Column) -> Column:
        licence = holds(low, "licence", "license") & text.rlike(r"(?i)\blicen[cs]ed?\b")
        secret = holds(low, "secret", "token", "password", "api_key", "apikey", "akia") & text.rlike(
            r"(?i)(secret|token|password|api_?key)\W{0,3}[:=]|AKIA[0-9A-Z]{16}")
        program = holds(text, "\n") & holds(text, ";", "{", "}") & text.rlike(r"[{};]\s*\n")
        contact = (holds(text, "@") & text.rlike(r"(?<![\w.+-])[\w.+-]++@[\w-]++\.\w")) | text.rlike(r"\d[\d -]{9,}\d")
        listing = holds(text, " | ") & text.rlike(r"\S \| \S+ \| \S")
        return (F.when(licence, "licence").when(secret | program, "code").when(contact, "contact")
                .when(listing, "listing").otherwise("prose"))

    return let(F.lower(text), of)


def mixed_documents(docs: DataFrame, share: float = SHARE, meet_targets: bool = False) -> DataFrame:
    """The query's mix over a table with doc_id, text, lang, source: adds ``n_tokens`` (words:
    runs without white space) and the columns of mix_sources. A null or blank text has no tokens; a null one has topic prose."""
    docs = docs.drop("n_tokens", "topic")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tokens = F.size(F.array_remove(F.split(text, r"\s+"), "")).cast("long")
    docs = docs.withColumns({"n_tokens": tokens, "topic": topic_of(text)})
    dims = {"source": (F.col("source"), SOURCE_TARGETS), "lang": (F.col("lang"), LANG_TARGETS), "topic": (F.col("topic"), TOPIC_TARGETS)}
    return mix_sources(docs, dims, F.col("n_tokens"), uniform("doc_id", "text"), share, meet_targets)


@register("op5_source_mixing")
def op5_source_mixing(spark, sf_dir):
    return mixed_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), meet_targets=True).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.col("mix_probability").alias("probability"), F.col("mix_kept").alias("kept"))
