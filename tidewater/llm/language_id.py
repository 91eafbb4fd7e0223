"""Hierarchical language identification.

First the language family is predicted, then one-versus-one linear support vector machines
separate the languages within it. Features are square-rooted, length-normalised counts of
hashed character 1- to 3-grams of the whole text. All machines are fitted here, on a sample
of labelled rows that is bounded per language (``MAX_TRAIN``, ``MIN_ROWS``); prediction is a
narrow pass. Every label that has a text with a letter is learned: more than ``WIDTH`` families
are first gathered into groups of alike ones, so sample and machines grow in proportion to the
number of labels (each about 130 KB a label).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import table, written
from tidewater.llm.registry import register

MAX_TRAIN = 1600      # rows the machines are fitted on, spread evenly over the languages
MIN_ROWS = 8          # but so many of each, or all it has, however many languages there are
WIDTH = 64            # families that are separated at once; more are gathered into groups
GROUPS = 16           # groups that families are gathered into, again and again down to so many
DIMS = 4096
FAMILIES = {  # codes outside the table are a family of their own
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "germanic": ("en", "de", "nl", "af", "lb", "da", "sv", "no", "nb", "nn", "is", "fo"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt", "am"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _letter_table() -> np.ndarray:
    """Code point -> lower-case code point of a letter, else a space (basic plane)."""
    out = np.full(0x10000, ord(" "), np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_LETTERS: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Lower-case letters of ``text`` with every run of other characters as one space."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _LETTERS[0][np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        out[high] = [c if chr(c).isalpha() else 32 for c in codes[high]]
    out = np.concatenate([[np.uint32(32)], out, [np.uint32(32)]])
    space = out == 32
    return out[~(space & np.concatenate([[False], space[:-1]]))]


def features(texts: list[str], dims: int = DIMS) -> np.ndarray:
    """(texts, dims) float32 rows of unit length; zero rows for texts without a letter."""
    out = np.zeros((len(texts), dims), np.float32)
    for r, text in enumerate(texts):
        c = letters(text).astype(np.uint64)
        if len(c) < 3:
            continue
        grams = [c, c[:-1] * np.uint64(1 << 21) + c[1:], (c[:-2] * np.uint64(1 << 21) + c[1:-1]) * np.uint64(1 << 21) + c[2:]]
        for k, g in enumerate(grams):
            h = ((g + np.uint64(k)) * _PRIME) >> np.uint64(64 - int(dims).bit_length() + 1)
            out[r] += np.bincount(h.astype(np.int64), minlength=dims)[:dims]
    np.sqrt(out, out=out)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 30.0, steps: int = 150) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, classes weighted equally, by accelerated gradient
    steps. ``y`` is +1 or -1; returns weights and bias."""
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * c
    xb = np.hstack([x, np.ones((n, 1), np.float32)])
    y, weight = y.astype(np.float32), weight.astype(np.float32)
    w = v = np.zeros(d + 1, np.float32)
    lip = 1.0 + 2 * c * 2.0  # rows have length sqrt(2), weights sum to c
    for t in range(steps):
        slack = np.maximum(0.0, 1 - y * (xb @ v))
        grad = v - 2 * xb.T @ (weight * slack * y)
        new = v - grad / np.float32(lip)
        v, w = new + np.float32(t / (t + 3)) * (new - w), new
    return w[:d], float(w[d])


@dataclass
class OneVersusOne:
    classes: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    biases: np.ndarray | None = None

    def fit(self, x: np.ndarray, labels: np.ndarray) -> "OneVersusOne":
        self.pairs = list(combinations(range(len(self.classes)), 2))
        found = []
        for a, b in self.pairs:
            rows = (labels == self.classes[a]) | (labels == self.classes[b])
            found.append(fit_svm(x[rows], np.where(labels[rows] == self.classes[a], 1.0, -1.0)))
        if found:
            self.weights, self.biases = np.stack([f[0] for f in found]), np.array([f[1] for f in found])
        return self

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner by votes (margins break ties) and its lowest chance against any other class."""
        if not self.pairs:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        chance = 1 / (1 + np.exp(-np.clip(4.0 * (x @ self.weights.T + self.biases), -30, 30)))
        votes = np.zeros((len(x), len(self.classes)))
        least = np.ones((len(x), len(self.classes)))
        for k, (a, b) in enumerate(self.pairs):
            votes[:, a] += (chance[:, k] > 0.5) + 1e-3 * chance[:, k]
            votes[:, b] += (chance[:, k] <= 0.5) + 1e-3 * (1 - chance[:, k])
            least[:, a] = np.minimum(least[:, a], chance[:, k])
            least[:, b] = np.minimum(least[:, b], 1 - chance[:, k])
        best = votes.argmax(axis=1)
        return best, least[np.arange(len(x)), best]


def halves(centres: np.ndarray, parts: int) -> list[np.ndarray]:
    """Row numbers in at most ``parts`` groups of alike rows of about equal size: the largest group
    is halved along the direction in which it spreads most."""
    groups = [np.arange(len(centres))]
    while len(groups) < parts:
        groups.sort(key=len)
        big = groups.pop()
        x = centres[big] - centres[big].mean(axis=0)
        along = x[np.linalg.norm(x, axis=1).argmax()]
        for _ in range(30):
            along = x.T @ (x @ along)
            along = along / max(float(np.linalg.norm(along)), 1e-12)
        order = big[np.argsort(x @ along, kind="stable")]
        groups += [np.sort(order[:len(order) // 2]), np.sort(order[len(order) // 2:])]
    return sorted(groups, key=lambda g: int(g[0]))


class Grouped:
    """Separates any number of classes: at most ``width`` of them one versus one, more by their group
    first and then within it."""

    def __init__(self, classes: list[str]):
        self.classes = classes
        self.machines = OneVersusOne(classes)
        self.groups: list[np.ndarray] = []
        self.within: list[Grouped] = []

    def fit(self, x: np.ndarray, labels: np.ndarray, width: int = WIDTH, parts: int = GROUPS) -> "Grouped":
        if len(self.classes) <= width:
            self.machines.fit(x, labels)
            return self
        at = np.searchsorted(np.array(self.classes, object), labels)
        self.groups = halves(np.stack([x[at == k].mean(axis=0) for k in range(len(self.classes))]), parts)
        group = np.empty(len(self.classes), np.int64)
        for g, members in enumerate(self.groups):
            group[members] = g
        own = group[at]
        names = np.array([f"{g:03}" for g in range(len(self.groups))], object)
        self.machines = OneVersusOne(names.tolist()).fit(x, names[own])
        self.within = [Grouped([self.classes[k] for k in members]).fit(x[own == g], labels[own == g], parts, parts)
                       for g, members in enumerate(self.groups)]
        return self

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, score = self.machines.predict(x)
        if self.groups:
            best, score, group = np.zeros(len(x), np.int64), score.copy(), best
            for g, members in enumerate(self.groups):
                rows = np.where(group == g)[0]
                if len(rows):
                    inner, chance = self.within[g].predict(x[rows])
                    best[rows] = members[inner]
                    score[rows] *= chance
        return best, score


@dataclass
class LanguageModel:
    families: Grouped
    within: dict[str, OneVersusOne]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score (chance of the family times that of the language in it)."""
        langs = np.full(len(texts), "und", object)
        scores = np.zeros(len(texts))
        if not self.families.classes or not texts:
            return langs.tolist(), scores
        x = features(texts)
        known = np.linalg.norm(x, axis=1) > 0
        family, score = self.families.predict(x)
        for k, name in enumerate(self.families.classes):
            rows = np.where(known & (family == k))[0]
            if len(rows):
                model = self.within[name]
                best, inner = model.predict(x[rows])
                langs[rows] = [model.classes[b] for b in best]
                scores[rows] = score[rows] * inner
        return langs.tolist(), scores


def fit_languages(labelled: DataFrame, max_train: int = MAX_TRAIN, min_rows: int = MIN_ROWS) -> LanguageModel:
    """Fits on rows of (key, text, lang), all non-null: an equal share of ``max_train`` per language
    that has a text with a letter, and at least ``min_rows`` of each that has so many.

    Per language the rows with the least hashes of (key, text) are taken, equal rows once, so the
    sample depends on the rows alone. Hashes are thinned to a few times the share before they are
    collected, and the texts of the least ones are fetched.
    """
    usable = labelled.where(F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("key", "text").alias("u"))
    distinct = written(usable.select("lang", "u").distinct(), "labelled")
    counts = distinct.groupBy("lang").count().toPandas()
    if not len(counts):
        return LanguageModel(Grouped([]), {})
    share = max(min_rows, max_train // len(counts))
    # 2 * share + 32 are expected below the bound: fewer than the share come once in 1e10 languages.
    counts["bound"] = ((2 * share + 32) / counts["count"]).clip(upper=1.0)
    spark = labelled.sparkSession
    bounds = spark.createDataFrame(list(zip(counts["lang"], counts["bound"].astype(float))), "lang string, bound double")
    some = distinct.join(F.broadcast(bounds), "lang").where(F.col("u") / 2.0 ** 64 + 0.5 <= F.col("bound")).select("lang", "u").toPandas()
    cuts = some.sort_values("u").groupby("lang")["u"].apply(lambda u: int(u.iloc[:share].iloc[-1]))
    cuts = spark.createDataFrame(list(cuts.items()), "lang string, cut long")
    rows = (usable.join(F.broadcast(cuts), "lang").where(F.col("u") <= F.col("cut"))
            .dropDuplicates(["lang", "u"]).select("lang", "text").toPandas())
    x, labels = features(rows["text"].tolist()), rows["lang"].to_numpy(object)
    known = np.linalg.norm(x, axis=1) > 0
    x, labels = x[known], labels[known]
    order = np.lexsort((x @ np.arange(x.shape[1]), labels.astype(str)))  # not the order of arrival
    x, labels = x[order], labels[order]
    family = np.array([FAMILY_OF.get(v, v) for v in labels], object)
    within = {f: OneVersusOne(sorted(set(labels[family == f]))).fit(x[family == f], labels[family == f]) for f in sorted(set(family))}
    return LanguageModel(Grouped(sorted(set(family))).fit(x, family), within)


def identify(rows: DataFrame, model: LanguageModel, text_col: str = "text", batch: int = 500) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score``; null or letterless texts are ``und`` with score 0."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    keep = [f for f in rows.schema.fields if f.name not in ("lang_pred", "score")]
    schema = StructType([*keep, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at:at + batch]
                langs, scores = model.predict([t if isinstance(t, str) else "" for t in part[text_col]])
                yield part.assign(lang_pred=langs, score=scores)

    return rows.select([f.name for f in keep]).mapInPandas(predict, schema)


def held_out_row(id_col: str = "doc_id"):
    """crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``.

    Learns from rows with id, text and lang whose id is not held out; predictions read the text
    alone. Without any such row everything is ``und``. Repeated rows are judged alike.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = rows.where(~held_out_row() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = fit_languages(labelled.withColumnRenamed("doc_id", "key"))
    judged = identify(rows.select("doc_id", held_out_row().alias("held_out"), "text"), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score")


@register("op10_language_id")
def op10_language_id(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents"))
