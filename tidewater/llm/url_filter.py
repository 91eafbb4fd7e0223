"""URL rules by a bit-parallel wildcard automaton.

All glob rules are packed side by side into the bits of 64-bit words (Shift-And with
self-loops for wildcards), so one pass over a URL advances every rule at once. URLs of a
batch advance together: step t handles the t-th character of all URLs that have one.

Globs: ``?`` one character other than ``/``; ``*`` any run without ``/``; ``**`` any run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.llm.registry import register

BATCH_CELLS = 4_000_000  # URLs of one step together: rows x automaton words


@dataclass(frozen=True)
class Rule:
    """``globs`` are alternatives for one rule; of several fitting rules the one with the
    longest ``name`` wins, then the first."""
    name: str
    verdict: str
    globs: tuple[str, ...]


def host_path_rule(verdict: str, rule: str) -> Rule:
    """``net/`` style rule: the host and its subdomains, paths that start with the rule's."""
    return Rule(rule, verdict, (f"{rule}**", f"*.{rule}**"))


class Automaton:
    """Shift-And masks of many globs. Bits of a glob are consecutive: bit 0 is its start, bit k
    is set when its first k literals are read; a wildcard keeps the bit before it alive."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = list(rules)
        states: list[tuple[int | None, int]] = []  # (literal that leads here, loop: 0 none, 1 not '/', 2 any)
        self.finals: list[tuple[int, int]] = []    # (bit, rule)
        starts = []
        for r, rule in enumerate(self.rules):
            for glob in rule.globs:
                starts.append(len(states))
                states.append((None, 0))
                i = 0
                while i < len(glob):
                    if glob[i] == "*":
                        wide = glob.startswith("**", i)
                        states[-1] = (states[-1][0], 2 if wide else max(1, states[-1][1]))
                        i += 2 if wide else 1
                    else:
                        states.append((-1 if glob[i] == "?" else ord(glob[i]), 0))
                        i += 1
                self.finals.append((len(states) - 1, r))
        self.words = max(1, -(-len(states) // 64))
        self.alphabet = np.array(sorted({c for c, _ in states if c is not None and c >= 0} | {ord("/")}), np.uint32)
        n = len(self.alphabet) + 1  # the last row stands for every other character
        self.advance = np.zeros((n, self.words), np.uint64)
        self.stay = np.zeros((n, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        slash = int(np.searchsorted(self.alphabet, ord("/")))
        for bit, (char, loop) in enumerate(states):
            word, mask = bit // 64, np.uint64(1 << (bit % 64))
            if char is not None and char >= 0:
                self.advance[np.searchsorted(self.alphabet, char), word] |= mask
            elif char == -1:
                self.advance[np.arange(n) != slash, word] |= mask
            if loop:
                self.stay[np.ones(n, bool) if loop == 2 else np.arange(n) != slash, word] |= mask
        for bit in starts:
            self.start[bit // 64] |= np.uint64(1 << (bit % 64))

    def run(self, texts: list[str]) -> np.ndarray:
        """Bits alive after each whole text: (texts, words)."""
        out = np.empty((len(texts), self.words), np.uint64)
        order = np.array(sorted(range(len(texts)), key=lambda k: -len(texts[k])), np.int64)
        step = max(1, BATCH_CELLS // self.words)
        for at in range(0, len(order), step):
            part = order[at:at + step]
            codes = [np.frombuffer(texts[k].encode("utf-32-le", "surrogatepass"), np.uint32) for k in part]
            lengths = np.array([len(c) for c in codes])
            flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
            found = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
            flat = np.where(self.alphabet[found] == flat, found, len(self.alphabet))
            offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            alive = np.tile(self.start, (len(part), 1))
            active = len(part)
            for t in range(int(lengths.max(initial=0))):
                while lengths[active - 1] <= t:  # longest first: the finished ones are at the end
                    active -= 1
                char, bits = flat[offsets[:active] + t], alive[:active]
                moved = bits << np.uint64(1)
                moved[:, 1:] |= bits[:, :-1] >> np.uint64(63)
                alive[:active] = (moved & self.advance[char]) | (bits & self.stay[char])
            out[part] = alive
        return out

    def fitting(self, texts: list[str]) -> np.ndarray:
        """Index of the winning rule per text, -1 where none fits."""
        bits = self.run(texts)
        best = np.full(len(texts), -1, np.int64)
        # the weakest first, so that stronger rules overwrite
        for bit, r in sorted(self.finals, key=lambda f: (len(self.rules[f[1]].name), -f[1])):
            hit = (bits[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
            best[hit.astype(bool)] = r
        return best


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(df: DataFrame, text_col: str, rule_sets: dict[str, list[Rule]], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``df`` plus, per rule set, the winning rule's name and verdict
    (``<set>_rule``, ``<set>_verdict``; null where none fits). The sets run as one automaton
    each. A null text fits nothing."""
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([df.schema[c] for c in keep] + [
        StructField(f"{s}_{x}", StringType()) for s in rule_sets for x in ("rule", "verdict")])
    sets = {k: list(v) for k, v in rule_sets.items()}

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automata = {k: Automaton(v) for k, v in sets.items()}
        for batch in batches:
            texts = batch["__text"].tolist()
            known = [t if t is not None else "" for t in texts]
            out = batch[keep].copy()
            for k, a in automata.items():
                best = a.fitting(known) if known else np.zeros(0, np.int64)
                best = np.where([t is None for t in texts], -1, best) if texts else best
                out[f"{k}_rule"] = [a.rules[r].name if r >= 0 else None for r in best]
                out[f"{k}_verdict"] = [a.rules[r].verdict if r >= 0 else None for r in best]
            yield out

    return df.select(*keep, F.col(text_col).alias("__text")).mapInPandas(judge, schema)


# Host and path rules of the query, and the globs for URLs that none of them fits.
SITE_RULES = [host_path_rule("block", "net/"), host_path_rule("allow", "example.net/en/"),
              host_path_rule("block", "example.com/de/"), host_path_rule("allow", "org/fr/")]
DEFAULT_RULES = [Rule(name, "block", globs) for name, globs in (
    ("ads", ("ads.*/**", "ads-*/**", "*.ads.*/**", "*.ads-*/**", "ad.*/**", "*.ad.*/**")),
    ("casino", ("*casino*/**", "*casino*")),
    ("tracker", ("track.*/**", "*.track.*/**", "*-track.*/**", "*.tracking.*/**")),
    ("adult", ("*porn*/**", "*.xxx/**", "*-xxx.*/**")),
    ("login", ("**/wp-login.php*", "**/wp-admin/**")),
    ("binary", ("**.exe", "**.zip", "**.iso", "**.dmg")),
)]


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, the site rule that fits (or null) and the
    verdict: the site rule's, else ``block`` if a default glob fits, else ``allow``.

    The automata read host + path. A null url or one without ``://`` has empty host and path,
    no rule and verdict ``allow``. Null or repeated ids change nothing; no other column is read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("canonical", F.concat("host", "path"))
    judged = match_rules(rows, "canonical", {"site": SITE_RULES, "default": DEFAULT_RULES}, ["page_id", "host", "path"])
    return judged.select("page_id", "host", "path", F.col("site_rule").alias("rule"),
                         F.coalesce("site_verdict", "default_verdict", F.lit("allow")).alias("verdict"),
                         F.when(F.col("site_rule").isNull(), F.col("default_rule")).alias("default_rule"))


def glob_regex(glob: str) -> str:
    """The same glob as a regular expression, for the SQL check."""
    import re
    out = re.split(r"(\*\*|\*|\?)", glob)
    return "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(x, re.sub(r"([.^$+(){}|\[\]\\])", r"\\\1", x)) for x in out)


def oracle() -> str:
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{r.name}'"
            for r in sorted(SITE_RULES, key=lambda r: -len(r.name)) for h, _, p in [r.name.partition("/")]]
    verdicts = " ".join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in SITE_RULES)
    globs = " ".join(f"WHEN {' OR '.join(f"regexp_full_match(host || path, '{glob_regex(g)}', 's')" for g in r.globs)} THEN '{r.name}'"
                     for r in sorted(DEFAULT_RULES, key=lambda r: -len(r.name)))
    return f"""
WITH u AS (SELECT page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') AS h,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
v AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r AS (SELECT *, CASE {' '.join(fits)} END AS rule FROM v),
d AS (SELECT *, CASE WHEN rule IS NULL THEN CASE {globs} END END AS default_rule FROM r)
SELECT page_id, host, path, rule, CASE {verdicts} WHEN default_rule IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  default_rule FROM d"""


@register("op3_url_filter", oracle())
def op3_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))
