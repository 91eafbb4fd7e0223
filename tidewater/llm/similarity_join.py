"""N-gram Jaccard join by chosen paths.

Every text is its set of five-word shingles; equal sets are one class. Classes are split
recursively on sampled shared shingles: sample t of a set is its least shingle under hash t
(two sets share it with probability of their Jaccard similarity). ``ROOTS`` independent
samples start the recursion, and repeat it until the target recall; a bucket larger than
``LEAF`` is split again on ``BRANCHES`` further samples, unless most of its members agree on
those too, because then they are alike and splitting finds nothing. In a final bucket
(leaf) all pairs are compared exactly; large leaves in blocks.

A pair at similarity s is lost at the roots with probability (1 - s)^ROOTS: 6e-5 at 0.8.
No bucket, partner or candidate count is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import table, written
from tidewater.llm.components import components
from tidewater.llm.registry import register

WORDS = 5
THRESHOLD = Fraction(4, 5)
SAMPLES = 10        # samples per set that buckets are built from
ROOTS = 6           # of them start a path
BRANCHES = 3        # further samples a large bucket is split on
DEPTH = 6
LEAF = 256
ALIKE = 0.5         # share of a bucket that agrees on a further sample, on average
BLOCK = 2000        # members of a large leaf compared together
PACK_ROWS = 1500    # members of small leaves handed to Python together
MAX_WORDS = 500_000
SEEDS = [np.uint64((0x9E3779B97F4A7C15 * (2 * t + 1)) & (2**64 - 1)) for t in range(SAMPLES)]
MIX = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(32))


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the WORDS-word shingles; a text with fewer words (split at
    white space) is one shingle, one without words has none."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(hashes) > MAX_WORDS:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - WORDS + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(h))):
        out = out * np.uint64(0x100000001B3) + mixed(h[k:k + n] + np.uint64(k))
    return np.unique(mixed(out))


def set_digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def samples(s: np.ndarray) -> list[int]:
    return [int(mixed(s ^ seed).min().view(np.int64)) for seed in SEEDS]


def shared_counts(lists: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """Matrix of |a & b| over lists of distinct values; with ``split`` only those before it
    against those from it on. Frequent values go through a matrix product, rare ones pair by pair."""
    m = len(lists)
    owner = np.repeat(np.arange(m), [len(x) for x in lists])
    values = np.concatenate(lists) if m else np.zeros(0, np.uint64)
    order = np.lexsort((owner, values))
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(values)))
    out = np.zeros((m, m), np.int64)
    often = sizes > 16
    for f in np.unique(sizes[(sizes > 1) & ~often]):
        own = owner[starts[sizes == f][:, None] + np.arange(f)]
        for a in range(f):
            for b in range(a + 1, f):
                out += np.bincount(own[:, a] * m + own[:, b], minlength=m * m).reshape(m, m)
    columns = np.flatnonzero(often)
    for at in range(0, len(columns), 2048):
        part = columns[at:at + 2048]
        dense = np.zeros((m, len(part)), np.float32)
        for k, c in enumerate(part):
            dense[owner[starts[c]:starts[c] + sizes[c]], k] = 1
        out += np.triu((dense @ dense.T).astype(np.int64), 1)
    out += out.T
    return out if split is None else out[:split, split:]


def leaf_links(leaf: int, ids: np.ndarray, weights: np.ndarray, sets: list[np.ndarray], leaves: list[np.ndarray],
               first_block: np.ndarray | None) -> list[tuple[int, int, int]]:
    """Rows (class, weight linked, root) of one leaf: similar pairs whose first common leaf this is.
    ``first_block``: marks members of the first of two blocks; None: all pairs count. ``root`` is
    the least class that links connect it to here."""
    order = np.arange(len(ids)) if first_block is None else np.argsort(~first_block, kind="stable")
    split = None if first_block is None else int(first_block.sum())
    ids, weights = ids[order], weights[order]
    sets, leaves = [sets[k] for k in order], [leaves[k][leaves[k] < leaf] for k in order]
    num, den = THRESHOLD.numerator, THRESHOLD.denominator
    if len(ids) == 2:
        a, b = sets
        shared = len(np.intersect1d(a, b, assume_unique=True))
        if shared * den < num * (len(a) + len(b) - shared) or len(np.intersect1d(*leaves)):
            return []
        root = int(ids.min())
        return [(int(ids[0]), int(weights[1]), root), (int(ids[1]), int(weights[0]), root)]
    shared = shared_counts(sets, split)
    sizes = np.array([len(s) for s in sets])
    rows, cols = (sizes, sizes) if split is None else (sizes[:split], sizes[split:])
    linked = (shared * den >= num * (rows[:, None] + cols[None, :] - shared)) & (shared > 0)
    if any(map(len, leaves)):
        linked &= shared_counts(leaves, split) == 0
    if split is None:
        np.fill_diagonal(linked, False)
        weight = linked @ weights
        a, b = np.nonzero(linked)
    else:
        weight = np.concatenate([linked @ weights[split:], weights[:split] @ linked])
        a, b = np.nonzero(linked)
        b = b + split
    root = np.arange(len(ids))
    least = np.argsort(np.argsort(ids))  # order of classes, so that roots are the least class
    root = least.copy()
    while len(a):  # labels along links until none changes
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, new[a])
        if (new == root).all():
            break
        root = new
    by_order = np.sort(ids)
    return [(int(ids[k]), int(weight[k]), int(by_order[root[k]])) for k in np.flatnonzero(weight > 0)]


def signatures(docs: DataFrame, rows: int = 500) -> DataFrame:
    """(doc_id, text_hash, digest, size, samples) per row of (doc_id, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "digest": [set_digest(s) if len(s) else None for s in sets],
                                "size": [len(s) for s in sets], "samples": [samples(s) if len(s) else None for s in sets]})
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(run, f"doc_id {kind}, text_hash long, digest binary, size int, samples array<long>")


def class_sets(wanted: DataFrame) -> DataFrame:
    """(class, weight, leaves, items) from rows that also have ``text`` and the class's digest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes) for t in batch["text"]]
            right = [set_digest(s) == bytes(d) for s, d in zip(sets, batch["digest"])]
            yield pd.DataFrame({"class": batch["class"], "weight": batch["weight"], "leaves": batch["leaves"],
                                "items": [s.tobytes() for s in sets]})[right]
    return wanted.mapInPandas(run, "class long, weight long, leaves array<struct<leaf:long,n:long>>, items binary")


def find_leaves(classes: DataFrame) -> DataFrame:
    """(class, leaf, n) of the final buckets with two or more classes; ``n`` is their size.
    Buckets with the same members count once."""
    entries = classes.select("class", "samples", F.posexplode(F.slice("samples", 1, ROOTS)).alias("t", "s")).select(
        "class", "samples", F.xxhash64("t", "s").alias("bucket"), F.array("t").alias("used"))
    done = []
    for depth in range(DEPTH + 1):
        sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        entries = written(entries.join(sizes, "bucket"), "buckets")
        done.append(entries.where(F.col("n") <= LEAF).select("class", "bucket", "n"))
        large = entries.where(F.col("n") > LEAF)
        if large.limit(1).count() == 0:
            break
        if depth == DEPTH:
            done.append(large.select("class", "bucket", "n"))
            break
        free = F.filter(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda t: ~F.array_contains("used", t))
        chosen = F.slice(F.array_sort(F.transform(free, lambda t: F.struct(F.xxhash64("bucket", t).alias("h"), t.alias("t")))), 1, BRANCHES)
        split = large.withColumn("c", F.explode(chosen)).select(
            "class", "samples", F.col("bucket").alias("parent"), "n", F.col("c.t").alias("t"),
            F.xxhash64("bucket", "c.t", F.get("samples", F.col("c.t"))).alias("bucket"), F.array_append("used", F.col("c.t")).alias("used"))
        split = written(split, "split")
        agree = (split.groupBy("parent", "n", "t", "bucket").agg(F.count("*").alias("m"))
                 .groupBy("parent", "n", "t").agg(F.max("m").alias("m")).groupBy("parent").agg(F.avg(F.col("m") / F.col("n")).alias("agree")))
        agree = written(agree, "agreement")
        alike = agree.where(F.col("agree") >= ALIKE).select(F.col("parent").alias("bucket"))
        done.append(large.join(alike, "bucket", "left_semi").select("class", "bucket", "n"))
        entries = split.drop("n", "t").join(agree.where(F.col("agree") < ALIKE).select("parent"), "parent", "left_semi").drop("parent")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    same = (found.groupBy("bucket").agg(F.max("n").alias("n"), F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("members"))
            .groupBy("members", "n").agg(F.min("bucket").alias("leaf")))
    return written(found.join(same.select("leaf", F.col("n").alias("size")), F.col("bucket") == F.col("leaf"))
                   .select("class", "leaf", "n"), "leaves")


def compare_leaves(members: DataFrame, n_entries: int) -> DataFrame:
    """(class, weight, root) of every leaf; see leaf_links. Sets move once, to their leaves' tasks."""
    packs = max(1, n_entries // PACK_ROWS)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = members.withColumn("l", F.explode("leaves")).select(
        "class", "weight", "items", F.col("l.leaf").alias("leaf"), F.col("l.n").alias("n"), F.col("leaves.leaf").alias("leaves"))
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    rows = rows.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(
        F.least(own, k).alias("i"), F.greatest(own, k).alias("j"), own.alias("own")))))
    rows = rows.select("class", "weight", "leaves", "items", "leaf", "pair.*", F.when(F.col("n") <= LEAF, F.pmod("leaf", F.lit(packs)))
                       .otherwise(F.xxhash64("leaf", "pair.i", "pair.j")).alias("task"))

    def run(df: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (leaf, i, j), part in df.groupby(["leaf", "i", "j"], sort=False):
            if len(part) > 1:
                sets = [np.frombuffer(x, np.uint64) for x in part["items"]]
                known = [np.sort(np.asarray(x, np.int64)) for x in part["leaves"]]
                out += leaf_links(leaf, part["class"].to_numpy(np.int64), part["weight"].to_numpy(np.int64), sets, known,
                                  None if i == j else (part["own"] == i).to_numpy())
        return pd.DataFrame(out, columns=["class", "weight", "root"])

    return rows.groupBy("task").applyInPandas(run, "class long, weight long, root long")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id``, ``n_links``.

    ``n_links``: other rows whose shingle set has Jaccard similarity THRESHOLD or more, copies
    included. ``class_id``: least id of all rows that links connect. Null texts and texts without
    words link to nothing and are a class of their own. Rows with a null id take part; they never
    name a class unless all its ids are null. An empty table gives an empty result.

    Texts move once (those of a class's representative that has a candidate stay), sets once per leaf.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    signed = written(signatures(rows), "signatures")
    classes = written(signed.where("size > 0").groupBy("digest").agg(
        F.count("*").alias("weight"), F.min("doc_id").alias("least_id"), F.min(F.struct("text_hash", F.xxhash64("text_hash", "doc_id").alias("row_hash"))).alias("chosen"),
        F.first("samples").alias("samples")).withColumn("class", F.monotonically_increasing_id()), "classes")
    leaves = find_leaves(classes)
    per_class = leaves.groupBy("class").agg(F.collect_set(F.struct("leaf", "n")).alias("leaves"))
    wanted = per_class.join(classes.select("class", "weight", "digest", "chosen.*"), "class")
    # Sorted and merged at every size: what is wanted grows with the input, so it is never broadcast. By text
    # and id, so that the copies of one text are spread and two texts of one hash are told apart.
    one = ["text_hash", "row_hash"]
    texts = rows.withColumn("row_hash", F.xxhash64("text_hash", "doc_id")).join(wanted.hint("merge"), one).dropDuplicates([*one, "class"])
    members = class_sets(texts.select("class", "weight", "leaves", "digest", "text"))
    links = written(compare_leaves(members, leaves.count()), "links")
    roots = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")))
    info = (classes.select("class", "digest", "weight", "least_id")
            .join(links.groupBy("class").agg(F.sum("weight").alias("linked")), "class", "left")
            .join(roots.withColumnRenamed("node", "class"), "class", "left")
            .withColumn("root", F.coalesce("root", "class")))
    named = info.groupBy("root").agg(F.min("least_id").alias("class_id"))
    info = info.join(named, "root").select("digest", "class_id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return signed.select("doc_id", "digest").join(info, "digest", "left").select(
        "doc_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


@register("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark, sf_dir):
    return link_documents(table(spark, sf_dir, "documents"))
