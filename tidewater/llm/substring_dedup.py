"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over TRIGGER bytes cuts texts into phrases where it falls on chosen values, so
cuts depend on content alone. A string of LENGTH bytes that starts inside a phrase is that
phrase's suffix (``l`` bytes up to the next trigger) followed by the next LENGTH - l bytes of
the parse; two strings are equal only if they have the same ``l`` and agree on both sides of
the trigger. Repeats are found on distinct (suffix, context) classes, so copies cost a row,
not a comparison, and all strings of a phrase are first judged together:

1. Starts with the same trigger and a similar ``l`` form a run. All strings of a run share a
   core; runs whose core occurs once in the corpus are done (one hash per run, most end here).
2. The other runs compare their unions, the bytes of all their strings: equal unions repeat
   wholly.
3. Only runs at the edge of a repeat are left; there every string is compared by a 128-bit hash.

Only the classes' equality is needed here, not their order, so they are grouped by hash instead
of being sorted into one suffix array, which no single task could hold.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import shared_path, shuffle_partitions, table, written
from tidewater.llm.registry import register

LENGTH = 400
TRIGGER = 16
RARE, OFTEN = 7, 4   # triggers: hashes whose top bits are 0; the second kind where the first leaves gaps
BAND = 64            # values of l judged together
CHUNK = 1 << 20      # starts handled at a time within a text
OUT_ROWS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def trigger_hash(data: np.ndarray) -> np.ndarray:
    """Rolling hash of every TRIGGER-byte string (Karp-Rabin modulo 2^64, by doubling)."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _ODD
    h ^= h >> np.uint64(29)
    base, size = np.uint64(0xD6E8FEB86659FD93), 1
    while size < TRIGGER:
        h = h[:-size] * base + h[size:] if len(h) > size else h[:0]
        base, size = base * base, 2 * size
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h


def next_at(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first of the sorted ``places`` at or after each start; far away where there is none."""
    return np.append(places, np.int64(1) << 60)[np.searchsorted(places, starts)]


def runs_of(data: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (first start, last start, core from, core to, kind and band) of the runs, a chunk of
    starts at a time; kind -1: no trigger inside."""
    n = len(data) - length + 1
    with np.errstate(over="ignore"):
        for c0 in range(0, max(0, n), CHUNK):
            c1 = min(n, c0 + CHUNK)
            h = trigger_hash(np.frombuffer(data, np.uint8, c1 - c0 + length - 1, c0))
            starts = np.arange(c1 - c0)
            reach = length - TRIGGER  # a trigger this far is still inside the string
            owner = next_at(np.flatnonzero(h >> np.uint64(64 - RARE) == 0), starts)
            other = next_at(np.flatnonzero(h >> np.uint64(64 - OFTEN) == 0), starts)
            kind = np.where(owner - starts <= reach, 0, np.where(other - starts <= reach, 1, 2))
            owner = np.choose(kind, [owner, other, starts])
            band = np.where(kind == 2, -1, (owner - starts) // BAND)
            key = (owner * 8 + band + 1) * 4 + kind
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            last = np.append(first[1:], len(key)) - 1
            b, j = owner[first], band[first]
            far = np.minimum(j * BAND + BAND - 1, reach)
            lo = np.where(j < 0, first, b - j * BAND) + c0
            hi = np.where(j < 0, first + length, b + length - far) + c0
            kinds = np.where(j < 0, -1, j + 8 * kind[first])
            yield first + c0, last + c0, lo, hi, kinds


def _batches(parts: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of OUT_ROWS rows or a little more from tuples of equally long columns; a scalar stands
    for a whole column."""
    out: list[tuple] = []
    n = 0

    def frame() -> pd.DataFrame:
        whole = [tuple(x if isinstance(x, np.ndarray) else np.full(len(part[0]), x) for x in part) for part in out]
        return pd.DataFrame({c: np.concatenate([part[k] for part in whole]) if whole else np.zeros(0, np.int64)
                             for k, c in enumerate(columns)})

    for part in parts:
        out.append(part)
        n += len(part[0])
        if n >= OUT_ROWS:
            yield frame()
            out, n = [], 0
    yield frame()


def digests_128(pieces) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of a 128-bit hash of each piece."""
    import xxhash
    digest = xxhash.xxh3_128_digest
    halves = np.frombuffer(b"".join([digest(x) for x in pieces]), ">i8").reshape(-1, 2)
    return halves[:, 0].astype(np.int64), halves[:, 1].astype(np.int64)


def places_of(runs) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of listed runs."""
    place = np.array([r["place"] for r in runs], np.int64)
    return place >> 9, (place >> 9) + (place & 511)


def core_rows(texts: DataFrame) -> DataFrame:
    """(core, rid, place, w) of every run; ``place`` = first start * 512 + (last - first)."""
    def run(batches):
        import xxhash
        digest = xxhash.xxh3_64_intdigest

        def parts():
            for b in batches:
                for rid, data, w in zip(b["rid"], b["data"], b["w"]):
                    view = memoryview(data)
                    for first, last, lo, hi, kind in runs_of(data):
                        core = np.array([digest(view[i:j], k) for i, j, k in zip(lo.tolist(), hi.tolist(), (kind + 1).tolist())], np.uint64)
                        yield core.view(np.int64), rid, first * 512 + (last - first), w
        return _batches(parts(), ["core", "rid", "place", "w"])
    return texts.select("rid", "data", "w").mapInPandas(run, "core long, rid long, place long, w int")


def union_rows(texts: DataFrame) -> DataFrame:
    """(core, u1, u2, rid, place, w) for the listed ``runs`` of each text."""
    def run(batches):
        def parts():
            for b in batches:
                for rid, data, w, runs in zip(b["rid"], b["data"], b["w"], b["runs"]):
                    view = memoryview(data)
                    first, last = places_of(runs)
                    u1, u2 = digests_128(view[i:j] for i, j in zip(first.tolist(), (last + LENGTH).tolist()))
                    yield np.array([r["core"] for r in runs], np.int64), u1, u2, rid, first * 512 + (last - first), w
        return _batches(parts(), ["core", "u1", "u2", "rid", "place", "w"])
    return texts.select("rid", "data", "w", "runs").mapInPandas(run, "core long, u1 long, u2 long, rid long, place long, w int")


def string_rows(texts: DataFrame) -> DataFrame:
    """(d1, d2, rid, start, w) of every string of the listed runs; ``rid`` is -1 where the run is
    known to repeat and only counts."""
    def run(batches):
        def parts():
            for b in batches:
                for rid, data, runs in zip(b["rid"], b["data"], b["runs"]):
                    view = memoryview(data)
                    first, last = places_of(runs)
                    sizes = last - first + 1
                    start = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                    w = np.repeat(np.array([r["w"] for r in runs], np.int64), sizes)
                    d1, d2 = digests_128(view[s:s + LENGTH] for s in start.tolist())
                    yield d1, d2, np.where(w < 2, rid, -1), start, w
        return _batches(parts(), ["d1", "d2", "rid", "start", "w"])
    return texts.select("rid", "data", "runs").mapInPandas(run, "d1 long, d2 long, rid long, start long, w int")


def cut_rows(texts: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) after removing ``spans``."""
    def run(batches):
        for b in batches:
            out = []
            for doc_id, data, spans in zip(b["doc_id"], b["data"], b["spans"]):
                kept, at, removed, n, end = hashlib.sha256(), 0, 0, 0, -1
                for s, e in sorted((x["s"], x["e"]) for x in spans):
                    if s > end:
                        n += 1
                    s = max(s, at)
                    if e > s:
                        kept.update(data[at:s])
                        removed += e - s
                        at = e
                    end = max(end, e)
                kept.update(data[at:])
                out.append((doc_id, len(data), removed, n, kept.hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "data", "spans").mapInPandas(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def texts_by_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, doc_id, data, sha) dealt out by ``rid``, a number of each row, and kept that way in a
    bucketed table of the shared folder: joins on ``rid`` never move the texts again."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    rows = rows.withColumn("sha", F.sha2("data", 256)).withColumn("rid", F.monotonically_increasing_id())
    n, name = shuffle_partitions(spark), f"llm_texts_{uuid.uuid4().hex}"
    (rows.repartition(n, "rid").write.bucketBy(n, "rid").sortBy("rid").format("parquet").option("compression", "zstd")
     .option("path", shared_path(spark, "texts")).saveAsTable(name))
    return spark.table(name)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, after removing each byte covered by a LENGTH-byte string that also starts
    elsewhere, in the same text or another. Null texts are empty; rows are told apart by
    position, so null and repeated ids are fine. An empty table gives an empty result.

    Whole copies are recognised first and one of them stands for all (weight 2: "repeats").
    """
    texts = texts_by_row(docs, id_col, text_col)
    size = F.octet_length("data")
    copies = texts.groupBy("sha").agg(F.count("*").alias("copies"), F.min("rid").alias("least"))
    info = texts.select("rid", "sha").join(copies, "sha").select(
        F.col("rid").alias("i_rid"), F.least("copies", F.lit(2)).cast("int").alias("w"), (F.col("rid") == F.col("least")).alias("stands"))
    info = written(info, "copies")
    rows = texts.join(info, F.col("rid") == F.col("i_rid")).drop("i_rid")
    stand_ins = rows.where(F.col("stands") & (size >= LENGTH))

    # Written before the join: a core that is very common (a sentence repeated many times has the
    # same core in each period) lies in one partition, which Spark splits only if its sums are not
    # made there too.
    again = written(core_rows(stand_ins).groupBy("core").agg(F.sum("w").alias("n")).where("n > 1").select(F.col("core").alias("c")), "cores")
    repeated = core_rows(stand_ins).select("core", "rid", "place").join(again, F.col("core") == F.col("c"), "left_semi")
    per_text = repeated.groupBy("rid").agg(F.collect_list(F.struct("core", "place")).alias("runs")).withColumnRenamed("rid", "r")
    unions = written(union_rows(stand_ins.join(per_text, F.col("rid") == F.col("r"))), "unions")

    classes = unions.groupBy("u1", "u2").agg(F.sum("w").alias("n"), F.min(F.struct("rid", "place")).alias("at"), F.min("core").alias("core"))
    classes = written(classes, "union-classes")
    whole = unions.join(classes.where("n > 1").select(F.col("u1").alias("a"), F.col("u2").alias("b")),
                        (F.col("u1") == F.col("a")) & (F.col("u2") == F.col("b")), "left_semi").where("w = 1")
    whole = whole.select("rid", F.shiftright("place", 9).alias("s"),
                         (F.shiftright("place", 9) + F.col("place").bitwiseAND(511) + LENGTH).alias("e"))

    edges = classes.where("n = 1").select(F.col("core").alias("c")).distinct()
    part = classes.join(edges, F.col("core") == F.col("c"), "left_semi")
    listed = part.groupBy(F.col("at.rid").alias("r")).agg(F.collect_list(F.struct(
        F.col("at.place").alias("place"), F.least("n", F.lit(2)).cast("int").alias("w"))).alias("runs"))
    strings = written(string_rows(rows.join(listed, F.col("rid") == F.col("r"))), "strings")
    more = strings.groupBy("d1", "d2").agg(F.sum("w").alias("n")).where("n > 1").select(F.col("d1").alias("a"), F.col("d2").alias("b"))
    single = (strings.where("rid >= 0").join(more, (F.col("d1") == F.col("a")) & (F.col("d2") == F.col("b")), "left_semi")
              .select("rid", F.col("start").alias("s"), (F.col("start") + LENGTH).alias("e")))

    spans = whole.unionByName(single).groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("spans")).withColumnRenamed("rid", "r")
    judged = rows.join(spans, F.col("rid") == F.col("r"), "left")
    copied = (F.col("w") > 1) & (size >= LENGTH)
    whole_text = judged.where(copied | (F.col("w") > 1) | F.col("spans").isNull()).select(
        "doc_id", size.cast("long").alias("n_bytes"), F.when(copied, size).otherwise(0).cast("long").alias("n_removed"),
        copied.cast("long").alias("n_spans"), F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha")).alias("kept_sha256"))
    return whole_text.unionByName(cut_rows(judged.where((F.col("w") == 1) & F.col("spans").isNotNull())))


@register("op4_substring_dedup")
def op4_substring_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))
