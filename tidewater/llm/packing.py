"""Best-fit packing planned on a histogram of lengths.

Best-fit decreasing runs over counts per length, not over documents: all pieces of one
length are placed together, so planning takes as long for 100 TB as for 100 MB and its
result is a bounded table of slots. Pieces take their slots by their rank within their length.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewater.llm.common import shuffle_partitions, table, written
from tidewater.llm.registry import register

CAPACITY = 2048
END_ID = 0             # closes every document
MAX_WORDS = 700_000    # words whose ids a worker keeps; beyond that it starts anew
MAX_WORD_LENGTH = 64   # longer words are not kept
GROUP_ROWS = 500       # rows ranked together; larger lengths are split into groups


class WordTokenizer:
    """Ids by a tokenizer that never joins text across white space and marks the last token of a
    word: each distinct word (run without ASCII space) is encoded once, its ids are remembered as
    little-endian bytes. Words of letters alone are lower-cased here, encoded many to a call by
    the same model without its text normaliser, and told apart by the mark; a mark of punctuation
    after such a word is a word of its own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; idle threads cost time
        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.letters_only = Tokenizer(self.tokenizer.model)
        self.letters_only.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True

    def _one_by_one(self, words: list[str]) -> None:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(words, encoded))

    def _together(self, words: list[str]) -> None:
        parts = [words[k:k + 500] for k in range(0, len(words), 500)]
        for part, e in zip(parts, self.letters_only.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            to = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(to) != len(part):
                self._one_by_one(part)
                continue
            data, to = ids.tobytes(), to.tolist()
            self.known.update((w, data[i:j]) for w, i, j in zip(part, [0, *to], to))

    def learn(self, words: set[str]) -> None:
        known, letters, others, marked, cased = self.known, set(), [], [], []
        for w in words:
            stem = w if w.isalpha() else w[:-1]
            if len(w) > MAX_WORD_LENGTH or not stem.isalpha() or stem is not w and w[-1] not in ".,;:!?":
                others.append(w)
                continue
            low = stem.lower()
            # Lower case that depends on the neighbours, or is more than letters, and composed
            # forms are left to the tokenizer's own normaliser.
            if not stem.isascii() and ("Σ" in stem or not low.isalpha() or not is_normalized("NFC", stem)):
                others.append(w)
                continue
            if stem is not w:
                marked.append((w, stem, w[-1]))
            if low != stem:
                cased.append((stem, low))
            if low not in known:
                letters.add(low)
        self._together(list(letters))
        if others:
            self._one_by_one(others)
        marks = [m for m in ".,;:!?" if m not in known]
        if marks:
            self._one_by_one(marks)
        known.update((stem, known[low]) for stem, low in cased)
        known.update((w, known[stem] + known[mark]) for w, stem, mark in marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids and the end id, four bytes each."""
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        new = set()
        for words in split:
            new.update(words)
        new = new.difference(self.known)  # looks up each new word; difference_update would walk through all known ones
        if new:
            self.learn(new)
        get, end = self.known.__getitem__, np.array([END_ID], "<u4").tobytes()
        out = [b"".join(map(get, words)) + end for words in split]
        for w in new:
            if len(w) > MAX_WORD_LENGTH:
                del self.known[w]
        return out


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that its later tasks know the words of the earlier ones."""
    return WordTokenizer(path)


def cut_into_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                    text_col: str = "text", rows: int = 250, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``row_key``
    (and ``ids`` with ``keep_ids``). ``row_key`` tells repeated rows apart; it is drawn once here.

    Only documents longer than ``capacity`` are cut. Null and empty texts are the end id alone.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_tokenizer(tokenizer_path)
        rng = np.random.default_rng()
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at:at + rows]
                out = defaultdict(list)
                for doc, ids in zip(part["doc_id"], words.encode(part["text"].tolist())):
                    for k, start in enumerate(range(0, len(ids) // 4, capacity)):
                        one = ids[4 * start:4 * (start + capacity)]
                        for name, value in (("doc_id", doc), ("piece", k), ("start", start), ("length", len(one) // 4), ("ids_crc32", zlib.crc32(one))):
                            out[name].append(value)
                        if keep_ids:
                            out["ids"].append(np.frombuffer(one, "<u4").astype(np.int64))
                out["row_key"] = rng.integers(0, 1 << 62, len(out["piece"]))
                frame = pd.DataFrame({f.name: pd.Series(out[f.name], dtype="object" if f.name in ("doc_id", "ids") else None)
                                      for f in schema.fields})
                yield frame

    got = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    fields = [got.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("row_key", T.LongType())]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.LongType()))] * keep_ids)
    return got.mapInPandas(run, schema)


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts. Rows (length, first_rank, n, first_sequence, per_sequence,
    offset): the pieces of that length with ranks first_rank.. fill ``per_sequence`` places each,
    from ``offset`` on, in the sequences first_sequence.. .

    Open sequences are kept as ranges of equal free space. A length goes to the least free space
    that takes it, a sequence at a time, as piecewise best fit would do; each touch of a range
    uses up free space and each length splits at most one range, so the plan's size depends on
    ``capacity`` alone.
    """
    if any(n and not 0 < x <= capacity for x, n in histogram.items()):
        raise ValueError("a piece is longer than the capacity")
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> (first sequence, n)
    spaces: list[int] = []                                      # sorted keys of free
    slots, sequences = [], 0

    def add(space: int, first: int, n: int) -> None:
        if space and n:
            if not free[space]:
                bisect.insort(spaces, space)
            free[space].append((first, n))

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = free[space].pop()
                if not free[space]:
                    spaces.pop(at)
            else:
                space, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            per = space // length
            whole = min(n, left // per)
            if whole:
                slots.append((length, rank, whole * per, first, per, capacity - space))
                add(space - per * length, first, whole)
                rank, left = rank + whole * per, left - whole * per
            if left and whole < n:  # the last sequence takes fewer
                slots.append((length, rank, left, first + whole, left, capacity - space))
                add(space - left * length, first + whole, 1)
                rank, whole, left = rank + left, whole + 1, 0
            add(space, first + whole, n - whole)
    return slots


def assign_slots(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` and ``row_key``, from a written table) plus ``sequence_id`` and
    ``offset``. Ranks within a length are counted in groups: rows of a hot length are dealt to many
    groups by ``row_key``, ranked inside them and shifted by the sizes of the groups before."""
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = plan_slots(counts, capacity)
    plan = spark.createDataFrame(slots or [(0, 0, 0, 0, 1, 0)], "s_length long, first_rank long, n long, first_sequence long, per_sequence long, s_offset long")
    group_rows = max(GROUP_ROWS, sum(counts.values()) // (64 * shuffle_partitions(spark)))
    sizes = spark.createDataFrame([(int(k), max(1, n // group_rows)) for k, n in counts.items()] or [(0, 1)], "g_length long, n_groups long")
    grouped = pieces.join(F.broadcast(sizes), F.col("length") == F.col("g_length")).withColumn("g", F.pmod(F.xxhash64("row_key"), F.col("n_groups"))).drop("g_length", "n_groups")
    before = Window.partitionBy("length").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (grouped.groupBy("length", "g").agg(F.count("*").alias("m"))
              .select(F.col("length").alias("b_length"), F.col("g").alias("b_g"),
                      F.coalesce(F.sum("m").over(before), F.lit(0)).alias("shift")))
    inside = Window.partitionBy("length", "g").orderBy("row_key", *[c for c in ("doc_id", "piece") if c in pieces.columns])
    ranked = (grouped.withColumn("r", F.row_number().over(inside) - 1)
              .join(shifts, (F.col("length") == F.col("b_length")) & (F.col("g") == F.col("b_g")))
              .withColumn("r", F.col("r") + F.col("shift")).drop("b_length", "b_g", "shift", "g"))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("s_length")) & (F.col("r") >= F.col("first_rank"))
                         & (F.col("r") < F.col("first_rank") + F.col("n")))
    step = F.col("r") - F.col("first_rank")
    return placed.withColumns({
        "sequence_id": F.col("first_sequence") + F.floor(step / F.col("per_sequence")).cast("long"),
        "offset": F.col("s_offset") + F.pmod(step, F.col("per_sequence")) * F.col("length"),
    }).drop("r", "s_length", "first_rank", "n", "first_sequence", "per_sequence", "s_offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of ``docs`` with their places. Every row of ``docs`` is packed, repeated ids too; an
    empty table gives an empty result. Pieces are written once, so a lost task can't change ranks."""
    pieces = written(cut_into_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    return assign_slots(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    import public_tokenizers
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
