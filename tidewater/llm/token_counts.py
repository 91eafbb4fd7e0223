"""Token counts under a unigram model, by dynamic programming shared along a trie.

A pre-token's best segmentation is found by forward scores: best(i) = max over vocabulary
pieces that end at i of best(start) + score. best(i) depends only on the first i
characters, so pre-tokens with a common prefix share those values. The distinct pre-tokens
of a batch are walked in sorted order, which is depth-first order of their trie: a stack
holds the values of the current path, each trie node is computed once, and the token count
at each terminal is stored and summed per document.

Vocabulary: the pieces of a public sentencepiece model, in its order. Its file has no
unigram probabilities, so a piece of rank r scores -log(r + 2) (Zipf's law). Characters
outside the vocabulary count as their UTF-8 bytes, each far below any piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.llm.registry import register

SPACE = "▁"         # starts every pre-token
MAX_STORED = 400_000     # terminal counts kept by a task; beyond that it starts anew
BYTE_PENALTY = 10.0


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> tuple[dict[str, float], float, int]:
    """(piece -> score, score of one fallback byte, longest piece)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    scores = {p: -math.log(r + 2) for r, p in enumerate(normal)}
    return scores, min(scores.values()) - BYTE_PENALTY, max(map(len, normal))


class TrieCounter:
    """Token counts of pre-tokens; ties between segmentations go to fewer tokens."""

    def __init__(self, scores: dict[str, float], byte_score: float, longest: int):
        self.scores, self.byte_score, self.longest = scores, byte_score, longest
        self.stored: dict[str, int] = {}
        self.nodes = 0  # trie nodes computed, for tests

    def add(self, pretokens) -> None:
        """Stores the counts of pre-tokens not yet known."""
        new = sorted(set(pretokens).difference(self.stored))
        scores, longest = self.scores, self.longest
        best, count, last = [0.0], [0], ""
        for word in new:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1:], count[shared + 1:]
            for i in range(shared + 1, len(word) + 1):
                n_bytes = len(word[i - 1].encode("utf-8", "surrogatepass"))
                top, least = best[i - 1] + n_bytes * self.byte_score, count[i - 1] + n_bytes
                for j in range(max(0, i - longest), i):
                    s = scores.get(word[j:i])
                    if s is not None:
                        s += best[j]
                        if s > top or s == top and count[j] + 1 < least:
                            top, least = s, count[j] + 1
                best.append(top)
                count.append(least)
            self.nodes += len(word) - shared
            self.stored[word] = count[-1]
            last = word

    def count(self, texts: list[list[str]]) -> list[int]:
        if len(self.stored) > MAX_STORED:
            self.stored.clear()
        self.add(w for words in texts for w in words)
        get = self.stored.__getitem__
        return [sum(map(get, words)) for words in texts]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", rows: int = 500) -> DataFrame:
    """One row per row of ``docs``: id, ``n_pretokens`` (runs of non-space) and ``n_tokens``.

    Null and empty texts have none. Each task keeps its own trie values and stored counts
    (bounded by MAX_STORED and one batch of ``rows`` texts), so nothing is shuffled.
    ``model_path`` must be readable on every executor.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = TrieCounter(*load_vocabulary(model_path))
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at:at + rows]
                texts = [[SPACE + w for w in t.split()] for t in part["text"]]
                yield pd.DataFrame({"doc_id": part["doc_id"], "n_pretokens": [len(t) for t in texts], "n_tokens": counter.count(texts)})

    got = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = got.schema["doc_id"].dataType.simpleString()
    return got.mapInPandas(run, f"doc_id {kind}, n_pretokens long, n_tokens long")


@register("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
