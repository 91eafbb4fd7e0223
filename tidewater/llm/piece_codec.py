"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised by the longest prefix that the model's compiled character map holds at
each place (a double-array trie beside a pool of replacements); every byte of the result
remembers the byte of the text it comes from, so each piece projects to a span of original
bytes. The normalised text then falls apart at places no piece of the vocabulary spans (before
a run of the space mark, around a line break); merges on either side don't meet, so each
distinct part is merged once and remembered, and a text is the concatenation of its parts.
A part falls apart further where no piece of the vocabulary has its two characters side by side.
Unknown characters fall back to their bytes where the model says so.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import table
from tidewater.llm.registry import register

SPACE = "▁"            # stands for a space in pieces
MAX_PARTS = 1_000_000  # parts whose pieces a worker keeps (some 250 MB); beyond that it starts anew
MAX_PART_LENGTH = 64   # longer parts are not kept
SHORT_PART = 40        # up to here the best pair is found by a scan, beyond by a heap


class CharMap:
    """The compiled character map: a little-endian length, that many bytes of double-array units,
    then the replacements, each closed by a zero byte. An empty map changes nothing."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.pool = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes taken, replacement) of the longest entry that starts at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for k in range(at, len(data)):
            byte = data[k]
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:  # the label, with the leaf bit clear
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = k + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.pool[found[1]:self.pool.index(b"\0", found[1])]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Normalizer:
    """Text to the bytes that are segmented, with the source offset of each byte and of the end."""

    def __init__(self, spec):
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def _prefixes(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(start, end, replacement) of every step over ``data``."""
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit is None:
                lead = data[at]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = n, data[at:at + n]
            yield at, at + hit[0], hit[1]
            at += hit[0]

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode("utf-8", "replace")
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            return self._escaped(data)
        mark = SPACE.encode() if self.escape else b" "
        steps, begin, end = list(self._prefixes(data)), 0, len(data)
        if self.squeeze:
            first = 0
            while first < len(steps) and steps[first][2] == b" ":
                first += 1
            steps = steps[first:]
            if not steps:
                return b"", np.zeros(1, np.int64)
            begin = steps[0][0]
        out, source, after_space = bytearray(), [], self.squeeze
        if self.dummy:
            out += mark
            source += [begin] * len(mark)
        for start, stop, piece in steps:
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                for byte in piece:
                    one = mark if byte == 0x20 else bytes([byte])
                    out += one
                    source += [start] * len(one)
                after_space = self.squeeze and piece.endswith(b" ")
            end = stop
        if self.squeeze:
            while out.endswith(mark) and len(out):
                end = source[-1]
                del out[-len(mark):], source[-len(mark):]
        return bytes(out), np.array([*source, end], np.int64)

    def _escaped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The same for an empty map: each step is one character, only spaces change. (Bytes inside a
        character have their own offsets here; no piece starts or ends there.)"""
        mark = SPACE.encode() if self.escape else b" "
        lead = len(mark) if self.dummy else 0
        raw = np.frombuffer(data, np.uint8)
        kind = np.int32 if len(data) < 1 << 30 else np.int64
        widths = np.ones(len(raw) + 1, np.uint8)
        widths[0] += lead
        widths[:-1][raw == 0x20] += len(mark) - 1
        return mark * bool(lead) + data.replace(b" ", mark), np.repeat(np.arange(len(raw) + 1, dtype=kind), widths)


class Learned(dict):
    """part -> (id, normalised bytes it takes) of its pieces, as pairs of 32-bit numbers; a part is
    merged when it is first asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, part: str) -> bytes:
        got = self.learn(part)
        if len(part) <= MAX_PART_LENGTH:
            self[part] = got
        return got


class PieceEncoder:
    """Ids and spans by the model file at ``path``. Merging takes the best-scored adjacent pair
    that is a piece, the leftmost of equals, until none is left."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.processor.serialized_model_proto())
        kind = model.SentencePiece
        if model.trainer_spec.model_type != model.trainer_spec.BPE:
            raise ValueError("not a BPE model")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.normalize = Normalizer(model.normalizer_spec)
        self.pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        # Order of merging: equal scores share a rank, the best score has rank 0.
        order = {score: k for k, score in enumerate(sorted({p.score for p in model.pieces if p.type == kind.NORMAL}, reverse=True))}
        self.rank = {p.piece: order[p.score] for p in model.pieces if p.type == kind.NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        self.bytes = None
        if model.trainer_spec.byte_fallback:
            self.bytes = [self.processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        inner = [p for p in self.pieces if len(p) > 1]
        # Parts are cut where no piece reaches across; a vocabulary that does is taken whole.
        self.neighbours = {p[k - 1:k + 1] for p in inner for k in range(1, len(p))}
        self.whole = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in inner)
        self.by_line = not any("\n" in p for p in inner)
        line = "\n" if self.by_line else ""
        self.find_parts = re.compile(f"{line and line + '|'}{SPACE}*[^{SPACE}{line}]+|{SPACE}+").findall
        self.learned = Learned(self.learn)
        self.decimal = [str(k) for k in range(len(model.pieces))]

    def parts(self, text: str) -> list[str]:
        """The parts of a normalised text. Without runs of the space mark two replacements and a split
        do what the pattern does (empty parts come along)."""
        if self.whole:
            return [text]
        if "\0" in text or SPACE + SPACE in text:
            return self.find_parts(text)
        text = text.replace(SPACE, "\0" + SPACE)
        return (text.replace("\n", "\0\n\0") if self.by_line else text).split("\0")

    def merge(self, part: str) -> list[str]:
        """The pieces of one part, unknown characters among them."""
        return self._merge_short(part) if len(part) <= SHORT_PART else self._merge_long(part)

    def _merge_short(self, part: str) -> list[str]:
        rank, none = self.rank.get, len(self.rank)
        symbols = list(part)
        ranks = [rank(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            symbols[k:k + 2] = [joined] = [symbols[k] + symbols[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank(symbols[k - 1] + joined, none)
            if k < len(ranks):
                ranks[k] = rank(joined + symbols[k + 1], none)
        return symbols

    def _merge_long(self, part: str) -> list[str]:
        """The same with a heap of pairs: no scan of all pairs after a merge."""
        rank = self.rank
        symbols: list[str] = list(part)
        right, left = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        agenda = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(symbols):
                joined = symbols[a] + symbols[b]
                if joined in rank:
                    heapq.heappush(agenda, (rank[joined], a, b, joined))

        for k in range(len(symbols) - 1):
            offer(k, k + 1)
        while agenda:
            _, a, b, joined = heapq.heappop(agenda)
            if not symbols[a] or not symbols[b] or symbols[a] + symbols[b] != joined or right[a] != b:
                continue
            symbols[a], symbols[b] = joined, ""
            right[a] = right[b]
            if right[a] < len(symbols):
                left[right[a]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [s for s in symbols if s]

    def learn(self, part: str) -> bytes:
        near = self.neighbours  # characters that no piece has side by side fall apart
        cuts = [0, *(k for k in range(1, len(part)) if part[k - 1:k + 1] not in near), len(part)]
        if len(cuts) > 2:
            return b"".join(map(self.learned.__getitem__, map(part.__getitem__, map(slice, cuts, cuts[1:]))))
        pairs = []
        for piece in self.merge(part):
            hit = self.pieces.get(piece)
            raw = piece.encode()
            if hit is not None:
                pairs += (hit, len(raw))
            elif self.bytes is not None:  # the last byte stands for the character, the others for nothing
                for b in raw[:-1]:
                    pairs += (self.bytes[b], 0)
                pairs += (self.bytes[raw[-1]], len(raw))
            else:
                pairs += (self.unknown, len(raw))
        return struct.pack(f"<{len(pairs)}i", *pairs)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first byte, end byte): spans are byte offsets into the UTF-8 text."""
        if len(self.learned) > MAX_PARTS:
            self.learned.clear()
        data, source = self.normalize(text)
        pairs = np.frombuffer(b"".join(map(self.learned.__getitem__, self.parts(data.decode()))), "<i4").reshape(-1, 2)
        ids, places = pairs[:, 0], np.zeros(len(pairs) + 1, np.int64)
        np.cumsum(pairs[:, 1], out=places[1:])
        starts, ends = places[:-1], places[1:]
        if self.bytes is None and len(ids):  # neighbouring unknown characters are one unknown piece
            more = np.concatenate([[False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)])
            ends = ends[np.concatenate([~more[1:], [True]])]
            ids, starts = ids[~more], starts[~more]
        return ids, source[starts], source[ends]

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """One per Python worker, so that its later tasks know the parts of the earlier ones."""
    return PieceEncoder(path)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", rows: int = 200) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``ids``, ``starts``, ``ends`` (arrays of equal length).

    ``starts``/``ends`` are the byte spans of the pieces in the UTF-8 text: spans follow each other
    and cover it (but for what the normaliser removes); the mark put before the text and all but
    the last byte of an unknown character have empty spans. Null and empty texts have no pieces;
    repeated rows stay; an empty table gives an empty result. Texts are encoded whole, whatever
    their length; a task holds ``rows`` texts and at most MAX_PARTS remembered parts.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = piece_encoder(model_path)
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at:at + rows]
                got = [coder.encode(t) for t in part["text"]]
                out = pd.DataFrame({"doc_id": part["doc_id"].to_numpy()})
                for k, name in enumerate(("ids", "starts", "ends")):
                    out[name] = pd.Series([g[k] for g in got], dtype="object")
                yield out

    got = _texts(docs, id_col, text_col)
    schema = T.StructType([got.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))])
    return got.mapInPandas(run, schema)


def decode_ids(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` plus ``decoded``: the text the model makes of each row's ids (null ids: null)."""
    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        coder = piece_encoder(model_path)
        return ids.map(lambda x: None if x is None else coder.decode([int(i) for i in x]))
    return encoded.withColumn("decoded", decoded(F.col(ids_col)))


def digest_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``encode_documents`` and ``decode_ids`` give, as digests made where the text is encoded:
    ``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas), ``decoded_sha256`` (UTF-8)
    and ``spans_crc32`` (starts, then ends, as little-endian unsigned 64-bit numbers)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = piece_encoder(model_path)
        decimal = coder.decimal.__getitem__
        for batch in batches:
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "spans_crc32": []}
            for text in batch["text"]:
                ids, starts, ends = coder.encode(text)
                ids = ids.tolist()
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
                out["spans_crc32"].append(zlib.crc32(ends.astype("<u8"), zlib.crc32(starts.astype("<u8"))))
            yield pd.DataFrame({"doc_id": batch["doc_id"], **out})

    got = _texts(docs, id_col, text_col)
    kind = got.schema["doc_id"].dataType.simpleString()
    return got.mapInPandas(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")


@register("op13_piece_codec")
def op13_piece_codec(spark, sf_dir):
    import public_tokenizers
    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
