"""SentencePiece encoding and decoding against the library."""

import hashlib
import itertools
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2, sentencepiece_pb2

from tidewater.llm import piece_codec as P

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = list("abc ▁ \n\t\0éß漢😀<s>0x0A") + ["  ", "   ", "<0x0A>", "</s>", "the ", "ing"]


def odd_texts():
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 90))) for _ in range(600)]
    return texts + ["", " ", "   ", "▁", "\n", "the" * 3000, " " * 5001, "é" * 4000, "﻿ x", "x y"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_and_spans_equal_the_library(library, small_docs):
    coder = P.PieceEncoder(MODEL)
    texts = odd_texts() + [r.text for r in small_docs.select("text").collect() if r.text]
    for text, ids, proto in zip(texts, library.encode(texts), library.encode(texts, out_type="serialized_proto")):
        got, starts, ends = coder.encode(text)
        assert got.tolist() == ids, text[:80]
        pieces = sentencepiece_pb2.SentencePieceText.FromString(proto).pieces
        assert starts.tolist() == [p.begin for p in pieces] and ends.tolist() == [p.end for p in pieces]
        data = text.encode()
        assert b"".join(data[a:b] for a, b in zip(starts, ends)) == data
        assert coder.decode(got.tolist()) == library.decode(ids)


def test_short_and_long_merges_agree():
    coder = P.PieceEncoder(MODEL)
    for text in odd_texts():
        assert coder._merge_short(text[:200]) == coder._merge_long(text[:200])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_compiled_map_equals_the_library(rule):
    rng = random.Random(4)
    some = list("abc ▁ \n\téßＡ①ﬀ漢😀ｶﾞ각가́ 　﻿​") + ["  ", "   ", "é"]
    for dummy, escape, squeeze in itertools.product((False, True), repeat=3):
        own = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, escape_whitespaces=escape,
                                                    remove_extra_whitespaces=squeeze)
        normal = P.Normalizer(sentencepiece_model_pb2.ModelProto.FromString(own.serialized_model_proto()).normalizer_spec)
        for _ in range(150):
            text = "".join(rng.choice(some) for _ in range(rng.randint(0, 12)))
            want, offsets = own.normalize(text, with_offsets=True)
            data, source = normal(text)
            assert data.decode() == want
            places = [0, *itertools.accumulate(len(c.encode()) for c in want)]
            assert [len(text.encode()[:source[p]].decode("utf-8", "ignore")) for p in places] == list(offsets), (text, want)


def test_model_without_byte_fallback(tmp_path):
    model = sentencepiece_model_pb2.ModelProto.FromString(open(MODEL, "rb").read())
    model.trainer_spec.byte_fallback = False
    for p in model.pieces:
        if p.type == p.BYTE:
            p.type = p.CONTROL
    path = tmp_path / "plain.model"
    path.write_bytes(model.SerializeToString())
    own, coder = sentencepiece.SentencePieceProcessor(model_file=str(path)), P.PieceEncoder(str(path))
    for text in odd_texts():
        proto = sentencepiece_pb2.SentencePieceText.FromString(own.encode(text, out_type="serialized_proto"))
        ids, starts, ends = coder.encode(text)
        assert (ids.tolist(), starts.tolist(), ends.tolist()) == (own.encode(text), [p.begin for p in proto.pieces], [p.end for p in proto.pieces])


def test_remembered_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(P, "MAX_PARTS", 50)
    coder, plain = P.PieceEncoder(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in odd_texts():
        assert coder.encode(text)[0].tolist() == plain.encode(text)
    coder = P.PieceEncoder(MODEL)
    coder.encode("x" * 100_000)
    assert not any(len(p) > P.MAX_PART_LENGTH for p in coder.learned)


def test_encode_decode_tables(odd_docs, odd_rows, library):
    got = P.decode_ids(P.encode_documents(odd_docs, MODEL), MODEL).collect()
    want = sorted((str(r[0]), library.encode(r[1] or ""), library.decode(library.encode(r[1] or ""))) for r in odd_rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == want
    digests = P.digest_documents(odd_docs, MODEL).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == \
        sorted((k, len(i), sha(",".join(map(str, i))), sha(d)) for k, i, d in want)
    encoded = P.encode_documents(odd_docs, MODEL).where(F.col("doc_id") == 10).first()
    text = next(r[1] for r in odd_rows if r[0] == 10).encode()
    assert b"".join(text[a:b] for a, b in zip(encoded.starts, encoded.ends)) == text


def test_query_and_empty_table(spark, no_docs, library):
    assert P.encode_documents(no_docs, MODEL).count() == 0 and P.digest_documents(no_docs, MODEL).count() == 0
    from tidewater.llm.registry import QUERIES
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_piece_codec"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
