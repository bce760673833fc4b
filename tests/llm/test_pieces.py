"""Piece encoding and decoding against the library that the model is from."""

from __future__ import annotations

import hashlib
import random
import struct

import duckdb
import public_tokenizers
import pytest
import sentencepiece as spm
from sentencepiece import sentencepiece_model_pb2 as pb

from lakeops.llm import pieces
from lakeops.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [" ", "  ", "a", "b", "the", "é", "é", "ｱ", "ﾊﾟ", "①", "\t", "\n", "😀", "▁", "\xa0", "ﬁ", "½", "​", "\x00", "가", "ก็", "Å", "　", "<s>"]
SCHEMA = "doc_id long, text string, ids string, packed string"


def _texts(rng, n):
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(12))) for _ in range(n)]


def _model(rule: str, prefix: bool = True, extra: bool = False, escape: bool = True, own: list[str] = ()) -> bytes:
    """The public model with another normalisation and symbols of its own; nothing is trained."""
    proto, other = pb.ModelProto(), pb.ModelProto()
    proto.ParseFromString(pieces.read_model(PATH))
    other.ParseFromString(spm.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    proto.normalizer_spec.CopyFrom(other.normalizer_spec)
    spec = proto.normalizer_spec
    spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = prefix, not extra, escape
    for symbol in own:
        proto.pieces.add(piece=symbol, score=0.0, type=pieces.USER_DEFINED)
    return proto.SerializeToString()


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc_cf"])
def test_longest_entries_and_their_sources(rule):
    rng = random.Random(1)
    for prefix in (True, False):
        for extra in (True, False):
            for escape in (True, False):
                model = _model(rule, prefix, extra, escape)
                own, library, normal = pieces.Pieces(model), spm.SentencePieceProcessor(model_proto=model), spm.SentencePieceNormalizer(model_proto=model)
                for text in _texts(rng, 150):
                    got, source = own.normal(text.encode())
                    want, offsets = normal.normalize(text.encode(), with_offsets=True)
                    assert got.encode() == want and (not want or source.tolist() == list(offsets))
                    ids, starts, ends = own.encode([text.encode()])[0]
                    found = library.encode(text.encode(), return_type="offset_mapping")
                    assert ids.tolist() == found["ids"] and list(zip(starts.tolist(), ends.tolist())) == found["offsets"]


def test_symbols_of_the_user_and_broken_bytes():
    model = _model("nmt_nfkc", own=["①①", "zqzq"])
    own, library = pieces.Pieces(model), spm.SentencePieceProcessor(model_proto=model)
    for raw in ["x①① zqzq ①".encode(), b"a\xff\xfe b\xe2\x82", b"\xf0\x9f"]:
        assert own.encode([raw])[0][0].tolist() == library.encode(raw)


def test_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(pieces, "BATCH_BYTES", 64)
    rng = random.Random(2)
    texts = [*_texts(rng, 200), "", None, " ", "long " * 100_000, "x" * 5000, "same", "same"]
    rows = [(k if k % 50 else None, t, "clash", "clash") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = pieces.read_model(PATH)
    library = spm.SentencePieceProcessor(model_file=PATH)
    found = pieces.encoded(df, model, decode=True)
    again = pieces.decoded(found.select("doc_id", "ids", "decoded"), model)
    assert sorted(map(str, again.select("doc_id", "decoded").collect())) == sorted(map(str, found.select("doc_id", "decoded").collect()))
    assert found.columns == ["doc_id", "ids", "starts", "ends", "packed", "decoded"]
    want = sorted((str(d), library.encode(t or "", add_bos=True, add_eos=True)) for d, t, *_ in rows)
    got = found.collect()
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    by_id = {d: (t or "").encode() for d, t, *_ in rows if d is not None}
    for r in got:
        assert r["packed"] == struct.pack(f"<{len(r['ids'])}I", *r["ids"]) and r["decoded"] == library.decode(r["ids"])
        if r["doc_id"] is not None:
            raw = by_id[r["doc_id"]]
            assert b"".join(raw[a:b] for a, b in zip(r["starts"], r["ends"])) == raw
            assert r["starts"] == sorted(r["starts"]) and r["ends"] == sorted(r["ends"])
    none = pieces.encoded(df.limit(0), model)
    assert none.collect() == [] and pieces.decoded(none, model).collect() == []
    kept = pieces.decoded(spark.createDataFrame([(None, "a"), ([], "b")], "ids array<int>, decoded string"), model)
    assert {str(r["ids"]): r["decoded"] for r in kept.collect()} == {"None": None, "[]": ""}


def test_the_query_over_its_whole_table(spark):
    path = "/root/testdata/sf0.01"
    library = spm.SentencePieceProcessor(model_file=PATH)
    want = []
    for doc, text in duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op13_pieces"](spark, path).collect()]
    assert sorted(got) == sorted(want)
