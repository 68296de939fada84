"""SentencePiece encoding, decoding and spans against the library."""

import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece

from shelfmend.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = list("abcdeftho ,.\n\t 0123  ▁éÀßﬁ①Ａ　 ½ｶﾞ가각一丁😀́​\u0000\xa0¨ǅ")


def message(number, body):
    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    return varint(number << 3 | 2) + varint(len(body)) + body


def models():
    """The model as it is, and with the character maps that the library brings along."""
    with open(PATH, "rb") as file:
        plain = file.read()
    yield "plain", plain
    for rule in ("nmt_nfkc", "nfkc_cf"):
        proto = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
        spec = dict(pieces.fields(dict(pieces.fields(proto))[3]))
        for fewer in (0, 1):
            yield f"{rule}-{fewer}", plain + message(3, message(2, spec[2]) + bytes([4 << 3, fewer]))


@pytest.mark.parametrize("data", [pytest.param(d, id=n) for n, d in models()])
def test_ids_spans_and_text_are_the_librarys(data):
    rng = random.Random(5)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.PieceModel(data)
    samples = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    for text in [*samples, "", "   ", " a", "a  ", "▁", "▁▁a", "▁\xa0", "x" * 3000, "\n" * 500]:
        ids, begins, ends = own.encode(text.encode())
        expected = library.encode_as_proto(text)
        assert ids == [p.id for p in expected.pieces]
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == [(p.begin, p.end) for p in expected.pieces]
        assert own.decode(ids).decode() == library.decode(ids)


def test_any_ids_decode_as_in_the_library():
    rng = random.Random(6)
    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.model(PATH)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(32000), 259 + rng.randrange(30)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids).decode() == library.decode(ids)


def test_other_models_are_refused():
    with open(PATH, "rb") as file:
        data = file.read()
    with pytest.raises(ValueError):
        pieces.PieceModel(data + message(2, bytes([3 << 3, 1])))  # a unigram model


def test_rows(documents):
    long = "Lagerplatz ünïcode 仓库 12 " * 20_000
    rows = [(1, "Hello  world\n", "x"), (None, "a", "x"), (3, None, "x"), (4, "", "x"), (5, "same", "x"), (5, "same", "x"), (6, long, None)]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = pieces.encode_documents(documents(*rows))
    assert found.columns == ["doc_id", "ids", "begins", "ends", "decoded"]
    got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded).decode()) for r in found.collect()), key=repr)
    assert got == sorted(((d, library.encode(t or ""), t or "") for d, t, _ in rows), key=repr)
    for r in found.collect():
        text = dict((d, t) for d, t, _ in rows)[r.doc_id]
        assert b"".join((text or "").encode()[a:b] for a, b in zip(r.begins, r.ends, strict=True)) == (text or "").encode()
    assert pieces.encode_documents(documents(*rows).filter("doc_id = 99")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = {r.doc_id: r for r in queries.QUERIES["op12_pieces"](spark, folder).collect()}
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{folder}/documents.parquet'").fetchall()
    assert len(rows) == len(found)
    for doc_id, text in rows:
        ids, r = library.encode(text), found[doc_id]
        assert (r.n_tokens, r.covered_bytes) == (len(ids), len(text.encode()))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
