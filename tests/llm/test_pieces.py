import sentencepiece
import numpy as np
from sentencepiece import sentencepiece_model_pb2

from landledger.llm import pieces
from landledger.llm.queries import PIECES, file_bytes

TEXTS = [
    "", " ", "  two  spaces ", "\n", "a\tb\r\nc", "<s> </s> <unk> <0x41>", "x" * 5000, "naïve café – “quoted”", "日本語のテキスト", "😀 é\u0000 ▁ a▁b",
    "word " * 20_000, "The quick brown fox; 12,345.67!", "ÀÉÎ" * 50,
]


def unigram_model():
    """A small unigram model written by hand, with byte fallback."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type = pieces.UNIGRAM
    proto.trainer_spec.byte_fallback = True
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = True
    for text, kind in (("<unk>", pieces.UNKNOWN), ("<s>", pieces.CONTROL), ("</s>", pieces.CONTROL)):
        proto.pieces.add(piece=text, score=0.0, type=kind)
    for byte in range(256):
        proto.pieces.add(piece=f"<0x{byte:02X}>", score=0.0, type=pieces.BYTE)
    for rank, text in enumerate(["▁", "▁the", "▁cat", "s", "at", "c", "t", "a", "h", "e", "th", "▁s", "▁sat", "o", "n", "on"]):
        proto.pieces.add(piece=text, score=-1.0 - rank / 3, type=pieces.NORMAL)
    return proto.SerializeToString()


def agree(serialized, texts):
    original = sentencepiece.SentencePieceProcessor(model_proto=serialized)
    tokenizer, _ = pieces.backends(serialized, 2)
    ids = pieces.encode(texts, tokenizer)
    assert ids == [original.encode(t) for t in texts]
    assert pieces.decode(ids, tokenizer) == [original.decode(i) for i in ids]


def test_parity_bpe():
    agree(file_bytes(PIECES), TEXTS)


def test_parity_unigram():
    agree(unigram_model(), ["", "the cats sat on the cat", "  the", "théâtre ☃", "that"])


def test_parity_documents(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    agree(file_bytes(PIECES), [t or "" for t in texts])


def test_round_trip(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "same", "x"), (None, "same", "x"), (77, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.round_trip(docs, file_bytes(PIECES), check_every=2, group=4).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    original = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i, text in enumerate(TEXTS):
        assert np.frombuffer(by_id[i].ids, "<i4").tolist() == original.encode(text)
        assert by_id[i].round_trip == (by_id[i].decoded == text)
    assert by_id[77].n_tokens == 0 and by_id[77].decoded == ""
    assert any(r.checked for r in got) and not all(r.checked for r in got)
    assert pieces.round_trip(docs.limit(0), file_bytes(PIECES)).count() == 0


def test_every_text_is_compared(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(120)], "doc_id long, text string").coalesce(1)
    assert all(r.checked and not r.differed for r in pieces.round_trip(docs, file_bytes(PIECES)).collect())
    plain = pieces.encode
    monkeypatch.setattr(pieces, "encode", lambda texts, tokenizer: [ids + [5] * text.endswith("77") for text, ids in zip(texts, plain(texts, tokenizer))])
    original = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for check_every in (1, 2):
        got = pieces.round_trip(docs, file_bytes(PIECES), check_every=check_every, group=78).collect()
        for r in got:
            if r.checked:
                assert np.frombuffer(r.ids, "<i4").tolist() == original.encode(f"text number {r.doc_id}")
                assert r.differed == (r.doc_id == 77) and r.round_trip


def test_bytes_of_the_marker_are_no_space():
    proto = pieces.parse(unigram_model())
    kept = [p for p in proto.pieces if p.piece != "▁"]
    del proto.pieces[:]
    proto.pieces.extend(kept)
    tokenizer, original = pieces.backends(proto.SerializeToString(), 1)
    spelt = [original.piece_to_id(f"<0x{byte:02X}>") for byte in "▁".encode()]
    assert pieces.decode([[original.piece_to_id("a"), *spelt]], tokenizer) == ["a▁"]
