import random

import pytest

from roadlens.llm import sentence_piece
from roadlens.llm.queries import vocabulary_path
from tests.llm.conftest import ODD_ROWS


@pytest.fixture(scope="module")
def model():
    with open(vocabulary_path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def texts():
    rng = random.Random(5)
    bits = [" ", "  ", "   ", "a", "e", "th", "é", "你", "好", "\n", "\t", "▁", "<s>", "😀", "1", "22", "!!", "..", "ing",
            "\x00", "ß", "の", "'", "\r\n", "    ", "́", "The", "tion", "hello"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return out + [c * n for c in " a=\n▁你" for n in (1, 2, 3, 7, 16, 33, 100)]


def test_bpe_ids_and_decoding_equal_the_library(model):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    encoder = sentence_piece.Encoder(sentence_piece.load(model))
    found = encoder.encode(texts())
    assert [x.tolist() for x in found] == library.encode(texts())
    for text, ids in zip(texts(), found):
        assert encoder.decode(ids.tolist()) == library.decode(ids.tolist()) == text.replace("▁", " ")


def test_long_words_without_spaces(model):
    import time

    import sentencepiece
    rng = random.Random(9)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    encoder = sentence_piece.Encoder(sentence_piece.load(model))
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    kana, latin = [chr(c) for c in range(0x3041, 0x30FF)], [chr(c) for c in range(97, 123)]
    mixed = ["".join(rng.choice(pool) for _ in range(n)) for n in (31, 32, 33, 200, 3000)
             for pool in (han, kana, latin, han[:50] + kana + latin, han + ["ab", "ing", "你好", "😀", "\x00", "é", "́"])]
    assert [x.tolist() for x in encoder.encode(mixed)] == library.encode(mixed)
    text = "".join(rng.choice(han[:2000]) for _ in range(100_000))
    start = time.perf_counter()
    ids = encoder.encode([text])[0]
    assert time.perf_counter() - start < 2
    assert ids.tolist() == library.encode(text) and encoder.decode(ids.tolist()) == text


def test_unigram_paths_score_as_high_as_the_library(model):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    for piece in proto.pieces:  # tame, so that sums stay exact
        piece.score = max(piece.score, -40_000.0) / 1024
    serial = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=serial)
    encoder = sentence_piece.Encoder(sentence_piece.load(serial))
    score = [p.score for p in proto.pieces]
    for text in texts()[:300]:
        ours, theirs = encoder.encode([text])[0].tolist(), library.encode(text)
        assert ours == theirs or sum(score[i] for i in ours) == pytest.approx(sum(score[i] for i in theirs), rel=1e-6)


def test_documents(make_docs, model):
    docs = make_docs(ODD_ROWS, extra="token_ids2 __other")
    found = sentence_piece.encode_column(docs, model, ["doc_id", "lang"])
    assert found.columns == ["doc_id", "lang", "token_ids", "n_tokens", "round_trip"]
    rows = found.collect()
    assert len(rows) == len(ODD_ROWS) and all(r.round_trip and len(r.token_ids) == r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert sentence_piece.encode_column(docs.limit(0), model, ["doc_id"]).count() == 0


def test_forgetting_words_changes_nothing(model, monkeypatch):
    encoder = sentence_piece.Encoder(sentence_piece.load(model))
    first = [x.tolist() for x in encoder.encode(["one two three", "two four"])]
    monkeypatch.setattr(sentence_piece, "KEPT_WORDS", 1)
    assert [x.tolist() for x in encoder.encode(["one two three", "two four"])] == first
