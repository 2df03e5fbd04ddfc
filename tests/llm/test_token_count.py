import random

import pytest

from roadlens.llm import token_count
from roadlens.llm.queries import vocabulary_path
from tests.llm.conftest import ODD_ROWS


@pytest.fixture(scope="module")
def vocabulary():
    with open(vocabulary_path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(vocabulary)


def long_texts():
    rng = random.Random(11)
    bits = ["word", "Éa", "don't", "é", "̈", "<|endoftext|>", "你好", "12", "!!", " ", "  ", "\n", " ",
            "\x1c", "\x0b", "supercalifragilistic"]
    return ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(n)) for n in (5, 90, 400, 900, 2000)]


@pytest.mark.parametrize("chunk,overlap", [(16_384, 512), (200, 40), (64, 8)])
def test_counts_equal_the_library(make_docs, vocabulary, library, chunk, overlap):
    texts = long_texts() + ["y" * 3000 + " tail", "a b " * 500 + "z" * 900]
    rows = ODD_ROWS + [(100 + i, t) for i, t in enumerate(texts)] * 2
    found = token_count.token_counts(make_docs(rows, extra="n_tokens text_key"), vocabulary, 100, chunk, overlap).collect()
    expected = []
    for i, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((i, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_chunks_cover_the_text():
    for n in (0, 1, 9, 10, 11, 25, 100):
        text = "".join(chr(97 + i % 26) for i in range(n))
        pieces = token_count.cut(text, 10, 3)
        assert all(text[at:at + len(p)] == p for at, p in pieces)
        assert pieces[-1][0] + len(pieces[-1][1]) == n
        assert all(b[0] - a[0] == 7 for a, b in zip(pieces, pieces[1:]))


def test_empty_table_and_unfit_tokenizer(make_docs, vocabulary):
    assert token_count.token_counts(make_docs(ODD_ROWS).limit(0), vocabulary).count() == 0
    with open(vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        token_count.load(file.read())
