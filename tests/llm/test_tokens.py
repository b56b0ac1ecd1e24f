import random

import pytest
from tokenizers import Tokenizer

from orderstar.llm import tokens
from orderstar.llm.common import tokenizer_path
from orderstar.llm.queries import QUERIES

FILE = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(FILE))


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokenizer_path(FILE))


def odd_texts():
    draw = random.Random(4)
    letters = ["a", "The", " ", "  ", "\n", "\t", "'s", "'", "é", "ß", "1", "23", "<|endoftext|>", "<|", ".", "東",
               "\U0001f600", "́", "​", "　", "\x85", "\xa0", "Ա", "֋", "\U00010940", "İ", "\x1c"]
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)]


def test_ids_and_pretokens_are_the_librarys(library, encoder):
    for text in odd_texts():
        wanted = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text).tolist() == wanted, text
        assert sum(encoder.counts(encoder.pretokens(text))) == len(wanted), text
        assert "".join(encoder.pretokens(text)) == text


def test_long_texts_are_encoded_in_parts(library, encoder, texts, monkeypatch):
    monkeypatch.setattr(tokens, "TEXT_CHARS", 25)
    for text in [*(t for _, t in texts[:60]), *odd_texts()[:1500], " a b  c\n d .e 1f " * 20]:
        parts = list(encoder.segments(text))
        assert "".join(parts) == text
        wanted = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text).tolist() == wanted, text
        assert sum(sum(encoder.counts(encoder.pretokens(p))) for p in parts) == len(wanted)


@pytest.mark.parametrize("text", ["a" * 100_000, " " * 100_000, "1" * 50_000, "\n" * 60_000 + "x", "." * 50_000])
def test_long_runs(library, encoder, text):
    wanted = library.encode(text, add_special_tokens=False).ids
    assert encoder.ids(text).tolist() == wanted
    assert sum(encoder.counts(encoder.pretokens(text))) == len(wanted)


def test_other_tokenizer_files_are_used_as_they_are(make):
    path = tokenizer_path("word_bpe_49k.json")
    rows = make((1, "Hello World, hello!"), (2, None))
    library = Tokenizer.from_file(path)
    wanted = len(library.encode("Hello World, hello!", add_special_tokens=False).ids)
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(rows, path).collect()} == {1: wanted, 2: 0}


@pytest.mark.parametrize("pretokens", [400_000, 50])
def test_query_equals_the_library(spark, sf_dir, texts, library, monkeypatch, pretokens):
    """The second size closes a block after nearly every document."""
    monkeypatch.setattr(tokens, "BLOCK_PRETOKENS", pretokens)
    monkeypatch.setattr(tokens, "RUN", 7 if pretokens == 50 else 5_000)
    wanted = set()
    for key, text in texts:
        n = len(library.encode(text, add_special_tokens=False).ids)
        wanted.add((key, len(text.encode()), n, n > 1024))
    assert {tuple(r) for r in QUERIES["op5_token_counts"](spark, sf_dir).collect()} == wanted


def test_odd_rows(odd, odd_rows, empty, library):
    found = tokens.count_tokens(odd, tokenizer_path(FILE)).collect()
    wanted = [(k, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in odd_rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    assert tokens.count_tokens(empty, tokenizer_path(FILE)).count() == 0
