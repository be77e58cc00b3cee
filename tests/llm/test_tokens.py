import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tableworks.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts(library):
    texts = [
        "", " ", "  \n\n x", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "hello world's they'll I'M", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>",
        "<|endof<|endoftext|>text|>", "\x1c\x1d\x1e\x1f\x85\xa0  x", "日本語のテキスト", "́é \U0001f600‍\U0001f469",
        "½²Ⅷ 123٣", "tab\tnew\r\n", "﻿bom", "x" * 5000, "ab" * 3000, "\x00\x01", "_ __ ___", "!" * 777,
    ]
    assert tokens.merges(PATH).counts(texts) == lengths(library, texts)


def test_random_texts(library):
    r = random.Random(3)
    pools = ["abcdefgh ", " \n\t\r\x0b\x0c\x1c\x85\xa0 ", "éüßñÀ'sdlm ", "0123456789½²٣ ", "#$%&!.,-_ ", "日本語한국어 "]
    texts = ["".join(r.choice(r.choice(pools)) for _ in range(r.randint(0, 300))) for _ in range(600)]
    texts += ["".join(chr(r.choice([r.randrange(0x20, 0x3000), r.randrange(0x10000, 0x10FFFF)])) for _ in range(50)) for _ in range(200)]
    assert tokens.merges(PATH).counts(texts) == lengths(library, texts)


def test_documents(spark, library):
    rows = [(1, "some text here", "x"), (2, None, "y"), (None, "", "z"), (1, "some text here", "x"), (3, "word " * 20000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, tokens.token_counts(df, PATH).collect()), key=str)
    want = [(k, len((t or "").encode()), lengths(library, [t or ""])[0]) for k, t, _ in rows]
    assert got == sorted(want, key=str)
    assert tokens.token_counts(df.limit(0), PATH).collect() == []


def test_table_of_known_tokens_is_bounded(monkeypatch):
    table = tokens.Merges(PATH)
    monkeypatch.setattr(tokens, "KNOWN_MAX", 3)
    for _ in range(3):
        assert table.counts(["a b c d e f g"]) == [7]
    assert len(table.known) <= 7
