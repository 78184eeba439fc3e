import json

import pytest

from linkmill.llm import tokens
from linkmill.llm.tokens import count_tokens, op8_token_counts

TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello world's  best\n\n text 123 ...",
    "a<|endoftext|>b <|endoftext|>",
    "日本語のテキスト и русский текст, ßöäü éèê ñ",
    "é ՘ՠ 🙂👩‍👩‍👧 ﻿​ x　y",
    "x" * 3000,
    " " * 3000 + "y",
    "word " * 500_000,
    "tab\tand\r\nlines\n\n\n   end   ",
    "Hello world's  best\n\n text 123 ...",
]


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def path():
    return tokens.default_tokenizer()


def test_counts_equal_the_library(spark, path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    lib = library(path)
    for row in count_tokens(docs).collect():
        text = TEXTS[row.doc_id] or ""
        n = len(lib.encode(text, add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (n, len(text.encode()), n > 512), text[:40]


def test_whole_table_equals_the_library(spark, sf, path):
    lib = library(path)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op8_token_counts(spark, sf).collect()
    assert len(rows) == len(texts)
    assert all(r.n_tokens == len(lib.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in rows)


def test_settled_code_points_split_as_in_the_library(path):
    import regex

    lib, mine = library(path).pre_tokenizer, regex.compile(tokens.SPLIT)
    ranges = regex.findall(r"(.)-(.)|(.)", tokens.SETTLED, flags=regex.S)
    points = [c for a, b, c1 in ranges for c in (range(ord(a), ord(b) + 1) if a else [ord(c1)])]
    for start in range(0, len(points), 500):
        text = "".join(f"a{chr(p)}1{chr(p)}!{chr(p)} " for p in points[start : start + 500])
        assert [text[a:b] for _, (a, b) in lib.pre_tokenize_str(text)] == mine.findall(text)


def test_proof_and_other_vocabularies(spark, path):
    with open(path) as file:
        spec = file.read()
    whole = tokens.whole_tokens(spec)
    lib = library(path)
    assert len(whole) > 40_000 and all(len(lib.encode(w, add_special_tokens=False).ids) == 1 for w in whole[::97])
    changed = json.loads(spec)
    changed["model"]["merges"] = changed["model"]["merges"][::-1]
    assert tokens.whole_tokens(json.dumps(changed)) is None
    import public_tokenizers
    import sentencepiece

    docs = spark.createDataFrame([("A b, naïve text",)], "text string")
    word = public_tokenizers.path("word_bpe_49k.json")
    assert count_tokens(docs, path=word).collect()[0].n_tokens == len(library(word).encode("A b, naïve text", add_special_tokens=False).ids)
    piece = public_tokenizers.path("piece_bpe_32k.model")
    want = len(sentencepiece.SentencePieceProcessor(model_file=piece).encode("A b, naïve text"))
    assert count_tokens(docs, path=piece).collect()[0].n_tokens == want


def test_slabs_do_not_change_counts(path, monkeypatch):
    monkeypatch.setattr(tokens, "SLAB", 7)
    with open(path) as file:
        spec = file.read()
    count, lib = tokens.counter(spec, tokens.whole_tokens(spec)), library(path)
    for text in [t for t in TEXTS if t is not None and len(t) < 5000]:
        assert count(text) == len(lib.encode(text, add_special_tokens=False).ids)


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([("a b", 7, 1)], "text string, n_tokens long, k int")
    assert count_tokens(docs).collect()[0].asDict() == {"text": "a b", "k": 1, "n_bytes": 3, "n_tokens": 2, "over_limit": False}
    assert count_tokens(docs.limit(0)).count() == 0
