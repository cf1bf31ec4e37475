from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from airstrata.llm import bpe, packing
from airstrata.llm.queries import op4_bpe_codec

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n\n", "don't THE'S  <|endoftext|>abc<|startoftext|> <|endoftext|>", "ΑΣ ΣΑΣ é é",
    "x" * 3000, "!!!!......... 12345 " + "=-" * 200, "a\x1cb \x1f", "İstanbul ǅ ﬁ", "日本語テキスト 🎉🎉",
    "　wide spaces\x85here", "a  b   c \n d\t\te ", "ᲉꟋ new letters",
]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)


def same(libraries, text):
    words, byte_level = libraries
    expected = words.encode(text, add_special_tokens=False).ids
    own = bpe.load_word_bpe(WORDS)
    ids = own.encode(text)
    assert ids.tolist() == expected
    assert own.decode(ids).decode() == words.decode(expected, skip_special_tokens=False)
    packed = packing.load_byte_bpe(BYTES).encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == byte_level.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(libraries, text):
    same(libraries, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_any_text(libraries, text):
    same(libraries, text)


@settings(max_examples=200, deadline=None)
@given(st.text("abeinorst' .<|>d", max_size=80))
def test_dense_merges(libraries, text):
    same(libraries, text)


def test_every_character_is_split_as_the_library_splits_it(libraries):
    for point in [*range(1, 0x3000), *range(0xA000, 0xD800), *range(0xE000, 0x10FFF, 3)]:
        same(libraries, f"a{chr(point)}b {chr(point)}")


def test_query_matches_the_library_on_all_documents(spark, libraries):
    small = "/root/testdata/sf0.001"
    library = libraries[0]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op4_bpe_codec(spark, small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_rows_of_any_shape(spark):
    rows = [(1, None), (None, "a b"), (1, None), (2, ""), (3, "long " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "'x' as ids")
    found = sorted(bpe.encode_documents(docs, WORDS).collect(), key=lambda r: (len(r.ids), str(r.doc_id)))
    assert [(r.doc_id, len(r.ids), len(r.decoded) > 0) for r in found] == [
        (1, 0, False), (1, 0, False), (2, 0, False), (None, 2, True), (3, 50_000, True)
    ]
    assert bpe.encode_documents(docs.limit(0), WORDS).collect() == []
