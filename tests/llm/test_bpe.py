import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newslens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return bpe.Coder(bpe.Vocabulary.load(PATH)), Tokenizer.from_file(PATH)


def ids_of(coder, texts):
    flat, counts = coder.encode(texts)
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if texts else []


ODD = [
    "", " ", "\n\t", "a" * 5000, "ab" * 3000, "I'll don't WE'VE 's", "12345 ½ ²", "ΣΑΣ Σ σας", "İstanbul ẞ ß", "é é ﬁ",
    "x<|endoftext|>y <|startoftext|>", "<|ENDOFTEXT|>", "日本語 🤖🤖🏽", "a\x1cb\x1f c", "x y　z᠎w", "!!??...", "\x00\x01﻿",
]


def test_odd_texts_equal_the_library(both):
    coder, library = both
    for text, ids in zip(ODD, ids_of(coder, ODD), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:40]
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), st.sampled_from("aabbccthe 's\n")), max_size=60), max_size=5))
def test_random_texts_equal_the_library(both, texts):
    coder, library = both
    assert ids_of(coder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_full_cache_changes_nothing(both, monkeypatch):
    coder, _ = both
    fresh = bpe.Coder(coder.vocabulary)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    for text in ("one two three four five", "two six", "one"):
        assert ids_of(fresh, [text]) == ids_of(coder, [text])


def test_query_columns(spark, both):
    coder, library = both
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Hello, world", "y"), (3, "Hello, world", "y"), (None, "a b", "z")], "doc_id long, text string, ids string")
    for r in bpe.code_digests(df, coder.vocabulary).collect():
        text = {1: "", 2: "", 3: "Hello, world", None: "a b"}[r.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.code_digests(df, coder.vocabulary).count() == 5
    rows = bpe.encode_decode(df, coder.vocabulary).collect()
    assert sorted(len(r.ids) for r in rows) == sorted(len(library.encode(t, add_special_tokens=False).ids) for t in ("", "", "Hello, world", "Hello, world", "a b"))
    assert bpe.code_digests(df.limit(0), coder.vocabulary).count() == 0
