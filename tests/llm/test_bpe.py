"""Byte-pair encoding against the tokenizers library."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from vitals.llm import bpe

PATH = bpe.default_path()
HARD = [
    "", " ", "a\x1cb", "ΑΣ Σ ΟΔΥΣΣΕΥΣ İx", "<|startoftext|>hi<|endoftext|> <|startoftext|", "it's don't we'LL 'S 'ſ", "123 ½² x...",
    "é é ﬁ ǅ", "x" * 5000, "ab" * 3000 + "!" * 2000, "🎉👍🏽 日本語​﻿", "\x85\xa0 a　b", "a\u0000b",
]


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def agree(codec, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == want
    assert codec.decode(want) == library.decode(want, skip_special_tokens=False)
    assert bpe.TextCodec(codec)(text) == (len(want), " ".join(map(str, want)), codec.decode(want))


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(codec, library, text):
    agree(codec, library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FFF, blacklist_categories=("Cs", "Cn")), max_size=40))
def test_any_text(codec, library, text):
    agree(codec, library, text)


def test_every_code_point(codec, library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}1{chr(c)}b" for c in codes[i : i + 500]) for i in range(0, len(codes), 500)]
    mine = bpe.TextCodec(codec).batch(texts)
    for text, found, want in zip(texts, mine, library.encode_batch(texts, add_special_tokens=False)):
        if found[1] != " ".join(map(str, want.ids)):
            odd = [hex(ord(w[1])) for w in text.split(" ") if codec.encode(w) != library.encode(w, add_special_tokens=False).ids]
            assert not odd, odd


def test_words_merged_together_or_alone_are_the_same(codec):
    import random

    draw = random.Random(8)
    words = ["".join(draw.choice("abcdeilnorstu'é日") for _ in range(draw.randrange(1, 50))) for _ in range(3000)]
    for word, ids in zip(words, codec.words(words)):
        data = word.encode()
        alone = codec.inner[list(data)].tolist()
        alone[-1] = int(codec.final[data[-1]])
        assert ids == bpe.merged(alone, codec.ranks, codec.results)


def test_cache_keeps_its_bound(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 50)
    one = bpe.TextCodec(codec)
    for i in range(30):
        text = " ".join(f"w{i}x{j}," for j in range(20)) + " the <|endoftext|>"
        assert one(text)[1] == " ".join(map(str, codec.encode(text)))
        assert len(one.known) <= 50 and len(one.old) <= 50


def test_merges_take_the_leftmost_lowest_rank():
    ranks = {1 << 20 | 1: 0, 2 << 20 | 2: 1, 1 << 20 | 2: 2}  # 11 -> 2, 22 -> 3, 12 -> 4
    assert bpe.merged([1, 1, 1], ranks, [2, 3, 4]) == [2, 1]
    assert bpe.merged([1, 1, 1, 1], ranks, [2, 3, 4]) == [3]
    assert bpe.merged([1], ranks, [2, 3, 4]) == [1] and bpe.merged([], ranks, [2, 3, 4]) == []


def test_query_on_a_table(spark, library):
    got = {r["doc_id"]: r for r in bpe.op8_bpe(spark, SF_SMALL).collect()}
    for row in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = library.encode(row["text"], add_special_tokens=False).ids
        mine = got.pop(row["doc_id"])
        assert mine["n_tokens"] == len(ids)
        assert mine["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert mine["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not got


def test_odd_rows(odd_docs, empty_docs, library):
    found = bpe.encoded(odd_docs, PATH)
    rows = found.withColumn("id_list", bpe.id_array(found["ids"])).collect()
    assert found.columns == [*odd_docs.columns, "n_tokens", "ids", "decoded"] and len(rows) == odd_docs.count()
    for r in rows:
        assert r["id_list"] == library.encode(r["text"] or "", add_special_tokens=False).ids and r["n_tokens"] == len(r["id_list"])
    assert bpe.encoded(empty_docs, PATH).count() == 0
