import hashlib
import random

import numpy as np
import pytest

from askgauge.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def own():
    return bpe.vocabulary(bpe.default_path())


def awkward():
    chance = random.Random(3)
    pools = [range(0, 0x180), range(0x180, 0x3000), range(0xE000, 0x20000), [0x1C, 0x85, 0xA0, 0x2028, 0x20, 0x27]]
    texts = [
        "".join(chr(chance.choice(pool)) if chance.random() < 0.6 else chance.choice(" a1_'s\n") for _ in range(40))
        for pool in pools
        for _ in range(50)
    ]
    return texts + ["", "ab" * 20_000, "é" * 500, "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "I'M don't 'RE  \n\n x"]


def test_ids_equal_the_library(own, library):
    texts = awkward()
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_long_and_short_words_merge_alike(own):
    words = [b"tokenization", b"aaaaaaaaaaaa", "größer".encode(), b"x"]
    assert own.merge_short(words) == [own.merge_long(w) for w in words]


def test_a_full_cache_changes_nothing(own, monkeypatch):
    before = [x.tolist() for x in own.encode(["some words here", "and there"])]
    monkeypatch.setattr(bpe, "CACHED_WORDS", 0)
    assert [x.tolist() for x in own.encode(["some words here", "and there"])] == before


def test_bytes_that_are_no_text(own):
    assert own.decode(np.array([own.byte_ids[0xC3]])) == "�"


def test_awkward_tables(spark):
    rows = [(1, None, "x"), (2, "", "y"), (2, "a b", None), (2, "a b", None), (None, "a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    encoded = bpe.encode_documents(df)
    assert encoded.columns == ["doc_id", "text", "ids", "ids_sha256"]
    back = bpe.decode_documents(encoded, keep_ids=True).collect()
    assert sorted(r["decoded"] for r in back) == ["", "", "a b", "a b", "a b"]
    assert {r["ids_sha256"] for r in back if not r["ids"]} == {hashlib.sha256(b"").hexdigest()}
    assert bpe.decode_documents(bpe.encode_documents(df.limit(0))).count() == 0
    both = bpe.encode_documents(df, decoded="ids_text").collect()
    assert sorted(r["ids_text"] for r in both) == sorted(r["decoded"] for r in back)


def test_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.QUERIES["op1_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
