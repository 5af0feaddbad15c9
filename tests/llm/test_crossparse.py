import pickle
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from askgauge.llm import crossparse, queries


def brute_phrases(text, sample):
    """Greedy parse of each stretch into longest matches with the sample, by substring search."""
    total = 0
    for a in range(0, len(text), crossparse.STRETCH):
        part, i = text[a : a + crossparse.STRETCH], 0
        while i < len(part):
            n = 1
            while i + n < len(part) and part[i : i + n + 1] in sample:
                n += 1
            i += n
            total += 1
    return total


SAMPLES = {"xx": "the cat sat on the mat and the dog", "yy": "le chat est sur le tapis et le chien", "zz": "ab"}


def test_phrases_equal_brute_force():
    model = crossparse.Model(SAMPLES)
    texts = ["the cat", "", "q", "qq the", "le chat et the dog", "abab", "the " * 400, "é the"]
    got = model.phrases(texts)
    for text, row in zip(texts, got.tolist()):
        assert row == [brute_phrases(text, SAMPLES[x]) for x in model.languages]


@given(st.dictionaries(st.sampled_from("xyz"), st.text("abcde ", min_size=1, max_size=60), min_size=1), st.lists(st.text("abcdef ", max_size=40), max_size=4))
@settings(max_examples=60, deadline=None)
def test_phrases_of_any_text(samples, texts):
    model = crossparse.Model(samples)
    want = [[brute_phrases(t, samples[x]) for x in model.languages] for t in texts]
    assert model.phrases(texts).tolist() == want


def test_transitions_are_a_map():
    numbers = np.random.default_rng(3)
    keys = np.unique(numbers.integers(0, 10**12, 20_000))
    values = numbers.integers(1, 10**6, len(keys))
    table = crossparse.Transitions(keys, values)
    assert (table[keys] == values).all() and (table[keys[:100].reshape(10, 10)] == values[:100].reshape(10, 10)).all()
    others = np.setdiff1d(numbers.integers(0, 10**12, 20_000), keys)
    assert not table[others].any()
    assert not crossparse.Transitions(keys[:0], values[:0])[keys].any()


def test_large_alphabets_stay_small():
    """Three languages of 5,000 symbols each: the size follows the characters, not the alphabet."""
    numbers = np.random.default_rng(5)
    samples = {f"l{k}": "".join(map(chr, numbers.integers(0x4E00, 0x4E00 + 5000, 24_000))) for k in range(3)}
    model = crossparse.Model(samples)
    assert model.width > 4900 and len(pickle.dumps(model)) < 300 * 3 * 24_000
    texts = [samples[x][k : k + 200] for k, x in enumerate(model.languages)]
    assert model.predict(texts)[0] == model.languages


def test_forced_ends_do_not_decide(spark, sf_dir, monkeypatch):
    """Parses cut every STRETCH characters name the same languages as parses that are hardly ever cut."""
    where = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text", "lang")
    model = crossparse.fit(docs.where("doc_id % 4 <> 2"))
    texts = [r["text"] for r in docs.where("doc_id % 4 = 2").collect()]
    cut = model.predict(texts)
    monkeypatch.setattr(crossparse, "STRETCH", 8192)
    whole = model.predict(texts)
    assert cut[0] == whole[0]
    assert max(abs(a - b) for a, b in zip(cut[1], whole[1])) < 0.05


def test_prediction():
    model = crossparse.Model({k: SAMPLES[k] for k in ("xx", "yy")})
    languages, scores = model.predict(["The cat, the mat!", "le tapis", None, "123 ...", ""])
    assert languages == ["xx", "yy", "und", "und", "und"]
    assert scores[2:] == [0, 0, 0] and all(0.5 < s <= 1 for s in scores[:2])
    assert crossparse.Model({}).predict(["a"]) == (["und"], [0.0])
    assert crossparse.Model({"only": "abc"}).predict(["abc"])[0] == ["only"]


def test_fit_is_bounded_and_ignores_what_teaches_nothing(spark):
    rows = [(i, f"word{chr(97 + i % 26)} and more {chr(97 + i % 26)}", "xx" if i % 2 else "yy") for i in range(400)]
    rows += [(None, "sans id", "yy"), (900, "no language", None), (901, None, "ww"), (902, "123", "vv")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = crossparse.fit(docs, sample_docs=8, sample_chars=50)
    assert model.languages == ["xx", "yy"]
    assert crossparse.fit(docs.limit(0)).languages == []


def test_awkward_tables(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 2.0), (2, "the cat", 2.0), (2, "the cat", 2.0)], "doc_id long, text string, Score double")
    got = crossparse.identify(docs, crossparse.Model(SAMPLES))
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    assert sorted(r["lang_pred"] for r in got.collect()) == ["und", "und", "xx", "xx"]
    assert crossparse.identify(docs.limit(0), crossparse.Model(SAMPLES)).count() == 0


@pytest.mark.parametrize("source", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, sf_dir, source):
    where = sf_dir.replace("sf0.001", source)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{where}/documents.parquet").collect()}
    got = queries.QUERIES["op7_crossparse"](spark, where).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", docs[r["doc_id"]]["text"] or ""))
    held = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.95 * len(held)
