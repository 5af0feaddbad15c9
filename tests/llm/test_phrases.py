import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from askgauge.llm import phrases, queries
from oracle_compare import compare, connect

SCHEMA = "lang string, text string"


def pieces(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def grams(rows, longest=5):
    found, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            totals[lang] += len(w)
            for size in range(1, longest + 1):
                found.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    return found, totals


def brute(rows, least, longest, top):
    f, totals = grams(rows, longest)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    by_lang = {}
    for (lang, p), a in candidates.items():
        inside = any(
            lang == other and len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), b in candidates.items()
        )
        if inside:
            continue
        cuts = [
            (1000 * a * totals[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        ]
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    result = []
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def test_query(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    n, problems, *_ = compare(spark, connect(sf_dir), queries.QUERIES["op12_phrases"], queries.ORACLES["op12_phrases"], sf_dir)
    assert problems == [] and n > 20


def awkward():
    chooser = random.Random(11)
    vocabulary = ["the", "The", "of", "a", "é", "ß", "x\r", "new", "york", "new york city", "new york city hall", " ", "|"]
    ends = [" ", "  ", "\t", ". ", "\n", ", ", "\x0b", ":", " "]
    rows = [
        (chooser.choice(["en", "en", "de", None, "und", ""]),
         "".join(chooser.choice(vocabulary) + chooser.choice(ends) for _ in range(chooser.randrange(40))))
        for _ in range(300)
    ]
    return rows + [(None, None), ("en", ""), ("en", " .\n"), ("fr", None), ("en", "b c " * 20_000)] + rows[:40]


@pytest.mark.parametrize("least,longest,top", [(5, 5, 2000), (12, 4, 7), (3, 2, 50), (6, 3, 100)])
def test_awkward_rows_against_brute_force(spark, least, longest, top):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = phrases.collocations(df, least=least, longest=longest, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, longest, top)


def test_spilling_and_bursting_change_nothing(spark):
    rows = [r for r in awkward() if r[0] == "en"][:-45]
    want, _ = grams(rows)
    counter = phrases.Counter("en", 5, burst=3)
    got = Counter()

    def gather(batches):
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("prefix", "rest"))))
            assert rows == sorted(rows, key=lambda r: (r[0].encode(), r[1].encode())) or not rows[0][1]
            for (prefix, rest), n in zip(rows, batch.column("n").to_pylist()):
                got[tuple((prefix + " " + rest).strip(" ").split(" "))] += n

    burst = 0
    for _, text in rows:
        counter.add([(text or "").encode().translate(phrases.CLEAN)])
        burst += any(isinstance(b, phrases.BurstTrie) for b in counter.trie.root.values())
        gather(counter.spill(60))
        assert counter.trie.size <= 60 and counter.trie.size == sum(1 for _ in counter.trie.pairs())
    gather(counter.finish())
    assert burst and counter.trie.size == 0
    assert got == Counter({p: n for (_, p), n in want.items()})


def test_a_task_that_spills_counts_the_same(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    want, _ = grams(rows, 3)
    for options in ({"held": 5}, {"words_held": 4}):
        got = phrases.counts(df.coalesce(1), 3, **options).collect()
        assert {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in got} == want
    assert all(len(r["phrase"].split(" ")) == r["words"] for r in got)


def test_filters_hide_nothing(spark):
    words = phrases.word_hashes(b"en", [f"w{i}".encode() for i in range(3000)])
    keys = phrases.pair_hashes(words[:-1], words[1:])
    assert len(np.unique(keys)) == len(keys) and not set(keys) & set(phrases.pair_hashes(words[1:], words[:-1]))
    bits = phrases.bit_filter(spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long"))
    assert phrases.passes(bits, keys).all()
    assert phrases.passes(bits, phrases.pair_hashes(words[1:], words[:-1])).mean() < 0.15


def test_rare_words_are_forgotten_and_nothing_else():
    texts = [t.encode() for t in ("a b x1 a b", "a b x2", "x1 a b")]
    frequent = phrases.word_hashes(b"en", [b"a", b"b"])
    bits = np.zeros(2**13, np.uint8)
    for at in (frequent & np.uint64(2**16 - 1)).tolist():
        bits[at >> 3] |= 1 << (at & 7)
    counter = phrases.Counter("en", 2, bits)
    for text in texts:
        counter.add([text])
        counter.forget()
    assert set(counter.numbers) == {b"\n", b"a", b"b"} and counter.numbers.next > 4
    rows = {(p, r): n for b in counter.finish() for p, r, n in zip(*(b.column(c).to_pylist() for c in ("prefix", "rest", "n")))}
    assert rows == {("a b", ""): 4, ("a", ""): 4, ("b", ""): 4}


def test_hashed_counts(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    want, _ = grams(rows, 2)
    for size, bits in ((1, None), (2, np.full(8192, 255, np.uint8))):
        got = sorted(r["n"] for r in phrases.hashed_counts(df, bits).collect())
        assert got == sorted(n for k, n in want.items() if len(k[1]) == size)


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000
    cell = spark.createDataFrame([(big, 3 * big, 2 * big, 5 * big)], "a long, total long, l long, r long")
    above = (F.col("a").cast("decimal(19,0)") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(23,0)") * F.col("total").cast("decimal(19,0)")
    below = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    row = cell.select(above.cast("decimal(38,0)").alias("above"), below.cast("decimal(38,0)").alias("below")).selectExpr("above div below as s")
    assert row.first()["s"] == 1000 * big * 3 * big // (2 * big * 5 * big)


def test_empty_table_and_clashing_names(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [("en", "a b c")] * 9
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *(F.lit(1).alias(c) for c in ("phrase", "n", "words", "prefix", "k")))
    assert sorted(map(tuple, phrases.collocations(df, least=5).collect())) == brute(rows, 5, 5, 2000)
