import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from askgauge.llm import queries, simhash


def fingerprint(text, shingle=3):
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, reach=3):
    """Component of each place in a list of fingerprints, by the smallest place."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    array = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= reach):
            a, b = root(i), root(int(j))
            up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def brute_kept(texts):
    """Component of each text, by the smallest place."""
    return brute_components([fingerprint(t) for t in texts])


def test_lightly_edited_copies_go(spark):
    chance = random.Random(8)
    texts = [" ".join(f"w{chance.randrange(5000)}" for _ in range(2000)) for _ in range(12)]
    edited = [f"{t} end" for t in texts]
    df = spark.createDataFrame(list(enumerate(texts + edited)), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.keep_one(df).collect()} == set(range(12))


def test_kept_documents_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = brute_kept([t for _, t in rows])
    kept = sorted(r["doc_id"] for r in simhash.keep_one(docs).collect())
    assert kept == [rows[i][0] for i, x in enumerate(want) if x == i]


def test_the_tree_is_used_from_some_thousand_prints(spark):
    """The whole of the largest test table is routed through vantage points, not compared in one cell."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    prints = {fingerprint for fingerprint in (simhash.text_fingerprint(r["text"]) for r in docs.limit(3000).collect())}
    tree = simhash.build_tree(np.array(sorted(prints), np.uint64), 10 * simhash.LEAF)
    assert len(tree.vantage) >= 9


def test_fingerprints():
    texts = [None, "", " \n", "One", "one TWO", "a b c", "a b c a b c d", "É é x", "w " * 5000]
    assert [simhash.text_fingerprint(t) for t in texts] == [fingerprint(t) for t in texts]
    assert simhash.text_fingerprint("a b c d e f", 5) == fingerprint("a b c d e f", 5)


def clustered(seed=1, n=400):
    """Random prints, dense groups around some, and chains of small steps."""
    chance = random.Random(seed)
    prints = [chance.getrandbits(64) for _ in range(n)]
    for p in prints[:4]:
        prints += [p ^ sum(1 << b for b in chance.sample(range(64), chance.randint(0, 4))) for _ in range(100)]
    step = prints[10]
    for _ in range(40):
        step ^= 1 << chance.randrange(64) | 1 << chance.randrange(64)
        prints.append(step)
    return prints


@pytest.mark.parametrize("leaf", [16, 64, 10_000])
def test_components_equal_brute_force(spark, monkeypatch, leaf):
    prints = clustered()
    monkeypatch.setattr(simhash, "LEAST_SAMPLE", 4)
    distinct = sorted(set(prints))
    df = spark.createDataFrame([(int(np.array(p, np.uint64).view(np.int64)),) for p in distinct], "fp long")
    stars = simhash.components(simhash.links(df, leaf=leaf)).collect()
    root = {r["node"]: r["root"] for r in stars}
    signed = np.array(distinct, np.uint64).view(np.int64).tolist()
    groups = {}
    for place, p in zip(brute_components(distinct), signed):
        groups.setdefault(place, set()).add(p)
    for group in groups.values():
        assert {root.get(p, p) for p in group} == {min(group)}


def test_tree_prunes_and_misses_nothing():
    prints = np.array(clustered(2, 3000), np.uint64)
    tree = simhash.build_tree(prints, len(prints), 200)
    at, leaf, own = tree.route(prints, 3)
    assert own.sum() == len(prints) and len(set(zip(at, leaf))) == len(at)
    assert len(np.unique(leaf)) > 8
    member = {i: x for i, x, o in zip(at.tolist(), leaf.tolist(), own.tolist()) if o}
    searched = {}
    for i, x in zip(at.tolist(), leaf.tolist()):
        searched.setdefault(i, set()).add(x)
    for i in range(0, len(prints), 7):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3).tolist():
            assert member[j] in searched[i] or member[i] in searched[j]


def test_awkward_tables(spark):
    rows = [(5, None), (3, ""), (9, "a b c d"), (7, "A b c d"), (7, "A b c d"), (None, "a b c d"), (None, "alone x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    found = sorted(((r["doc_id"], r["component_id"]) for r in got.collect()), key=repr)
    assert found == sorted([(5, 3), (3, 3), (9, 7), (7, 7), (7, 7), (None, 7), (None, None)], key=repr)
    kept = simhash.keep_one(df)
    assert kept.columns == ["doc_id", "text", "fp"]
    named = simhash.keep_one(df.withColumn("place", F.lit(111)).withColumn("root", F.lit(5)).withColumn("h", F.lit(6)))
    assert {tuple(r)[3:] for r in named.collect()} == {(111, 5, 6)}
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(
        [(3, "", "clash"), (7, "A b c d", "clash"), (None, "alone x y z", "clash")], key=repr
    )
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    prints = [fingerprint(t) for _, t in rows]
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_simhash"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for (doc, _), p, place in zip(rows, prints, brute_components(prints)):
        assert got[doc]["fingerprint"] == f"{p:016x}"
        assert got[doc]["component_id"] == rows[place][0]
