import hashlib

from pyspark.sql import functions as F

from askgauge.llm import imatch, queries


def test_lexicon_is_the_band(spark):
    rows = [(i, " ".join(["all"] + ["half"] * (i % 2) + [f"own{i}"] + ["FEW"] * (i < 3))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert imatch.lexicon(docs, low=2 / 40, high=20 / 40) == [b"few", b"half"]
    assert imatch.lexicon(docs.limit(0)) == []


def test_likeness_falls_with_edits():
    words = [f"term{i}".encode() for i in range(600)]
    make = imatch.Fingerprinter(sorted(words))
    text = " ".join(f"term{i}" for i in range(300))
    steps = [make(" ".join(f"term{i}" for i in range(k, 300 + k))) for k in (0, 3, 30, 100, 300)]
    found = [imatch.likeness(steps[0], s) for s in steps]
    assert found[0] == 1.0 and make(text) == steps[0]
    assert found == sorted(found, reverse=True) and found[1] > 0.7 and found[-1] == 0.0
    assert make("term1 " + text) == steps[0]  # terms count once, in any order
    assert make(None) == make(" \n") == "0" * imatch.PARTS * imatch.DIGITS


def test_ring_closes_every_run(spark):
    rows = [(i * i, f"t{i}") for i in range(50)] + [(None, "n"), (None, "m"), (4, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    placed = [tuple(r) for r in imatch.ring(docs, 7).select("doc_id", "h", "run", "extra").collect()]
    runs = {}
    for doc, h, run, extra in placed:
        runs.setdefault(run, []).append((extra, doc is None, -(doc or 0), -h))
    ordered = [sorted(runs[r]) for r in sorted(runs)]
    assert sum(not x[0] for r in ordered for x in r) == len(rows)
    for run, following in zip(ordered, ordered[1:] + ordered[:1]):
        assert run[-1][0] and run[-1][1:] == following[0][1:]


def test_awkward_tables(spark):
    rows = [(3, None), (5, ""), (5, ""), (9, "a b"), (None, "c d e f"), (9, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("run", F.lit("clash"))
    got = imatch.compare_with_next(docs, imatch.lexicon(docs)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert imatch.compare_with_next(docs.limit(0), []).count() == 0
    alone = imatch.compare_with_next(docs.where("doc_id = 3"), []).collect()
    assert [(r["doc_id"], r["near_next"]) for r in alone] == [(3, 1.0)]


def test_query(spark, sf_dir):
    rows = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()), reverse=True)
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_imatch"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        n = len(text) // 3
        changed = text[: len(text) - n] + after[1][:n]
        r = got[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert r["near_next"] == imatch.likeness(r["fingerprint"], got[after[0]]["fingerprint"])
        assert r["near_edited"] == imatch.likeness(r["fingerprint"], r["edited_fingerprint"])
    long = [r for r in got.values() if r["n_chars"] > 500]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.9 * len(long)
