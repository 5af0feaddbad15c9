import corpus_pipeline
from askgauge.llm import mixing, repeats
from askgauge.llm.common import written

import test_decision_rules
import test_repeats
import test_simhash


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    start = {r["doc_id"]: r["text"] for r in docs.collect()}
    tables = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), f"test-{name}")
        tables.append(docs)
    assert all(t.columns == columns for t in tables[:-1])

    good = {r["doc_id"]: r["text"] for r in tables[0].collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    passed = {d for d, t in start.items() if not test_decision_rules.base(t)["base_failed"]}
    assert set(good) <= passed
    assert all(quality.get(d) == 0 or d not in quality for d in passed - set(good))

    order = sorted(good)
    place = test_simhash.brute_kept([good[d] for d in order])
    single = {r["doc_id"]: r["text"] for r in tables[1].collect()}
    assert single == {d: good[d] for i, d in enumerate(order) if place[i] == i}

    want = test_repeats.brute(sorted(single.items()))
    cut = {r["doc_id"]: r for r in tables[2].collect()}
    assert set(cut) == set(single)
    for d, r in cut.items():
        spans = sorted(want.get(d, []))
        assert r["text"] == repeats.without_spans(single[d], *zip(*spans))[0] if spans else r["text"] == single[d]
        assert r["n_chars"] == len(r["text"])

    mixed = tables[3].collect()
    assert {r["doc_id"] for r in mixed} <= set(cut) and all(r["text"] == cut[r["doc_id"]]["text"] for r in mixed)
    assert len(mixed) == mixing.mix(tables[2]).count()

    ids = tables[4].collect()
    assert sorted(r["doc_id"] for r in ids) == sorted(r["doc_id"] for r in mixed)
    assert all(len(r["ids"]) == r["n_tokens"] for r in ids)


def test_run_is_the_stages(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert got.count() > 50


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), f"empty-{name}")
        assert docs.count() == 0
