"""Tables that follow the stream: counts added up batch by batch against the full build."""

import pytest
from pyspark.sql import functions as F

from askgauge.operators.enrich import enrich_responses
from askgauge.plans import marts
from askgauge.sources import derived, files
from askgauge.streaming import grading, tables
from conftest import plan_of
from oracle_compare import rows_of


def same(ours, theirs):
    a, b = (rows_of(df.columns, df.collect()) for df in (ours, theirs))
    assert a[0] == b[0] and len(a[1]) == len(b[1]) > 0
    for x, y in zip(a[1], b[1]):
        assert all(p == q or float(p) == pytest.approx(float(q), abs=2e-4) for p, q in zip(x, y))


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    """Response files, the staged questions, and the joined responses of the batch functions."""
    path = str(tmp_path_factory.mktemp("landed"))
    responses = derived.responses(spark, sf_dir)
    for k in range(5):
        files.append_responses(responses.where(F.pmod(F.xxhash64("run_id", "question_id"), F.lit(5)) == k).coalesce(1), f"{path}/responses")
    derived.staged_questions(spark, sf_dir).write.parquet(f"{path}/questions")
    derived.enriched_responses(spark, sf_dir).write.parquet(f"{path}/enriched")
    return path


@pytest.fixture(scope="module")
def store(spark, landed):
    store = tables.CountStore(spark, f"{landed}/store")
    questions = spark.read.parquet(f"{landed}/questions")
    tables.start_counting(spark, f"{landed}/responses", questions, store, f"{landed}/progress", max_files=1).awaitTermination()
    return store


def test_five_batches_and_a_replay_equal_the_build(spark, landed, store):
    seen, upto = store.ledger()
    assert len(seen) == 5 and upto == -1
    enriched = spark.read.parquet(f"{landed}/enriched")
    assert store.add(seen[2], enriched) is False  # the same batch again adds nothing
    made = store.tables()
    assert set(made) == set(marts.MART_BUILDERS)
    for name, table in made.items():
        same(table, marts.MART_BUILDERS[name](enriched))
    assert store.responses().count() == enriched.count()


def test_nothing_but_counts_is_read(store):
    for name, table in store.tables().items():
        assert "/responses/" not in plan_of(table), name
    plan = plan_of(store.tables()["mart_leaderboard"])
    scans = [line for line in plan.split("\n") if "FileScan" in line and "response_time_s" in line]
    assert scans and all("bucket_range" in line.split("PartitionFilters")[1] for line in scans)


def test_a_batch_that_failed_before_the_ledger_is_written_again(spark, landed, tmp_path):
    enriched = spark.read.parquet(f"{landed}/enriched")
    store = tables.CountStore(spark, str(tmp_path))
    half = [enriched.where(F.col("model_key") < "m2"), enriched.where(F.col("model_key") >= "m2")]
    store.add(0, half[0])
    finish, store._finish = store._finish, lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        store.add(1, half[1])
    store._finish = finish
    same(store.tables()["mart_leaderboard"], marts.leaderboard(half[0]))  # the half batch is not in sight
    assert store.add(1, half[1])
    for name in ("mart_leaderboard", "mart_question_insights"):
        same(store.tables()[name], marts.MART_BUILDERS[name](enriched))


def test_compaction_changes_nothing_and_keeps_the_ledger(spark, landed, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "COMPACT_AFTER", 2)
    enriched = spark.read.parquet(f"{landed}/enriched")
    store = tables.CountStore(spark, str(tmp_path))
    for k in range(6):
        assert store.add(k, enriched.where(F.pmod(F.xxhash64("question_id"), F.lit(6)) == k))
    seen, upto = store.ledger()
    assert len(seen) <= 3 and upto >= 2 and all(store.knows(k) for k in range(6))
    assert store.add(1, enriched) is False
    for name, table in store.tables().items():
        same(table, marts.MART_BUILDERS[name](enriched))
    assert store.responses().count() == enriched.count()


def test_awkward_responses_in_parts(spark, tmp_path):
    """Repeated pairs, missing models and attributes: counts of parts add up to the tables of the whole."""
    import test_marts

    rows = test_marts.awkward_rows()
    whole = spark.createDataFrame(rows, test_marts.SCHEMA).withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(3))).cache()
    models = whole.where("model_key is not null").select("model_key").distinct()
    models = spark.createDataFrame([(r["model_key"], 60 + 3 * i) for i, r in enumerate(models.collect())], "model_key string, number long")
    parts = [whole.where(F.col("part") == k) for k in range(3)]

    def summed(kind, make):
        first, *others = [make(p) for p in parts]
        for other in others:
            first = first.unionByName(other)
        return tables.add_up(kind, first)

    votes = summed("votes", lambda p: marts.question_votes(p, models))
    same(marts.insights_of(votes), marts.question_insights(whole))
    same(marts.temperature_effect_of(summed("pairs", marts.temperature_cells)), marts.temperature_effect(whole))
    times = summed("times", marts.run_times)
    same(marts.leaderboard_of(marts.run_buckets(times), times), marts.leaderboard(whole))


def test_more_models_than_a_word_holds(spark):
    """150 models, three words of bits."""
    import test_marts

    fields = {f.name: None for f in test_marts.SCHEMA} | {"temperature": 0.0, "question_id": "q", "correct_answer": "w"}
    rows = []
    for m in range(150):
        right = m % 3 == 0
        values = fields | {"model_key": f"m{m}", "ai_answer": "w" if right else "x", "ai_correct": right, "is_valid_format": True}
        rows += [tuple(values.values())] * (1 + m % 2)
    df = spark.createDataFrame(rows, test_marts.SCHEMA)
    models = spark.createDataFrame([(f"m{m}", m) for m in range(150)], "model_key string, number long")
    row = marts.insights_of(marts.question_votes(df, models)).first()
    assert (row.n_models, row.n_models_correct_once) == (150, 50)
    same(marts.insights_of(marts.question_votes(df, models)), marts.question_insights(df))


def test_stored_times_give_the_exact_quantile(spark, tmp_path):
    """A million distinct times: the ranges around the quantile are read, one or two of them."""
    import numpy as np
    import test_marts

    times = np.random.default_rng(4).lognormal(0, 2, 1_000_000)
    fields = {f.name: f"cast(null as {f.dataType.simpleString()})" for f in test_marts.SCHEMA}
    fields |= {"model_key": "'m'", "temperature": "0D", "is_valid_format": "true", "ai_correct": "true", "response_time_s": "t"}
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame({"t": times})).repartition(8).selectExpr(*(f"{e} as {n}" for n, e in fields.items()))
    df.write.parquet(f"{tmp_path}/responses")
    marts.run_times(spark.read.parquet(f"{tmp_path}/responses")).hint("rebalance", "bucket_range").write.partitionBy("bucket_range").parquet(f"{tmp_path}/times")
    stored = spark.read.parquet(f"{tmp_path}/times")
    made = marts.leaderboard_of(marts.run_buckets(stored), stored)
    assert made.first().p95_response_time_s == pytest.approx(np.quantile(times, 0.95), abs=6e-5)
    plan = plan_of(made)
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "response_time_s" in line)
    assert "bucket_range" in scan.split("PartitionFilters")[1] and "/responses" not in plan
