import hashlib

import pytest
from pyspark.sql import functions as F

from askgauge.operators import prompting


def ids(spark, n=500):
    return spark.range(n).select(F.md5(F.col("id").cast("string")).alias("question_id"))


def test_permutation_is_a_permutation_and_ignores_layout(spark):
    questions = ids(spark)
    ranks = {r.question_id: r.sample_rank for r in prompting.seeded_permutation(questions, [42]).collect()}
    assert sorted(ranks.values()) == list(range(1, 501))
    again = prompting.seeded_permutation(questions.repartition(7), [42], digits=1).collect()
    assert {r.question_id: r.sample_rank for r in again} == ranks
    expected = sorted(ranks, key=lambda q: hashlib.md5(f"42:{q}".encode()).hexdigest())
    assert sorted(ranks, key=ranks.get) == expected


def test_permutation_head_and_several_seeds(spark):
    whole = prompting.seeded_permutation(ids(spark), [1, 2])
    head = prompting.seeded_permutation(ids(spark), [1, 2], n=10)
    kept = {tuple(r) for r in head.select("sample_seed", "question_id", "sample_rank").collect()}
    everything = {tuple(r) for r in whole.select("sample_seed", "question_id", "sample_rank").collect()}
    assert kept == {r for r in everything if r[2] <= 10} and len(kept) == 20
    assert prompting.first_by_id(ids(spark), 3).count() == 3


def test_choices_are_shuffled_by_question_only(spark):
    df = spark.createDataFrame(
        [(f"q{i}", "multiple", "ok", ["w1", "w2", "w3"]) for i in range(200)] + [("b", "boolean", "False", ["True"])],
        "question_id string, type string, correct_answer string, incorrect_answers array<string>",
    )
    choices = prompting.build_choices(*(F.col(c) for c in df.columns))
    rows = df.select("question_id", "type", choices.alias("c")).collect()
    assert all(sorted(r.c) == ["ok", "w1", "w2", "w3"] for r in rows if r.type == "multiple")
    assert {r.c.index("ok") for r in rows if r.type == "multiple"} == {0, 1, 2, 3}
    assert [r.c for r in rows if r.type == "boolean"] == [["True", "False"]]


@pytest.mark.parametrize(
    "style, listing, label",
    [("letters", "A. x\nB. y", "B"), ("numbers", "1. x\n2. y", "2"), ("text", "- x\n- y", "y")],
)
def test_rendering(spark, style, listing, label):
    df = spark.createDataFrame([(["x", "y"], "y", style)], "c array<string>, a string, s string")
    row = df.select(
        prompting.render_options(F.col("c"), F.col("s")), prompting.correct_label(F.col("c"), F.col("a"), F.col("s")),
        prompting.correct_label(F.col("c"), F.lit("nowhere"), F.col("s")),
    ).first()
    assert tuple(row) == (listing, label, None)


def test_trial_rendering(spark):
    df = spark.createDataFrame([(["x", "y"],)], "c array<string>")
    assert df.select(prompting.render_options(F.col("c"), F.lit("letters"), ") ")).first()[0] == "A) x\nB) y"


def test_template_leaves_braces_in_texts_alone(spark):
    df = spark.createDataFrame([("Q: {question}\n{options}!", "use {options}?", "- {question}")], "t string, q string, o string")
    filled = df.select(prompting.fill_template(F.col("t"), F.col("q"), F.col("o"))).first()[0]
    assert filled == "Q: use {options}?\n- {question}!"


def test_system_prompt(spark):
    df = spark.createDataFrame([("s", "TRUE"), ("s", "false")], "p string, d string")
    got = [r[0] for r in df.select(prompting.final_system_prompt(F.col("p"), F.col("d"))).collect()]
    assert got == ["s /no_think", "s"]


def test_work_list_and_resume(spark):
    runs = spark.createDataFrame([("r1", 1, 42), ("r2", 2, 42), ("r3", 3, 7)], "run_id string, run_order int, sample_seed int")
    work = prompting.work_list(runs, ids(spark, 40), n=15)
    assert work.groupBy("run_id").count().orderBy("run_id").collect() == [("r1", 15), ("r2", 15), ("r3", 15)]
    done = work.where((F.col("run_id") == "r1") | (F.col("sample_rank") <= 5)).select("run_id", "question_id")
    left = prompting.remaining_work(work, done.union(done))
    assert {(r.run_id, r["count"]) for r in left.groupBy("run_id").count().collect()} == {("r2", 10), ("r3", 10)}
    assert [r.run_id for r in prompting.select_runs(runs, [3, 1]).collect()] == ["r1", "r3"]
    with pytest.raises(ValueError):
        prompting.select_runs(runs, [9])


def test_work_list_follows_whatever_seeds_the_runs_have(spark):
    runs = spark.createDataFrame([("r1", 1), ("r2", 2), ("r3", 2)], "run_id string, sample_seed int")
    work = prompting.work_list(runs, ids(spark, 12))
    assert work.groupBy("run_id").count().orderBy("run_id").collect() == [("r1", 12), ("r2", 12), ("r3", 12)]
    order = {r: [x.question_id for x in work.where(F.col("run_id") == r).orderBy("sample_rank").collect()] for r in ("r1", "r2", "r3")}
    assert order["r2"] == order["r3"] != order["r1"]
    listed = prompting.seeded_permutation(ids(spark, 12), (1, 2)).where("sample_seed = 1").orderBy("sample_rank")
    assert [x.question_id for x in listed.collect()] == order["r1"]
    assert prompting.work_list(runs.limit(0), ids(spark, 12)).count() == 0


def test_run_follow_up(spark):
    config = spark.createDataFrame(
        [(1, "r1", "m1", "v1"), (2, "r2", "m1", "v2"), (3, "r3", "m2", "v1"), (4, "r4", "m3", "v1")],
        "run_order int, run_id string, lmstudio_id string, prompt_version string",
    )
    assert {tuple(r) for r in prompting.runs_per_model(config).collect()} == {("m1", 2), ("m2", 1), ("m3", 1)}
    assert sorted(r.run_id for r in prompting.one_run_per_model(config).collect()) == ["r1", "r3", "r4"]
    assert [r.run_id for r in prompting.one_run_per_model(config, "v2").collect()] == ["r2"]
    todo = spark.createDataFrame([("r2", "a"), ("r2", "b"), ("r3", "a"), ("r4", "a")], "run_id string, question_id string")
    graded = spark.createDataFrame(
        [("r2", True, True, "2025-01-01T10:00:00"), ("r2", False, True, "2025-01-01T10:03:00")],
        "run_id string, ai_correct boolean, is_valid_format boolean, created_at string",
    ).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    rows = {r.run_id: tuple(r)[1:] for r in prompting.run_summary(config, todo, graded, ["m3"]).collect()}
    assert rows == {
        "r1": ("déjà terminée", 0, None, None, None),
        "r2": ("terminée", 2, 0.5, 1.0, 3.0),
        "r3": ("incomplète", 0, None, None, None),
        "r4": ("modèle introuvable", 0, None, None, None),
    }
    times = spark.createDataFrame([("m1", 2.0), ("m1", 4.0)], "lmstudio_id string, response_time_s double")
    assert [tuple(r) for r in prompting.projected_minutes(times, config, 100).collect()] == [("m1", 2, 3.0, 10.0)]
