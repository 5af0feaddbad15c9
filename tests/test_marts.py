"""The evaluation tables on awkward data, against DuckDB and by hand."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from askgauge.oracles import BLOCKS
from askgauge.plans import marts
from conftest import plan_of
from oracle_compare import rows_of

TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "tinyint": T.ByteType(),
    "boolean": T.BooleanType(),
}
COLUMNS = (
    "model_key string, model_name string, model_publisher string, model_country string, model_params_b "
    "double, prompt_version string, label_style string, temperature double, question_id string, "
    "question_type string, difficulty string, difficulty_level tinyint, category_group string, "
    "category_name string, question_text string, random_baseline double, correct_answer string, "
    "correct_position int, ai_position int, ai_answer string, is_valid_format boolean, ai_correct "
    "boolean, response_time_s double, completion_tokens int, is_truncated boolean "
)
SCHEMA = T.StructType([T.StructField(n, TYPES[t]) for n, t in (c.split() for c in COLUMNS.split(","))])
PROMPTS = [("v1", "letters", 0.0), ("v1b", "letters", 0.0), ("v2", "numbers", 0.0), ("v3", "text", 0.0),
           ("v4", "letters", 1.0), ("v5", "letters", 0.5)]


def awkward_rows(n=3000, seed=11):
    """Repeated (run, question) pairs, missing attributes, unreadable answers, one dominant question."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        m = rng.choice([0, 0, 1, 2, None])
        prompt, style, temperature = rng.choice(PROMPTS)
        q = 0 if rng.random() < 0.35 else rng.randrange(60)
        boolean = q % 5 == 0
        options = ["True", "False"] if boolean else ["w", "x", "y", "z"]
        right = None if q == 7 else q % len(options) + 1
        chosen = None if rng.random() < 0.2 else rng.randint(1, len(options))
        level = [("easy", 1), ("medium", 2), ("hard", 3), (None, None)][q % 4]
        category = [("Arts", "Film"), ("Arts", "Music"), ("History", "History"), (None, "Odd")][q % 7 % 4]
        rows.append((
            None if m is None else f"m{m}", f"Model {m}", "lab", "FR", None if m is None else m * 2.5 + 1,
            prompt, style, temperature, f"q{q}", "boolean" if boolean else "multiple", *level, *category, f"text {q}",
            1 / len(options), "elsewhere" if right is None else options[right - 1], right, chosen,
            None if chosen is None else options[chosen - 1], chosen is not None,
            chosen is not None and chosen == right, None if rng.random() < 0.1 else rng.randrange(1, 4000) / 1000,
            None if rng.random() < 0.1 else rng.randrange(60), rng.choice([True, False, None]),
        ))
    return rows


@pytest.fixture(scope="module")
def awkward(spark):
    rows = awkward_rows()
    con = duckdb.connect()
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMA).replace(" string", " varchar")
    con.execute(f"CREATE TABLE enr ({columns})")
    con.executemany(f"INSERT INTO enr VALUES ({', '.join('?' * len(SCHEMA))})", rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache(), con


def mart_sql(name):
    blocks = []

    def visit(block):
        for needed in BLOCKS[block][1]:
            if needed != "enr":
                visit(needed)
        if block not in blocks:
            blocks.append(block)

    visit(name)
    return "WITH " + ", ".join(f"{b} AS ({BLOCKS[b][0]})" for b in blocks) + f" SELECT * FROM {name}"


@pytest.mark.parametrize("name", marts.MART_BUILDERS)
def test_against_duckdb(awkward, name):
    enriched, con = awkward
    df = marts.MART_BUILDERS[name](enriched)
    cursor = con.execute(mart_sql(name))
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    ours = rows_of(df.columns, df.collect())
    assert df.columns == [d[0] for d in cursor.description] or set(df.columns) == set(theirs[0])
    assert ours == theirs


def test_leaderboard_quantile_is_exact(awkward):
    enriched, _ = awkward
    pandas = enriched.toPandas()
    for row in marts.leaderboard(enriched).collect():
        mine = pandas[(pandas.model_name == row.model_name) & (pandas.prompt_version == row.prompt_version)]
        assert row.p95_response_time_s == pytest.approx(np.quantile(mine.response_time_s.dropna(), 0.95), abs=1e-4)


def test_invariants(awkward):
    enriched, _ = awkward
    for row in marts.leaderboard(enriched).collect():
        assert row.accuracy_ci_low <= row.accuracy <= row.accuracy_ci_high
        assert row.accuracy <= row.valid_format_rate
    effect = marts.temperature_effect(enriched, with_grouping_id=True).collect()
    for total in (r for r in effect if r.grouping_id == 1):
        parts = [r for r in effect if r.grouping_id == 0 and r.model_name == total.model_name]
        assert sum(r.n_questions for r in parts) == total.n_questions
    # A question without difficulty shares the label of the total row; the grouping id tells them apart.
    assert any(r.difficulty == "all" and r.grouping_id == 0 for r in effect)


def test_ties_go_to_the_first_prompt_and_answer(spark):
    base = dict(zip(SCHEMA.fieldNames(), awkward_rows(1)[0]))
    base |= dict(model_key="m", question_id="q", correct_answer="a", temperature=0.0, is_valid_format=True)

    def row(**changes):
        return tuple({**base, **changes}[n] for n in SCHEMA.fieldNames())

    df = spark.createDataFrame(
        [row(prompt_version=p, ai_answer=a, ai_correct=False) for p in ("v2", "v1") for a in ("d", "c")], SCHEMA
    )
    profile = marts.model_profile(df).first()
    assert (profile.best_prompt, profile.worst_prompt, profile.prompt_spread) == ("v1", "v1", 0.0)
    insight = marts.question_insights(df).first()
    assert (insight.majority_answer, insight.top_wrong_answer, insight.top_wrong_votes) == ("c", "c", 2)
    assert insight.is_common_trap and insight.is_all_wrong and not insight.is_majority_correct


def test_size_classes(spark):
    df = spark.createDataFrame([(1.9,), (2.0,), (5.0,), (None,)], "p double").select(marts.size_class(F.col("p")))
    assert [r[0] for r in df.collect()] == [
        "très petit (< 2B)", "petit (2-5B)", "moyen (5B et plus)", "moyen (5B et plus)"]


@pytest.mark.parametrize("name", marts.MART_BUILDERS)
def test_plans_scan_the_responses_once(spark, awkward, name, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("enriched"))
    awkward[0].write.mode("overwrite").parquet(path)
    plan = plan_of(marts.MART_BUILDERS[name](spark.read.schema(SCHEMA).parquet(path)))
    # The exact quantile reads the times once more.
    assert plan.count("FileScan parquet") == (2 if name == "mart_leaderboard" else 1)
    if name == "mart_leaderboard":
        assert "BroadcastHashJoin" in plan
        plan = plan.replace("BroadcastHashJoin", "")
    assert "Join" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    # The only single-partition steps are ranks over a finished table, above every other exchange.
    below = plan.split("Exchange SinglePartition")[-1]
    assert below.count("HashAggregate") >= 2
    if name in ("mart_model_profile", "mart_prompt_format", "mart_question_insights"):
        assert "PushedFilters: [IsNotNull(temperature)" in plan and "EqualTo(temperature,0.0)" in plan


def test_a_group_without_prompt_is_never_the_best_or_the_worst(spark):
    rows = [
        (prompt, right) for prompt, shares in ((None, [1, 1, 1]), ("v2", [1, 1, 0]), ("v3", [0, 0, 1])) for right in shares
    ]
    values = {"model_key": "m", "temperature": 0.0, "is_valid_format": True}
    df = spark.createDataFrame(
        [tuple({**values, "prompt_version": p, "ai_correct": bool(r)}.get(f.name) for f in SCHEMA) for p, r in rows], SCHEMA
    )
    got = marts.model_profile(df).first()
    assert (got.best_prompt, got.best_prompt_accuracy) == ("v2", 1.0)
    assert (got.worst_prompt, got.worst_prompt_accuracy) == ("v3", 0.3333)


def test_quantile_of_many_distinct_times(spark):
    rng = np.random.default_rng(4)
    times = np.concatenate([rng.lognormal(0, 2, 300_000), -rng.random(1_000), np.zeros(500), np.full(20_000, 3.25)])
    fields = {f.name: "cast(null as " + f.dataType.simpleString() + ")" for f in SCHEMA}
    fields |= {"model_key": "'m'", "temperature": "0D", "is_valid_format": "true", "ai_correct": "true", "response_time_s": "t"}
    df = spark.createDataFrame([(float(t),) for t in times], "t double").repartition(8)
    df = df.selectExpr(*(f"{e} as {n}" for n, e in fields.items()))
    for quantile in (0.0, 0.5, 0.95, 1.0):
        got = marts.leaderboard(df, quantile).first().p95_response_time_s
        assert got == pytest.approx(np.quantile(times, quantile), abs=6e-5)


def test_no_window_holds_the_distinct_times_of_a_run(spark, awkward):
    df = awkward[0] if isinstance(awkward, tuple) else awkward
    plan = plan_of(marts.leaderboard(df))
    ordered = [line for line in plan.split("\n") if "response_time_s" in line and "windowspecdefinition" in line]
    assert ordered and all("bucket" in line.split("windowspecdefinition")[1].split("response_time_s")[0] for line in ordered)


@pytest.mark.parametrize("name", marts.FROM_COUNTS)
def test_tables_from_counted_responses(awkward, name):
    make = marts.MART_BUILDERS[name]
    whole, counted = (rows_of(df.columns, df.collect()) for df in (make(awkward[0]), make(marts.count_responses(awkward[0]))))
    assert counted[0] == whole[0] and len(counted[1]) == len(whole[1])
    for a, b in zip(counted[1], whole[1]):
        assert all(x == y or float(x) == pytest.approx(float(y), abs=2e-4) for x, y in zip(a, b))
