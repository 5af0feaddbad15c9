"""Silver tables bucketed by question: no shuffle of the responses, and none of it where a key dominates."""

import pytest
from pyspark.sql import functions as F

from askgauge.operators import prompting
from askgauge.operators.enrich import enrich_responses
from askgauge.plans import marts, warehouse
from askgauge.schemas import ENRICHED_COLUMNS, GRADED_COLUMNS
from askgauge.sources import derived
from conftest import plan_of
from test_follow import same

N = 8


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    questions = derived.questions(spark, sf_dir).drop("seq")
    written = warehouse.build_silver(spark, questions, derived.responses(spark, sf_dir), "t_buckets", buckets=N)
    assert [t.split(".")[1] for t in written] == [
        "int_answered_pairs", "int_questions", "int_ai_responses_scored", "int_responses_enriched"]
    return "t_buckets"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def below_exchanges(plan):
    """Of every scan of a plan, the operators above it up to the first shuffle."""
    lines = plan.split("\n")
    branches = []
    for i in (i for i, line in enumerate(lines) if "FileScan" in line):
        branch, depth = [], len(lines[i])
        for line in reversed(lines[: i + 1]):
            at = len(line) - len(line.lstrip(" :+-"))
            if at >= depth and branch:
                continue  # of another branch
            if "Exchange" in line:
                break
            branch.append(line)
            depth = at
        branches.append(branch)
    return branches


def test_the_join_shuffles_nothing(spark, silver, no_broadcast):
    joined = enrich_responses(
        warehouse.columns_of(spark.table(f"{silver}.int_ai_responses_scored"), GRADED_COLUMNS),
        spark.table(f"{silver}.int_questions"),
    )
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = enrich_responses(
        spark.table(f"{silver}.int_ai_responses_scored").hint("rebalance"), spark.table(f"{silver}.int_questions")
    )
    assert "Exchange" in plan_of(plain)
    same(joined, derived.enriched_responses(spark, "/root/testdata/sf0.001"))


def test_votes_are_counted_where_they_lie(spark, silver, no_broadcast):
    made = marts.question_insights(spark.table(f"{silver}.int_responses_enriched"))
    for branch in below_exchanges(plan_of(made)):
        # Counted to the end, in part and whole, before anything moves.
        assert sum("HashAggregate" in line for line in branch) >= 2 and "Bucketed: true" in branch[0]


def test_answered_pairs_are_not_shuffled(spark, sf_dir, silver, no_broadcast):
    answered = spark.table(f"{silver}.int_answered_pairs")
    assert answered.count() == answered.distinct().count()
    todo = derived.responses(spark, sf_dir).select("run_id", "question_id", F.lit(1).alias("x")).unionByName(
        spark.createDataFrame([("r", "q", 2), (None, "q", 3)], "run_id string, question_id string, x int"))
    left = prompting.remaining_work(todo, answered)
    scan = next(b for b in below_exchanges(plan_of(left)) if "int_answered_pairs" in b[0].lower())
    assert any("Join" in line for line in scan)
    assert sorted(r.x for r in left.collect()) == [2, 3]


def test_all_tables_are_those_of_the_plain_build(spark, sf_dir):
    questions, responses = derived.questions(spark, sf_dir).drop("seq"), derived.responses(spark, sf_dir)
    names = warehouse.build(spark, questions, responses, "tb_silver", "tb_gold", buckets=N)
    assert "tb_silver.int_questions" in names
    enriched = warehouse.columns_of(spark.table("tb_silver.int_responses_enriched"), ENRICHED_COLUMNS)
    for name in ("mart_leaderboard", "mart_question_insights", "mart_temperature_effect"):
        same(warehouse.load_mart(spark, name, "tb_gold"), marts.MART_BUILDERS[name](enriched))


def test_a_dominant_question_is_left_unbucketed(spark, sf_dir):
    responses = derived.responses(spark, sf_dir)
    first = derived.questions(spark, sf_dir).agg(F.min("question_id")).first()[0]
    heavy = responses.withColumn(
        "question_id", F.when(F.pmod(F.xxhash64("run_id", "question_id"), F.lit(3)) > 0, first).otherwise(F.col("question_id"))
    )
    assert warehouse.evenly(responses, warehouse.Buckets(N)) and not warehouse.evenly(heavy, warehouse.Buckets(N))
    assert warehouse.evenly(responses.limit(0), warehouse.Buckets(N))
    questions = derived.questions(spark, sf_dir).drop("seq")
    written = warehouse.build_silver(spark, questions, heavy, "t_heavy", buckets=N)
    assert "t_heavy.int_questions" not in written
    described = spark.sql("DESCRIBE EXTENDED t_heavy.int_ai_responses_scored").where("col_name = 'Num Buckets'")
    assert described.isEmpty()
    assert spark.table("t_heavy.int_responses_enriched").count() == heavy.count()
