"""Generated functions that the JVM compiles: over 8,000 bytes of code they stay interpreted, at twice the CPU time."""

import re

import pytest
from pyspark.sql import functions as F

from askgauge.operators.enrich import enrich_responses
from askgauge.operators.scoring import grade, grade_responses
from askgauge.operators.staging import stage_responses
from askgauge.sources import derived, files

MOST_BYTES = 8000


@pytest.fixture
def whole_plans(spark):
    """Plans that are generated at once, not stage by stage."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


def largest(spark, df):
    said = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said))


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
@pytest.mark.parametrize("name", ["responses", "graded_responses", "enriched_responses", "trial_answers"])
def test_derived_tables_are_compiled(spark, sf_dir, whole_plans, name, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert largest(spark, getattr(derived, name)(spark, sf_dir)) <= MOST_BYTES
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_response_files_graded_and_joined_are_compiled(spark, sf_dir, whole_plans, tmp_path):
    files.append_responses(derived.responses(spark, sf_dir), f"{tmp_path}/responses")
    derived.staged_questions(spark, sf_dir).write.parquet(f"{tmp_path}/questions")
    graded = grade_responses(stage_responses(files.read_responses(spark, f"{tmp_path}/responses")))
    joined = enrich_responses(graded, spark.read.parquet(f"{tmp_path}/questions"))
    assert largest(spark, graded) <= MOST_BYTES and largest(spark, joined) <= MOST_BYTES


def test_options_are_read_for_text_answers_only(spark):
    """Options that are null or empty, and styles that are not text, are graded as before."""
    rows = [("text", ["Red ", "blue"], "'RED.'"), ("text", None, "red"), ("letters", ["Red", "blue"], "A"), (None, ["Red"], "Red"),
            ("text", [None, "blue"], "Blue!"), ("text", [], "")]
    given = spark.createDataFrame(rows, "label_style string, choices array<string>, raw_response string")
    graded = grade(given.withColumns({"correct_answer": F.lit("blue"), "stop_reason": F.lit(None).cast("string")}))
    assert [r.ai_position for r in graded.collect()] == [1, None, 1, None, 2, None]
    assert not [c for c in graded.columns if c.startswith("_")]
