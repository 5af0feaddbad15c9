"""What a task holds and how often the responses are read, as tables grow: asserted on plans, results against the plain way."""

import re

import pytest
from pyspark.sql import functions as F

import test_marts
from askgauge.catalogue import QUERIES
from askgauge.operators.enrich import FROM_QUESTIONS, enrich_responses
from askgauge.plans import marts, reports
from askgauge.schemas import ENRICHED_COLUMNS
from conftest import plan_of


def rows_in_order(df):
    return sorted(map(str, df.collect()))


def answers(spark, n=1500, seed=5):
    """Awkward joined responses; the first 25 fields, since another module adds to the list of them."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in test_marts.SCHEMA.fields[:25])
    return spark.createDataFrame(test_marts.awkward_rows(n, seed), fields).repartition(5)


def judged(spark):
    """Awkward responses as grades, without what their questions say, and those questions."""
    given = answers(spark)
    fields = given.columns
    listed = (
        given.groupBy("question_id")
        .agg(*(F.max(c).alias(c) for c in fields if c in FROM_QUESTIONS))
        .withColumns({"category": F.lit("c"), "nb_options": F.lit(4).cast("tinyint")})
    )
    kept = listed.where("question_id <> 'q3'")  # one question is unknown, two are listed more than once
    twice = kept.where("question_id IN ('q0', 'q5')")
    absent = [c for c in ENRICHED_COLUMNS if c not in fields and c not in (*FROM_QUESTIONS, "random_baseline")]
    told = given.withColumn("question_id", F.nullif("question_id", F.lit("q9")))
    graded = told.drop(*FROM_QUESTIONS, "random_baseline").withColumns({c: F.lit(None).cast("string") for c in absent})
    return graded, kept.union(twice).union(twice.where("question_id = 'q0'"))


def test_insights_joined_last_equal_those_of_joined_responses(spark):
    graded, questions = judged(spark)
    joined_first = marts.question_insights(enrich_responses(graded, questions))
    found, expected = rows_in_order(marts.question_insights_of(graded, questions)), rows_in_order(joined_first)
    assert found == expected and len(found) > 50


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
@pytest.mark.parametrize("name", ["question_insights", "question_search", "question_explorer", "trap_list"])
def test_counts_per_question_carry_no_texts(spark, sf_dir, name, broadcast):
    """F16 to F19: responses are counted, shuffled and sorted without the texts of their questions."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = plan_of(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    counting = [keys for keys in re.findall(r"Aggregate\(keys=\[(.*?)\]", plan) if "model_key" in keys]
    assert len(counting) == 2 and not [keys for keys in counting if "question_text" in keys]


def test_profiles_carry_the_baseline_of_the_leaderboard(spark):
    df = answers(spark)
    joined = reports.profile_with_baseline(marts.model_profile(df), marts.leaderboard(df)).collect()
    carried = reports.best_first(marts.model_profile(df, with_baseline=True)).collect()
    assert [r.asDict() for r in carried] == [r.asDict() for r in joined] and len(joined) == 3


def test_leaderboard_without_quantile(spark):
    df = answers(spark)
    whole = marts.leaderboard(df).drop("p95_response_time_s")
    found = marts.leaderboard(df, quantile=None)
    assert found.columns == whole.columns and rows_in_order(found) == rows_in_order(whole)


SCANS = {"profile_report": 1, "winner_vs_runner_up": 1, "status_shares": 1, "format_report": 2, "temperature_report": 2, "volumes": 2}


@pytest.mark.parametrize("name", SCANS)
def test_reports_without_quantile_do_not_scan_for_it(spark, sf_dir, name):
    """one scan of the line items per table that a report is made of; the runs' own listing reads two columns."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    scans = re.findall(r"FileScan parquet \[(.*?)\]", plan)
    assert len([columns for columns in scans if "l_partkey" in columns]) == SCANS[name]
