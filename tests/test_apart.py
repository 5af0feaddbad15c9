"""Contracts judged in the writing pass, with the refused rows set aside."""

import pytest
from pyspark.sql import functions as F

from askgauge.operators import quality
from askgauge.plans import warehouse
from askgauge.schemas import CLEAN_QUESTIONS
from askgauge.sources import derived, files
from conftest import plan_of
from test_cleaning import GOOD, RAW, failed, raw


def reports_as_set(report):
    return {tuple(r) for r in report.collect()}


def apart(spark, df, conditions, path):
    quality.write_apart(df, conditions, path)
    return quality.read_apart(spark, path, df.schema)


def test_same_report_as_the_separate_pass(spark, sf_dir, tmp_path):
    faulty = derived.faulty_raw_questions(spark, sf_dir)
    conditions = quality.raw_question_conditions()
    written = apart(spark, faulty, conditions, f"{tmp_path}/raw")
    report = quality.check_written_apart(written, conditions, "bronze")
    whole = reports_as_set(quality.check_raw_questions(faulty))
    assert reports_as_set(report) == {r for r in whole if r[1] != "expected_columns"}
    assert failed(report)
    clean = derived.faulty_clean_questions(spark, sf_dir)
    conditions = quality.clean_question_conditions()
    written = apart(spark, clean, conditions, f"{tmp_path}/clean")
    report = quality.check_written_apart(written, conditions, "silver", quality.unique_question_check())
    assert reports_as_set(report) == reports_as_set(quality.check_clean_questions(clean))


def test_rows_are_parted_and_none_is_lost(spark, tmp_path):
    rows = raw(spark, {"question": ""}, {"type": None}, {"type": "open", "difficulty": "extreme"}, {"incorrect_answers": "["})
    written = apart(spark, rows, quality.raw_question_conditions(), f"{tmp_path}/t")
    accepted, refused = quality.accepted_rows(written), quality.refused_rows(written)
    assert [tuple(r) for r in accepted.collect()] == [GOOD]
    assert sorted(tuple(r.failed_checks) for r in refused.collect()) == [
        ("known_type", "known_difficulty"),
        ("no_blank_value",),
        ("no_blank_value", "known_type", "boolean_has_one_wrong", "boolean_answer_is_true_or_false"),
        ("wrong_answers_are_a_list", "multiple_has_three_wrong"),
    ]
    # Neither side reads the files of the other, and the report reads the names only.
    assert "PartitionFilters: [isnotnull(refused" in plan_of(accepted)
    report = quality.check_written_apart(written, quality.raw_question_conditions(), "bronze")
    assert "ReadSchema: struct<failed_checks:array<string>>" in plan_of(report)


def test_source_is_read_once(spark, tmp_path):
    """A source that counts how often a row is made: judging and writing make each row once."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = raw(spark, {"question": ""}).mapInArrow(count, RAW)
    quality.write_apart(rows, quality.raw_question_conditions(), f"{tmp_path}/t")
    assert made.value == 2


@pytest.mark.parametrize("changes", [[], [{"question": ""}]])
def test_empty_and_refused_only(spark, tmp_path, changes):
    rows = raw(spark, *changes).where(F.col("question") != "Who?")
    conditions = quality.raw_question_conditions()
    written = apart(spark, rows, conditions, f"{tmp_path}/t")
    assert quality.accepted_rows(written).count() == 0
    assert quality.refused_rows(written).count() == len(changes)
    report = quality.check_written_apart(written, conditions, "bronze")
    assert report.count() == len(conditions) and len(failed(report)) == len(changes)


def test_build_goes_on_without_the_refused(spark, tmp_path):
    rows = raw(spark, {"question": "  WHO? "}, {"question": "Which?", "type": "open"}, {"question": "When?", "correct_answer": "B"})
    rows.coalesce(1).write.options(header=True, quote='"', escape='"').csv(f"{tmp_path}/raw")
    collected = files.read_raw_questions(spark, f"{tmp_path}/raw")
    accepted, report = warehouse.build_accepted_questions(collected, f"{tmp_path}/out", spark)
    assert accepted.columns == CLEAN_QUESTIONS.fieldNames()
    assert [r.question for r in accepted.collect()] == ["Who?"]
    assert {(r.stage, r.check): r.n_violations for r in report.collect() if not r.ok} == {
        ("bronze", "known_type"): 1,
        ("silver", "answer_not_among_wrong"): 1,
        ("silver", "no_duplicate_option"): 1,
    }
    aside = quality.refused_rows(quality.read_apart(spark, f"{tmp_path}/out/silver", CLEAN_QUESTIONS))
    assert [r.question for r in aside.collect()] == ["When?"]
    with pytest.raises(quality.ContractError, match="expected_columns"):
        warehouse.build_accepted_questions(collected.drop("type"), f"{tmp_path}/never", spark)
