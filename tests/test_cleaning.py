import hashlib
import json

import pytest
from pyspark.sql import functions as F

from askgauge.functions.text import json_list
from askgauge.operators import cleaning, quality
from askgauge.schemas import CLEAN_QUESTIONS, RAW_QUESTIONS

GOOD = ("multiple", "easy", "History", "Who?", "A", '["B", "C", "D"]')
RAW = "type string, difficulty string, category string, question string, correct_answer string, incorrect_answers string"


def raw(spark, *changes):
    rows = [GOOD] + [tuple(change.get(n, v) for n, v in zip(RAW_QUESTIONS.fieldNames(), GOOD)) for change in changes]
    return spark.createDataFrame(rows, RAW)


def failed(report):
    return {r.check: r.n_violations for r in report.collect() if not r.ok}


def test_clean_data_passes_every_check(spark):
    assert failed(quality.verify(quality.check_raw_questions(raw(spark)))) == {}


@pytest.mark.parametrize(
    "change, check",
    [
        ({"question": ""}, "no_blank_value"),
        ({"type": "open"}, "known_type"),
        ({"difficulty": "extreme"}, "known_difficulty"),
        ({"incorrect_answers": '["B", "C"]'}, "multiple_has_three_wrong"),
        ({"type": "boolean", "correct_answer": "True"}, "boolean_has_one_wrong"),
        ({"type": "boolean", "incorrect_answers": '["False"]'}, "boolean_answer_is_true_or_false"),
        ({"type": None}, "known_type"),
    ],
)
def test_raw_contract(spark, change, check):
    report = quality.check_raw_questions(raw(spark, change))
    assert failed(report)[check] == 1
    with pytest.raises(quality.ContractError, match=check):
        quality.verify(report)


def test_raw_contract_on_bad_json_and_columns(spark):
    assert failed(quality.check_raw_questions(raw(spark, {"incorrect_answers": "not json"}))) == {
        "wrong_answers_are_a_list": 1,
        "multiple_has_three_wrong": 1,
    }
    shuffled = raw(spark).select(*reversed(RAW_QUESTIONS.fieldNames()))
    assert failed(quality.check_raw_questions(shuffled)) == {"expected_columns": 1}


def clean_row(**changes):
    row = dict(
        question_id="0" * 12, type="multiple", difficulty="easy", difficulty_level=1, category="History",
        category_group="History", category_name="History", question="Who?", correct_answer="A",
        incorrect_answers=["B", "C", "D"], nb_options=4,
    )
    return tuple({**row, **changes}[n] for n in CLEAN_QUESTIONS.fieldNames())


@pytest.mark.parametrize(
    "changes, check",
    [
        ({}, "question_id_unique"),
        ({"question_id": "x", "incorrect_answers": ["B", "&amp;", "D"]}, "no_html_entity"),
        ({"question_id": "x", "question": "Who? "}, "no_outer_space"),
        ({"question_id": "x", "incorrect_answers": ["B", "\u00a0C", "D"]}, "no_outer_space"),
        ({"question_id": "x", "category": ""}, "no_empty_text"),
        ({"question_id": "x", "incorrect_answers": ["A", "C", "D"]}, "answer_not_among_wrong"),
        ({"question_id": "x", "incorrect_answers": ["B", "b", "D"]}, "no_duplicate_option"),
        ({"question_id": "x", "nb_options": 2}, "option_count_matches_type"),
    ],
)
def test_clean_contract(spark, changes, check):
    df = spark.createDataFrame([clean_row(), clean_row(**changes)], CLEAN_QUESTIONS)
    assert failed(quality.check_clean_questions(df))[check] == 1


def test_read_back_contract(spark):
    df = spark.createDataFrame([clean_row()], CLEAN_QUESTIONS)
    assert failed(quality.check_written_questions(df, 1)) == {}
    assert set(failed(quality.check_written_questions(df.withColumn("nb_options", F.lit(3)), 2))) == {
        "row_count",
        "wrong_answers_are_lists",
    }
    assert failed(quality.check_written_questions(df.limit(0), 0)) == {}


def test_empty_input_has_no_violation(spark):
    assert failed(quality.check_raw_questions(raw(spark).limit(0))) == {}


@pytest.mark.parametrize(
    "category, group, name",
    [
        ("Entertainment: Video Games", "Entertainment", "Video Games"),
        ("Science & Nature", "Science", "Nature"),
        ("Science: Computers: Old", "Science", "Old"),
        ("History", "History", "History"),
    ],
)
def test_category_split(spark, category, group, name):
    df = spark.createDataFrame([(category,)], "c string").select(*cleaning.split_category(F.col("c")))
    assert tuple(df.first()) == (group, name)


def test_clean_questions_end_to_end(spark):
    rows = [
        (2, "multiple", "hard", "Entertainment: Film", "Who&#039;s  on\u00a0first?", "A&amp;B", '["x", " y ", "z&lt;"]'),
        (1, "multiple", "easy", "Entertainment: Film", "WHO'S ON FIRST?", "a&b", '["1", "2", "3"]'),
        (3, "boolean", "medium", "Science & Nature", "Is it\u00ad?", "True", '["False"]'),
    ]
    df = spark.createDataFrame(rows, f"seq int, {RAW}")
    got = {r.question: r for r in cleaning.clean_questions(df, "seq").collect()}
    assert set(got) == {"WHO'S ON FIRST?", "Is it?"}
    first, second = got["WHO'S ON FIRST?"], got["Is it?"]
    assert first.question_id == hashlib.md5(b"who's on first?||a&b").hexdigest()[:12]
    assert (first.difficulty_level, first.nb_options, first.category_group, first.category_name) == (1, 4, "Entertainment", "Film")
    assert (second.difficulty_level, second.nb_options, second.category_name) == (2, 2, "Nature")
    identified = cleaning.derive_attributes(cleaning.clean_texts(df))
    groups = cleaning.duplicate_rows(identified, "question_id").orderBy("seq").collect()
    assert [r.seq for r in groups] == [1, 2] and groups[1].incorrect_answers == ["x", "y", "z<"]
    summary = cleaning.duplicate_summary(identified, "question_id").first()
    assert tuple(summary) == (3, 2, 1, 1)


def test_dominant_key_is_reduced_before_the_shuffle(spark):
    copies = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    first = cleaning.keep_first(copies, "k", "id")
    rows = {r.k: r.id for r in first.collect()}
    assert rows["hot"] == 0 and len(rows) == copies.select("k").distinct().count()
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert cleaning.duplicate_rows(copies, "k").count() == 6667


def test_from_json_matches_python(spark):
    texts = ['["a", "b\\u00e9"]', "[]", '["x\\"y"]']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.from_json("t", "array<string>"))
    assert [r[0] for r in df.collect()] == [json.loads(t) for t in texts]


@pytest.mark.parametrize(
    "text, parsed",
    [
        ('["a","b","c"]', ["a", "b", "c"]),
        (' [ "a" ] ', ["a"]),
        ("[]", []),
        ('["a","b","c"] junk', None),
        ('["a","b","c"]]', None),
        ('["a"],["b"]', None),
        ('["a",null]', None),
        ('{"a": 1}', None),
        ("not json", None),
        ("", None),
        (None, None),
    ],
)
def test_a_list_is_nothing_but_a_list(spark, text, parsed):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(json_list(F.col("t"))).first()[0] == parsed
    if text:
        report = quality.check_raw_questions(raw(spark, {"incorrect_answers": text}))
        assert ("wrong_answers_are_a_list" in failed(report)) == (parsed is None)


def test_questions_that_share_an_identifier_are_not_lost(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "question_key", lambda question, answer: F.lit("0" * 12))
    rows = raw(spark, {"question": "Another?"}, {"question": "ANOTHER?"}).withColumn("seq", F.monotonically_increasing_id())
    clean = cleaning.clean_questions(rows, "seq")
    assert {r.question for r in clean.collect()} == {"Who?", "Another?"}
    assert failed(quality.check_clean_questions(clean)) == {"question_id_unique": 1}
