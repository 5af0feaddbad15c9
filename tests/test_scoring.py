import random
import re

import pytest
from pyspark.sql import functions as F

from askgauge.operators.scoring import grade, lenient_letter

FOUR = ["Canada", "Chad", "Peru", "Fiji"]
TWO = ["True", "False"]
SCHEMA = (
    "i int, label_style string, choices array<string>, correct_answer string, raw_response string, stop_reason string"
)


def graded(spark, cases, correct="Peru", stop=None):
    rows = [(i, style, choices, correct, raw, stop) for i, (style, choices, raw) in enumerate(cases)]
    return grade(spark.createDataFrame(rows, SCHEMA)).orderBy("i").collect()


CASES = [
    ("letters", FOUR, "C", 3),
    ("letters", FOUR, "(b)", 2),
    ("letters", FOUR, "C.", 3),
    ("letters", FOUR, "C)", 3),
    ("letters", FOUR, "C:", 3),
    ("letters", FOUR, "C. Peru", 3),
    ("letters", FOUR, 'C. "peru!"', 3),
    ("letters", FOUR, "<think>A</think>\nD", 4),
    ("letters", FOUR, "<think>A\nB</think><think>B</think>D", 4),
    ("letters", FOUR, "<think>A", None),
    ("letters", FOUR, "Answer: A", 1),
    ("letters", FOUR, "RÉPONSE - A", 1),
    ("letters", FOUR, "A\n", 1),
    ("letters", FOUR, "C\n\nPeru", 3),
    ("letters", FOUR, "x_REASONING_END_0a__B", 2),
    ("letters", FOUR, "x_REASONING_END_0a__A_REASONING_END_ff__B", 2),
    ("letters", FOUR, "The answer is C", None),
    ("letters", FOUR, "1789", None),
    ("letters", FOUR, "C. Canada", None),
    ("letters", FOUR, "", None),
    ("letters", FOUR, None, None),
    ("letters", TWO, "D", None),
    ("letters", TWO, "B. False", 2),
    ("letters", FOUR, "2", None),
    ("letters", FOUR, "C\u000b", None),
    ("numbers", FOUR, "3", 3),
    ("numbers", FOUR, "3) Peru", 3),
    ("numbers", FOUR, "C", None),
    ("text", FOUR, "peru", 3),
    ("text", FOUR, "**Peru.**", 3),
    ("text", FOUR, '"Peru"', 3),
    ("text", FOUR, "It is Peru", None),
    ("text", FOUR, "Peru\nbecause", 3),
    ("text", ["Canada", "Peru", "Canada"], "Canada  ", 1),
    ("unknown", FOUR, "C", None),
]


def test_reading_rules(spark):
    rows = graded(spark, [c[:3] for c in CASES])
    got = [(c[0], c[2], r.ai_position) for c, r in zip(CASES, rows)]
    assert got == [(c[0], c[2], c[3]) for c in CASES]


def test_grades(spark):
    rows = graded(spark, [("letters", FOUR, "C"), ("letters", FOUR, "A"), ("letters", FOUR, "?"), ("text", FOUR, "peru")])
    assert [r.answer_status for r in rows] == ["correct", "incorrect", "invalid_format", "correct"]
    assert [r.ai_correct for r in rows] == [True, False, False, True]
    assert [r.is_valid_format for r in rows] == [True, True, False, True]
    assert [r.ai_label for r in rows] == ["C", "A", None, "Peru"]
    assert [r.ai_answer for r in rows] == ["Peru", "Canada", None, "Peru"]
    assert {r.correct_position for r in rows} == {3}


def test_missing_values(spark):
    (row,) = graded(spark, [("letters", FOUR, "C")], correct="Mars")
    assert row.correct_position is None and row.ai_correct is False and row.is_truncated is None
    (row,) = graded(spark, [("letters", FOUR, "C")], correct=None, stop="MAXPREDICTEDTOKENSreached")
    assert row.ai_correct is False and row.answer_status == "incorrect" and row.is_truncated is True


# --- A second reader, written from the rule's description, on random answers ---

SPACE = " \t\n\f\r"


def squash(text):
    bare = text.strip(SPACE).strip("\"'`*").strip(SPACE).rstrip(".!").strip(SPACE)
    return re.sub(f"[{SPACE}]+", " ", bare).lower()


def expected_position(style, choices, raw):
    body = re.sub("<think>.*?</think>", "", raw, flags=re.S)
    if m := re.match(".*_REASONING_END_[0-9a-f]+__", body, flags=re.S):
        body = body[m.end():]
    if m := re.match(f"[{SPACE}]*(?:answer|réponse)[{SPACE}]*[-:][{SPACE}]*", body, flags=re.I):
        body = body[m.end():]
    body = body.strip(SPACE)
    if body == "":
        return None
    if style == "text":
        line = re.split("[\r\n]", body)[0]
        return next((i for i, c in enumerate(choices, 1) if squash(c) == squash(line)), None)
    token, rest = re.fullmatch(f"([^{SPACE}]+)(.*)", body, flags=re.S).groups()
    label = re.fullmatch(r"\(?([A-Da-d1-4])[).:]?", token)
    offered = ("ABCD" if style == "letters" else "1234")[: len(choices)]
    if not label or label[1].upper() not in offered:
        return None
    place = offered.index(label[1].upper())
    rest = rest.strip(SPACE)
    return place + 1 if rest == "" or squash(rest) == squash(choices[place]) else None


def test_random_answers_agree_with_second_reader(spark):
    rng = random.Random(3)
    pieces = (
        ["A", "b", "C", "D", "1", "2", "4", "(", ")", ".", ":", " ", "\n", "\t", "Peru", "peru", "Canada", "True", "false"]
        + ["<think>", "</think>", "Answer:", "réponse -", "RÉPONSE:", "_REASONING_END_0f__", "*", '"', "'", "!", "x"]
    )
    cases = []
    for _ in range(4000):
        style = rng.choice(["letters", "numbers", "text"])
        choices = rng.choice([FOUR, TWO, ["a b", "A  B", "c."]])
        cases.append((style, choices, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 5)))))
    rows = graded(spark, cases)
    wrong = [
        (case, row.ai_position, expected_position(*case))
        for case, row in zip(cases, rows)
        if row.ai_position != expected_position(*case)
    ]
    assert wrong == []
    assert len({row.ai_position for row in rows}) == 5


@pytest.mark.parametrize(
    "raw, nb, structured, expected",
    [
        ('{"answer": "B"}', 4, True, "B"),
        ('{"answer": " b "}', 4, True, "B"),
        ('{"answer": "C"}', 2, True, None),
        ('{"answer": 1}', 4, True, None),
        ('{"reply": "A"}', 4, True, None),
        ("B) Mars", 4, True, "B"),
        ("B", 4, False, "B"),
        ("(B)", 4, False, "B"),
        ("B: Mars", 4, False, "B"),
        ("Because", 4, False, None),
        ("The answer is B", 4, False, "B"),
        ("I say Answer: (c)", 4, False, "C"),
        ("answer is D", 2, False, None),
        ("", 4, False, None),
        (None, 4, False, None),
    ],
)
def test_lenient_letter(spark, raw, nb, structured, expected):
    df = spark.createDataFrame([(raw, nb, structured)], "raw string, nb int, s boolean")
    assert df.select(lenient_letter(F.col("raw"), F.col("nb"), F.col("s"))).first()[0] == expected
