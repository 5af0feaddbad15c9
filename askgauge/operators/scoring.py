"""Grading of raw model answers.

Everything here is row-wise, so the same function grades a batch table or a stream. Steps that are
read more than once sit in their own projection: Catalyst then evaluates each regular expression a
single time instead of copying it into every branch that needs it.

The first step works on the options as an array. Spark ends the generated function of the steps before
there and begins another behind it. In one, reading, joining and grading come to over 8,000 bytes of code,
which the JVM never compiles.
"""

from pyspark.sql import Column, DataFrame, functions as F

from askgauge.functions.text import (
    ANSWER_SPACE,
    PYTHON_SPACE,
    normalize_answer,
    strip_python_space,
    strip_whitespace,
)
from askgauge.schemas import GRADED_COLUMNS, OPTION_LABELS

# --- Fixed values: the patterns that define how an answer is read ---
REASONING_BLOCK = r"(?s)<think>.*?</think>"
REASONING_MARKER = r"(?s)\A.*_REASONING_END_[0-9a-f]+__"
ANSWER_PREFIX = rf"(?iu)\A[{ANSWER_SPACE}]*(answer|réponse)[{ANSWER_SPACE}]*[:\-][{ANSWER_SPACE}]*"
FIRST_TOKEN = rf"\A([^{ANSWER_SPACE}]+)"
OPTION_LABEL = r"\A\(?([A-Da-d1-4])[).:]?\z"
FIRST_LINE = r"\A([^\r\n]*)"
TRUNCATION_MARK = "%maxPredictedTokens%"
STATUS_CORRECT, STATUS_INCORRECT, STATUS_INVALID = "correct", "incorrect", "invalid_format"


def clean_response(raw: Column) -> Column:
    """The answer without reasoning, without an ``Answer:`` prefix, trimmed.

    The reasoning patterns run only on answers that hold one of their fixed parts. Both run then:
    removing a block may bring the halves of a marker together.
    """
    unreasoned = F.regexp_replace(F.regexp_replace(raw, REASONING_BLOCK, ""), REASONING_MARKER, "")
    reasoned = F.contains(raw, F.lit("<think>")) | F.contains(raw, F.lit("_REASONING_END_"))
    text = F.when(reasoned, unreasoned).otherwise(raw)
    return strip_whitespace(F.regexp_replace(text, ANSWER_PREFIX, ""))


def allowed_labels(label_style: Column, choices: Column) -> Column:
    """Labels on offer for a question: as many as it has options; NULL for answers given as text."""
    branches = None
    for style, labels in OPTION_LABELS.items():
        offered = F.slice(F.array(*map(F.lit, labels)), F.lit(1), F.size(choices))
        branches = (F.when if branches is None else branches.when)(label_style == style, offered)
    return branches


def position_of(items: Column, value: Column) -> Column:
    """1-based position of a value in an array, NULL when it is not there."""
    return F.nullif(F.array_position(items, value), F.lit(0).cast("bigint")).cast("int")


def item_at(items: Column, position: Column) -> Column:
    """Array element at a 1-based position, NULL when the position is NULL or out of range."""
    return F.get(items, position - 1)


def grade(responses: DataFrame) -> DataFrame:
    """Add the grading columns to staged responses, keeping every input column."""
    style, choices = F.col("label_style"), F.col("choices")
    cleaned = responses.withColumns(
        {
            "clean_response": clean_response(F.col("raw_response")),
            "correct_position": position_of(choices, F.col("correct_answer")),
            "_labels": allowed_labels(style, choices),
            "_texts": F.when(style == "text", F.transform(choices, normalize_answer)),
        }
    )

    # A labelled answer is split into its first token and the text after it.
    text = F.col("clean_response")
    token = F.regexp_extract(text, FIRST_TOKEN, 1)
    split = cleaned.withColumns(
        {
            "_slot": position_of(F.col("_labels"), F.upper(F.regexp_extract(token, OPTION_LABEL, 1))),
            "_rest": strip_whitespace(F.regexp_replace(text, FIRST_TOKEN, "")),
        }
    )

    slot, rest = F.col("_slot"), F.col("_rest")
    same_option = normalize_answer(rest) == normalize_answer(item_at(choices, slot))
    by_label = F.when(slot.isNotNull() & ((rest == "") | same_option), slot)
    by_text = position_of(F.col("_texts"), normalize_answer(F.regexp_extract(text, FIRST_LINE, 1)))
    located = split.withColumn(
        "ai_position",
        F.when(text == "", None)
        .when(style.isin(*OPTION_LABELS), by_label)
        .when(style == "text", by_text),
    )

    position = F.col("ai_position")
    answered = located.withColumns(
        {
            "ai_label": item_at(F.when(style == "text", choices).otherwise(F.col("_labels")), position),
            "ai_answer": item_at(choices, position),
            "is_valid_format": position.isNotNull(),
        }
    )
    right = F.coalesce(F.col("ai_answer") == F.col("correct_answer"), F.lit(False))
    return answered.withColumns(
        {
            "ai_correct": right,
            "answer_status": F.when(~F.col("is_valid_format"), STATUS_INVALID)
            .when(right, STATUS_CORRECT)
            .otherwise(STATUS_INCORRECT),
            "is_truncated": F.col("stop_reason").ilike(TRUNCATION_MARK),
        }
    ).drop("_labels", "_texts", "_slot", "_rest")


def grade_responses(staged: DataFrame) -> DataFrame:
    """Graded responses in the column order of the silver table."""
    return grade(staged).select(*GRADED_COLUMNS)


# --- Fixed values: patterns of the lenient letter reader ---
LEADING_LETTER = rf"(?U)\A\(?([A-D]){PYTHON_SPACE}*(?:[).:]|\z)"
ANNOUNCED_LETTER = rf"(?iU)answer{PYTHON_SPACE}*(?:is)?{PYTHON_SPACE}*:?{PYTHON_SPACE}*\(?([A-D])\b"


def lenient_letter(raw: Column, nb_choices: Column, structured: Column) -> Column:
    """Letter read from a chatty or JSON answer, NULL when none of the offered letters is found.

    A structured answer must be ``{"answer": "<letter>"}``; one that is not a JSON object is read
    like free text: a leading letter first, then a letter announced by the word "answer".
    """
    text = strip_python_space(F.coalesce(raw, F.lit("")))
    offered = F.slice(F.array(*map(F.lit, OPTION_LABELS["letters"])), F.lit(1), nb_choices)

    def if_offered(letter):
        return F.when(F.array_contains(offered, letter), letter)

    is_object = (
        text.startswith("{") & text.endswith("}") & F.get_json_object(text, "$").isNotNull()
    )
    from_json = if_offered(F.upper(F.trim(F.get_json_object(text, "$.answer"))))
    leading = if_offered(F.regexp_extract(text, LEADING_LETTER, 1))
    announced = if_offered(F.upper(F.regexp_extract(text, ANNOUNCED_LETTER, 1)))
    return F.when(structured & is_object, from_json).otherwise(F.coalesce(leading, announced))
