"""Joining grades to questions, and the long table of answer options."""

from pyspark.sql import DataFrame, functions as F

from askgauge.schemas import ENRICHED_COLUMNS

FROM_QUESTIONS = (
    "question_type",
    "difficulty",
    "difficulty_level",
    "category",
    "category_group",
    "category_name",
    "question_text",
    "nb_options",
)


def enrich_responses(graded: DataFrame, questions: DataFrame) -> DataFrame:
    """Graded responses with the attributes of their question and the guessing level.

    An inner equi-join with no hint: a small question table is broadcast from its file size, a large
    one is sort-merged, and adaptive execution splits the partition of an over-represented question.
    """
    attributes = questions.select("question_id", *FROM_QUESTIONS)
    joined = graded.join(attributes, "question_id", "inner")
    return joined.withColumn(
        "random_baseline", F.lit(1.0) / F.nullif(F.col("nb_options").cast("double"), F.lit(0.0))
    ).select(*ENRICHED_COLUMNS)


def answer_options(questions: DataFrame) -> DataFrame:
    """One row per answer option, flagged correct or not.

    The correct answer and the wrong ones are exploded from a single scan.
    """
    correct = F.array(F.struct(F.col("correct_answer").alias("option_text"), F.lit(True).alias("is_correct")))
    wrong = F.transform(
        F.coalesce(F.col("incorrect_answers"), F.array().cast("array<string>")),
        lambda t: F.struct(t.alias("option_text"), F.lit(False).alias("is_correct")),
    )
    return questions.select("question_id", F.inline(F.concat(correct, wrong)))
