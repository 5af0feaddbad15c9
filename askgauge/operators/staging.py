"""Typed, renamed views of the two silver sources."""

from pyspark.sql import DataFrame, functions as F

QUESTION_RENAMES = {"type": "question_type", "question": "question_text"}
RESPONSE_RENAMES = {
    "publisher": "model_publisher",
    "country": "model_country",
    "params_b": "model_params_b",
    "response_time": "response_time_s",
    "time_to_first_token": "time_to_first_token_s",
}
RESPONSE_TYPES = {
    "run_order": "int",
    "params_b": "double",
    "temperature": "double",
    "max_tokens": "int",
    "sample_seed": "int",
    "sample_rank": "int",
    "response_time": "double",
    "time_to_first_token": "double",
    "prompt_tokens": "int",
    "completion_tokens": "int",
}
# Question attributes repeated in the response files. They are left behind so that the question
# table stays the only source for them.
REPEATED_IN_RESPONSES = ("type", "difficulty", "category_group", "category_name", "question")


def stage_questions(questions: DataFrame) -> DataFrame:
    """One row per clean question, with the names used downstream and byte-sized small integers."""
    small = {"difficulty_level", "nb_options"}
    return questions.select(
        *(
            (F.col(c).cast("tinyint") if c in small else F.col(c)).alias(QUESTION_RENAMES.get(c, c))
            for c in questions.columns
        )
    )


def stage_responses(responses: DataFrame) -> DataFrame:
    """One row per raw response: typed, renamed, creation time parsed as a zone-less timestamp."""

    def staged(name):
        if name == "created_at":
            return F.col(name).cast("timestamp_ntz").alias(name)
        column = F.col(name).cast(RESPONSE_TYPES[name]) if name in RESPONSE_TYPES else F.col(name)
        return column.alias(RESPONSE_RENAMES.get(name, name))

    return responses.select(*(staged(c) for c in responses.columns if c not in REPEATED_IN_RESPONSES))
