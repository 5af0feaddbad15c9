"""From collected questions to the clean question table."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from askgauge.functions.labels import label_or_code, lookup
from askgauge.functions.text import clean_text, clean_text_list, json_list
from askgauge.schemas import (
    CATEGORY_GROUP_RENAMES,
    CATEGORY_NAME_RENAMES,
    CLEAN_QUESTIONS,
    DIFFICULTY_LEVELS,
)


def question_hash(question: Column, answer: Column) -> Column:
    """MD5 of the lower-cased question and answer."""
    return F.md5(F.concat(F.lower(question), F.lit("||"), F.lower(answer)))


def question_key(question: Column, answer: Column) -> Column:
    """Stable identifier: the first 12 hex digits of the hash."""
    return F.substring(question_hash(question, answer), 1, 12)


def split_category(category: Column) -> tuple[Column, Column]:
    """Group (before the first colon) and name (after the last colon) of a category."""
    parts = F.split(category, ":")
    group, name = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.size(parts) - 1))
    return label_or_code(group, CATEGORY_GROUP_RENAMES), label_or_code(name, CATEGORY_NAME_RENAMES)


def derive_attributes(questions: DataFrame) -> DataFrame:
    """Add category parts, difficulty level, option count and identifier to cleaned texts."""
    group, name = split_category(F.col("category"))
    return questions.withColumns(
        {
            "category_group": group,
            "category_name": name,
            "difficulty_level": lookup(F.col("difficulty"), DIFFICULTY_LEVELS).cast("tinyint"),
            "nb_options": (F.size("incorrect_answers") + 1).cast("tinyint"),
            "question_id": question_key(F.col("question"), F.col("correct_answer")),
        }
    )


def clean_texts(raw: DataFrame) -> DataFrame:
    """Decode and tidy every text, and parse the JSON list of wrong answers."""
    return raw.withColumns(
        {
            "category": clean_text(F.col("category")),
            "question": clean_text(F.col("question")),
            "correct_answer": clean_text(F.col("correct_answer")),
            "incorrect_answers": clean_text_list(json_list(F.col("incorrect_answers"))),
        }
    )


def keep_first(df: DataFrame, key: str, order) -> DataFrame:
    """Keep the first row of every key in the given order.

    The rank filter is pushed below the shuffle by Spark, so each task sends at most one row per key
    and a key copied millions of times does not pile up in one task.
    """
    order = [order] if isinstance(order, str) else list(order)
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", first).where(F.col("_place") == 1).drop("_place")


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once.

    Keys are counted with map-side combining and the repeated ones semi-joined back: no window has
    to hold the rows of a heavily repeated key, and adaptive execution can split it in the join.
    """
    repeated = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select(key)
    return df.join(repeated, key, "left_semi")


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: rows in, distinct keys, repeated keys, rows removed by keeping the first."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.sum("n").alias("n_rows"),
            F.count("*").alias("n_kept"),
            F.count_if(F.col("n") > 1).alias("n_duplicated_keys"),
            (F.sum("n") - F.count("*")).alias("n_removed"),
        )
    )


def clean_questions(raw: DataFrame, order) -> DataFrame:
    """The clean question table; ``order`` names the column(s) giving the collection order.

    Repeated questions are told by the whole hash of their texts. Two different questions that share
    the published 12 digits both stay, and fail the contract on unique identifiers.
    """
    identified = derive_attributes(clean_texts(raw))
    whole = identified.withColumn("_hash", question_hash(F.col("question"), F.col("correct_answer")))
    return keep_first(whole, "_hash", order).select(*CLEAN_QUESTIONS.fieldNames())
