"""Blocking data contracts.

A contract is a set of named checks on one stage of the data. All checks of a stage are computed in
one aggregation that returns violation counts, so a contract costs one scan however many checks it
holds. A check that evaluates to NULL counts as violated.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from askgauge.functions.labels import lookup
from askgauge.functions.text import HTML_ENTITY, has_outer_space, json_list
from askgauge.schemas import (
    BOOLEAN_CHOICES,
    CLEAN_QUESTIONS,
    DIFFICULTY_LEVELS,
    QUESTION_TYPES,
    RAW_QUESTIONS,
    WRONG_ANSWERS_BY_TYPE,
)

TEXT_COLUMNS = ("category", "question", "correct_answer")
FAILED, REFUSED = "failed_checks", "refused"


class ContractError(ValueError):
    """At least one check of a contract found violations."""


def violations(ok: Column) -> Column:
    """Number of rows for which a condition does not hold."""
    return F.count_if(~F.coalesce(ok, F.lit(False)))


def metadata_check(ok: bool) -> Column:
    """A check on the table itself rather than on its rows: one violation when it fails."""
    return F.max(F.lit(0 if ok else 1)).cast("bigint")


def run_checks(df: DataFrame, checks: dict[str, Column], stage: str) -> DataFrame:
    """Report ``(stage, check, n_violations, ok)``, one row per check.

    ``checks`` maps a name to an aggregate counting violations.
    """
    counts = df.agg(*(F.coalesce(count, F.lit(0)).cast("bigint").alias(name) for name, count in checks.items()))
    rows = F.array(
        *(F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("n_violations")) for name in checks)
    )
    return counts.select(F.lit(stage).alias("stage"), F.inline(rows)).withColumn("ok", F.col("n_violations") == 0)


def verify(report: DataFrame) -> DataFrame:
    """Raise ``ContractError`` naming every failed check; return the report when all pass."""
    failed = [row for row in report.collect() if not row["ok"]]
    if failed:
        names = ", ".join(f"{row['check']} ({row['n_violations']})" for row in failed)
        raise ContractError(f"{failed[0]['stage']}: {len(failed)} check(s) failed: {names}")
    return report


def raw_question_conditions() -> dict[str, Column]:
    """What each collected question has to meet, before cleaning."""
    wrong = json_list(F.col("incorrect_answers"))
    kind = F.col("type")

    def wrong_count(question_type):
        return (kind != question_type) | (F.size(wrong) == WRONG_ANSWERS_BY_TYPE[question_type])

    return {
        "no_blank_value": ~reduce(or_, (F.col(c) == "" for c in RAW_QUESTIONS.fieldNames())),
        "known_type": kind.isin(*QUESTION_TYPES),
        "known_difficulty": F.col("difficulty").isin(*DIFFICULTY_LEVELS),
        "wrong_answers_are_a_list": wrong.isNotNull(),
        "multiple_has_three_wrong": wrong_count("multiple"),
        "boolean_has_one_wrong": wrong_count("boolean"),
        "boolean_answer_is_true_or_false": (kind != "boolean") | F.col("correct_answer").isin(*BOOLEAN_CHOICES),
    }


def raw_column_checks(columns) -> dict[str, Column]:
    """Whether a table has the columns of the collected questions."""
    return {"expected_columns": metadata_check(list(columns) == RAW_QUESTIONS.fieldNames())}


def raw_question_checks(columns) -> dict[str, Column]:
    """Contract of the collected questions, before cleaning.

    When a column is missing, that is the only thing reported: the rows cannot be judged without it.
    """
    right_columns = raw_column_checks(columns)
    if not set(RAW_QUESTIONS.fieldNames()) <= set(columns):
        return right_columns
    return right_columns | {name: violations(ok) for name, ok in raw_question_conditions().items()}


def clean_question_conditions() -> dict[str, Column]:
    """What each cleaned question has to meet, before it is written."""
    wrong = F.col("incorrect_answers")
    options = F.concat(wrong, F.array("correct_answer"))
    folded = F.array_distinct(F.transform(options, F.lower))
    expected_options = lookup(F.col("type"), {t: n + 1 for t, n in WRONG_ANSWERS_BY_TYPE.items()})

    def nowhere(test):
        """The test holds for no text column and no wrong answer."""
        return ~reduce(or_, (test(F.col(c)) for c in TEXT_COLUMNS), F.exists(wrong, test))

    return {
        "no_html_entity": nowhere(lambda t: t.rlike(HTML_ENTITY)),
        "no_outer_space": nowhere(has_outer_space),
        "no_empty_text": nowhere(lambda t: t == ""),
        "answer_not_among_wrong": ~F.array_contains(wrong, F.col("correct_answer")),
        "no_duplicate_option": F.size(folded) == F.size(options),
        "option_count_matches_type": F.col("nb_options") == expected_options,
    }


def unique_question_check() -> dict[str, Column]:
    """Rows beyond the first of each question id."""
    return {"question_id_unique": F.count("*") - F.count_distinct("question_id")}


def clean_question_checks() -> dict[str, Column]:
    """Contract of the cleaned questions, before they are written."""
    return unique_question_check() | {name: violations(ok) for name, ok in clean_question_conditions().items()}


def read_back_checks(written: DataFrame, expected_rows: int) -> dict[str, Column]:
    """Contract of the silver question file once it has been written and read again."""
    return {
        "row_count": F.when(F.count("*") == expected_rows, 0).otherwise(1),
        "columns_kept": metadata_check(written.columns == CLEAN_QUESTIONS.fieldNames()),
        "wrong_answers_are_lists": violations(F.size("incorrect_answers") == F.col("nb_options") - 1),
    }


def check_raw_questions(raw: DataFrame) -> DataFrame:
    return run_checks(raw, raw_question_checks(raw.columns), "bronze")


def check_clean_questions(clean: DataFrame) -> DataFrame:
    return run_checks(clean, clean_question_checks(), "silver")


def check_written_questions(written: DataFrame, expected_rows: int) -> DataFrame:
    return run_checks(written, read_back_checks(written, expected_rows), "silver file")


# --- Contracts judged while a table is written ---


def failed_checks(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that a row does not meet, in the order given."""
    names = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in conditions.items()))
    return F.filter(names, lambda name: name.isNotNull())


def write_apart(df: DataFrame, conditions: dict[str, Column], path: str) -> None:
    """Judge every row in the pass that writes it; refused rows go to a partition of their own.

    All rows are written, with the names of the checks they fail, so nothing is lost and nothing has to
    be held or read again to be judged. The table replaces what was at ``path``.
    """
    judged = df.withColumn(FAILED, failed_checks(conditions))
    judged.withColumn(REFUSED, F.size(FAILED) > 0).write.mode("overwrite").partitionBy(REFUSED).parquet(path)


def read_apart(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table written apart, with ``failed_checks`` and ``refused``."""
    judged = T.StructType([*schema.fields, T.StructField(FAILED, T.ArrayType(T.StringType()))])
    return spark.read.schema(judged.add(REFUSED, "boolean")).parquet(path)


def accepted_rows(written: DataFrame) -> DataFrame:
    """Rows that met every condition; the refused partition is not read."""
    return written.where(~F.col(REFUSED)).drop(FAILED, REFUSED)


def refused_rows(written: DataFrame) -> DataFrame:
    """Rows set aside, with the checks they fail; the accepted partition is not read."""
    return written.where(REFUSED).drop(REFUSED)


def check_written_apart(
    written: DataFrame, conditions: dict[str, Column], stage: str, on_table: dict[str, Column] | None = None
) -> DataFrame:
    """The report of a table written apart, from the names stored in it.

    It reads the refused rows' names only, and counts what was written: a task that ran twice does not
    count twice. ``on_table`` are checks on the table as a whole, which read their columns of all rows.
    """
    counts = {name: F.count_if(F.array_contains(FAILED, name)) for name in conditions}
    if on_table:
        return run_checks(written, on_table | counts, stage)
    return run_checks(refused_rows(written), counts, stage)
