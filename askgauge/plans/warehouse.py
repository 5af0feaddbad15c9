"""Building the silver and gold layers as tables.

Grades and their join to questions are written once, since eight tables read them. Everything above
is recomputed from that table, so a lost executor costs its tasks and nothing else.
"""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from askgauge.operators.cleaning import clean_questions
from askgauge.operators.enrich import answer_options, enrich_responses
from askgauge.operators.quality import (
    accepted_rows,
    check_clean_questions,
    check_raw_questions,
    check_written_apart,
    check_written_questions,
    clean_question_conditions,
    raw_column_checks,
    raw_question_conditions,
    read_apart,
    run_checks,
    unique_question_check,
    verify,
    write_apart,
)
from askgauge.operators.scoring import grade_responses
from askgauge.operators.staging import stage_questions, stage_responses
from askgauge.plans.marts import (
    FROM_COUNTS,
    MART_BUILDERS,
    count_responses,
    leaderboard_of,
    question_insights_of,
    run_buckets,
    run_times,
)
from askgauge.schemas import CLEAN_QUESTIONS, ENRICHED_COLUMNS, GRADED_COLUMNS, MARTS
from askgauge.settings import DROP_SHUFFLES, NO_WIDE_SORTS, settings
from askgauge.sources.files import COMPRESSED, ORDER_COLUMNS, read_clean_questions, write_clean_questions

SILVER, GOLD = "silver", "gold"


class MartMissing(LookupError):
    """A gold table is not in the catalog; build it first."""


@dataclass(frozen=True)
class Buckets:
    """Rows of one key kept together in ``n`` buckets by the hash of ``keys``, sorted within each file.

    Joins and aggregates on the keys then need no shuffle of the table. ``n`` should be no less than the
    session's shuffle partitions: with fewer, Spark shuffles again to use more tasks.
    """

    n: int
    keys: tuple[str, ...] = ("question_id",)


MOST_UNEVEN = 4.0


def evenly(rows: DataFrame, buckets: Buckets, most: float = MOST_UNEVEN) -> bool:
    """Whether no bucket would hold over ``most`` times the mean of all.

    A bucket is read by one task, and what is not shuffled adaptive execution cannot split, so a table
    with a dominant key is better left without buckets. Reads the keys only; counts one row per bucket.
    """
    bucket = F.pmod(F.hash(*buckets.keys), F.lit(buckets.n))
    sizes = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    return total is None or largest * buckets.n <= most * total


def save(
    df: DataFrame, table: str, partition_by=(), buckets: Buckets | None = None, together: bool = True
) -> None:
    """Write a table; rows of a partitioned or bucketed one are first brought together.

    Rebalancing splits a large partition over several tasks and keeps tasks from writing a small file
    into each. With buckets every task writes one bucket, a file per partition. Rows of few partitions
    need not come ``together``: every task then writes a file into each, and wide rows are not moved.
    Partition columns come last in the table: ``columns_of`` gives the documented order.
    """
    if buckets is not None:
        df = df.repartition(buckets.n, *buckets.keys)
    elif partition_by and together:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet").options(**COMPRESSED).partitionBy(*partition_by)
    if buckets is not None:
        writer = writer.bucketBy(buckets.n, *buckets.keys).sortBy(*buckets.keys)
    writer.saveAsTable(table)


def columns_of(table: DataFrame, columns) -> DataFrame:
    """A silver table with its columns in the documented order."""
    return table.select(*columns)


def build_questions(raw: DataFrame, path: str, spark: SparkSession) -> DataFrame:
    """Check, clean, check, write and check again; stops at the first contract that fails."""
    verify(check_raw_questions(raw.drop(*ORDER_COLUMNS)))
    clean = clean_questions(raw, ORDER_COLUMNS).persist()
    try:
        verify(check_clean_questions(clean))
        sent = Observation()
        write_clean_questions(clean.observe(sent, F.count("*").alias("n")), path)
    finally:
        clean.unpersist()
    written = read_clean_questions(spark, path)
    verify(check_written_questions(written, sent.get["n"]))
    return written


def build_accepted_questions(raw: DataFrame, path: str, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The accepted clean questions and the report; rows that break a contract are set aside, not the build.

    Every row is judged in the pass that writes it: collected ones under ``path/bronze``, cleaned ones
    under ``path/silver``, so the source is read once and nothing is held. Wrong columns and repeated
    question ids are faults of the whole table and still stop the build. Of a question that comes several
    times the first accepted copy stays.
    """
    columns = run_checks(spark.range(1), raw_column_checks(raw.drop(*ORDER_COLUMNS).columns), "bronze")
    verify(columns)
    collected, cleaned = f"{path}/bronze", f"{path}/silver"
    write_apart(raw, raw_question_conditions(), collected)
    bronze = read_apart(spark, collected, raw.schema)
    clean = clean_questions(accepted_rows(bronze), ORDER_COLUMNS).select(*CLEAN_QUESTIONS.fieldNames())
    write_apart(clean, clean_question_conditions(), cleaned)
    silver = read_apart(spark, cleaned, CLEAN_QUESTIONS)
    verify(run_checks(accepted_rows(silver), unique_question_check(), "silver"))
    report = columns.unionByName(check_written_apart(bronze, raw_question_conditions(), "bronze"))
    whole = check_written_apart(silver, clean_question_conditions(), "silver", unique_question_check())
    return accepted_rows(silver), report.unionByName(whole)


def build_answered_pairs(spark: SparkSession, answered: DataFrame, silver: str, buckets: int) -> str:
    """The (run, question) pairs answered, each once, bucketed by both; returns the table's name.

    Only those two columns of ``answered`` are read. As every pair is there once, no key can fill a bucket.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {silver}")
    pairs, table = Buckets(buckets, ("run_id", "question_id")), f"{silver}.int_answered_pairs"
    save(answered.select(*pairs.keys).distinct(), table, buckets=pairs)
    return table


def build_silver(
    spark: SparkSession,
    questions: DataFrame,
    responses: DataFrame | None,
    silver: str = SILVER,
    partition_by=("label_style", "temperature"),
    graded: DataFrame | None = None,
    buckets: int | None = None,
) -> list[str]:
    """Stage, grade and join; returns the tables written, the joined one last.

    With ``buckets``, questions, grades and joined responses are bucketed by question, and the pairs
    answered by (run, question), each pair once: joining grades to questions, counting per question and
    ``remaining_work`` then shuffle no responses. A table whose rows would fill its buckets unevenly is
    written without them.

    Grades and joined responses are written by the tasks that made them. Rows of a question that come in
    together stay so, which makes files smaller and what is counted per question less before it moves.
    """
    with settings(spark, DROP_SHUFFLES, NO_WIDE_SORTS):
        return _build_silver(spark, questions, responses, silver, partition_by, graded, buckets)


def _build_silver(spark, questions, responses, silver, partition_by, graded, buckets) -> list[str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {silver}")
    stage_questions(questions).createOrReplaceTempView("stg_questions")
    staged = spark.table("stg_questions")
    if graded is None:
        stage_responses(responses).createOrReplaceTempView("stg_ai_responses")
        graded = grade_responses(spark.table("stg_ai_responses"))
    scored, enriched, written = f"{silver}.int_ai_responses_scored", f"{silver}.int_responses_enriched", []
    by_question = None
    if buckets is not None:
        wanted = Buckets(buckets)
        by_question = wanted if evenly(graded, wanted) else None
    if by_question is not None:
        save(staged, f"{silver}.int_questions", buckets=by_question)
        staged = spark.table(f"{silver}.int_questions")
        written.append(f"{silver}.int_questions")
    save(columns_of(graded, GRADED_COLUMNS), scored, partition_by, by_question, together=False)
    if buckets is not None:
        # From the table just written: the responses are not graded again for two columns.
        written.insert(0, build_answered_pairs(spark, spark.table(scored), silver, buckets))
    joined = enrich_responses(columns_of(spark.table(scored), GRADED_COLUMNS), staged)
    save(joined, enriched, partition_by, by_question, together=False)
    return [*written, scored, enriched]


def build(
    spark: SparkSession,
    questions: DataFrame,
    responses: DataFrame | None,
    silver: str = SILVER,
    gold: str = GOLD,
    partition_by=("label_style", "temperature"),
    parallel: int = 4,
    graded: DataFrame | None = None,
    buckets: int | None = None,
) -> list[str]:
    """Stage, grade, join and aggregate; returns the tables written.

    ``graded`` are responses graded before, such as the output of the stream; ``responses`` may then
    be None. Staging is two temporary views. The silver tables are partitioned by label style and
    temperature, the two columns the tables above filter on, and on demand bucketed, see
    ``build_silver``. The tables above do not depend on each other, so ``parallel`` of them are
    submitted at a time and the cluster fills the tail of one with the start of the next.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {gold}")
    written = build_silver(spark, questions, responses, silver, partition_by, graded, buckets)
    staged, (scored, enriched) = spark.table("stg_questions"), written[-2:]

    with settings(spark, DROP_SHUFFLES):
        source = columns_of(spark.table(enriched), ENRICHED_COLUMNS)
        # Five of the tables need counts only: the responses are reduced once for all of them.
        counted = f"{silver}.int_response_counts"
        save(count_responses(source), counted)
        counts = spark.table(counted)
        # The leaderboard needs distinct times: stored by range, so that those around the quantile alone are read again.
        timed = f"{silver}.int_run_times"
        save(run_times(source), timed, ("bucket_range",))
        times = spark.table(timed)
        above = {f"{silver}.int_answer_options": lambda: answer_options(staged)}
        above |= {
            f"{gold}.{name}": partial(make, counts if name in FROM_COUNTS else source)
            for name, make in MART_BUILDERS.items()
        }
        above[f"{gold}.mart_leaderboard"] = lambda: leaderboard_of(run_buckets(times), times)
        # Counted from the grades, without the texts of the questions, which are joined to one row each.
        above[f"{gold}.mart_question_insights"] = lambda: question_insights_of(spark.table(scored), staged)
        with ThreadPoolExecutor(parallel) as pool:
            list(pool.map(lambda item: save(item[1](), item[0]), above.items()))
    return [*written, counted, timed, *above]


def available_marts(spark: SparkSession, gold: str = GOLD) -> set[str]:
    """Names of the tables in the gold layer."""
    if not spark.catalog.databaseExists(gold):
        return set()
    return {t.name for t in spark.catalog.listTables(gold) if not t.isTemporary}


def load_mart(spark: SparkSession, name: str, gold: str = GOLD) -> DataFrame:
    """A gold table by name: only known tables, and only when it has been built."""
    if name not in MARTS:
        raise ValueError(f"unknown table: {name}")
    if not spark.catalog.tableExists(f"{gold}.{name}"):
        raise MartMissing(f"{gold}.{name} has not been built")
    return spark.table(f"{gold}.{name}")
