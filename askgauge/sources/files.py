"""Reading and writing the files of the pipeline."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from askgauge.operators.prompting import select_runs
from askgauge.schemas import (
    API_PAGE,
    CLEAN_QUESTIONS,
    PROMPT_SET,
    RAW_QUESTIONS,
    RESPONSES,
    RUN_CONFIG,
)
from askgauge.settings import DROP_SHUFFLES, settings

# Quoted fields may span lines and hold doubled quotes, as Python's csv module writes them.
CSV_FORMAT = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
ORDER_COLUMNS = ("_file", "_line")
# A quarter smaller than the default for response files, at about the same speed.
COMPRESSED = {"compression": "zstd"}
# No questions left, session expired, too many requests. Fixed values.
SKIPPED_CODES = (1, 4, 5)


# --- Sources ---


def read_raw_questions(spark: SparkSession, path: str) -> DataFrame:
    """Collected questions with the columns the files name, all text, blanks kept as empty strings.

    The contract decides whether those are the right columns, so none is imposed here. All files must
    name the same ones in the same order, and a row must have as many fields: anything else fails the
    read. ``_file`` and ``_line`` give the collection order. They are taken at the scan, before any
    shuffle, where row numbers within a file follow the file.
    """
    named = spark.read.options(**CSV_FORMAT, inferSchema="false").csv(path).schema
    strict = CSV_FORMAT | {"enforceSchema": "false", "mode": "FAILFAST"}
    raw = spark.read.schema(named).options(**strict).csv(path)
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in raw.columns]
    return raw.select(
        *texts, F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line")
    )


def read_named(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files whose columns are matched by the names in each file's own header.

    The files may order their columns differently. A file that names other columns than the schema, a
    row with more or fewer fields than that, and a value that is not of its column's type fail the read.
    Blank fields are null.
    """
    names = schema.fieldNames()
    places = [f"_{i}" for i in range(len(names))]
    # Pruned columns would not be counted, and a ragged row would pass.
    strict = CSV_FORMAT | {"header": "false", "mode": "FAILFAST", "columnPruning": "false"}
    cells = spark.read.schema(", ".join(f"{c} string" for c in places)).options(**strict).csv(path)
    lines = cells.select(
        F.array(*places).alias("_fields"),
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_line"),
    )
    first = lines.groupBy("_file").agg(F.min(F.struct("_line", "_fields")).alias("_first"))
    named = F.transform("_first._fields", lambda c: F.regexp_replace(F.trim(c), "^\ufeff", ""))
    wanted = F.array_sort(F.array(*map(F.lit, names)))
    said = F.concat(F.lit("unexpected columns in "), F.col("_file"), F.lit(": "), F.concat_ws(", ", named))
    checked = F.when(F.array_sort(named) == wanted, named).otherwise(F.raise_error(said))
    headers = first.select("_file", F.col("_first._line").alias("_header"), checked.alias("_names"))
    headers = headers.where(F.size("_names") == len(names))  # checked even where no column is asked for
    rows = lines.join(headers, "_file").where(F.col("_line") > F.col("_header"))
    return rows.select(
        *(
            F.element_at("_fields", F.array_position("_names", F.lit(f.name)).cast("int")).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def read_run_config(spark: SparkSession, path: str, run_orders=None) -> DataFrame:
    """Configured runs in order, optionally a selection of them; refuses an empty selection."""
    config = read_named(spark, path, RUN_CONFIG)
    texts = [f.name for f in RUN_CONFIG if f.dataType.simpleString() == "string"]
    return select_runs(config.na.fill("", texts), run_orders)


def read_prompt_set(spark: SparkSession, path: str) -> DataFrame:
    """Prompt versions whose line breaks are written ``\\n`` and whose flag is text."""
    prompts = read_named(spark, path, PROMPT_SET).na.fill("")

    def broken(name):
        return F.replace(F.col(name), F.lit("\\n"), F.lit("\n")).alias(name)

    return prompts.select(
        "prompt_version",
        broken("system_prompt"),
        broken("user_template"),
        (F.lower(F.trim("structured_output")) == "true").alias("structured"),
    )


def read_clean_questions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLEAN_QUESTIONS).parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """All response parts under a directory."""
    return spark.read.schema(RESPONSES).parquet(path)


def answered_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(run, question) pairs already answered: the scan reads two columns of the parts."""
    return read_responses(spark, path).select("run_id", "question_id")


def flatten_pages(pages: DataFrame, n_questions: int | None = None, order=ORDER_COLUMNS) -> DataFrame:
    """Questions of successful API pages (response code 0), optionally the first ones in collection order.

    Pages without questions left, of an expired session or of too many requests are passed over. Any
    other code, and a page that cannot be read, fails the query. ``order`` names the columns that
    tell the order of the pages when ``n_questions`` is given.
    """
    code = F.col("response_code")
    unexpected = F.concat(F.lit("unexpected response code: "), F.coalesce(code.cast("string"), F.lit("unreadable page")))
    results = F.when(code == 0, F.col("results")).when(~code.isin(*SKIPPED_CODES), F.raise_error(unexpected))
    results = F.when(code.isNull(), F.raise_error(unexpected)).otherwise(results)
    if n_questions is None:
        return pages.select(F.inline(results))
    kept = pages.select(*order, F.posexplode(results).alias("_place", "_question"))
    return kept.orderBy(*order, "_place").limit(n_questions).select("_question.*")


def parse_pages(captured: DataFrame, column: str) -> DataFrame:
    """API pages from a column of JSON text."""
    return captured.select(F.from_json(column, API_PAGE).alias("page")).select("page.*")


def read_api_pages(spark: SparkSession, path: str, n_questions: int | None = None) -> DataFrame:
    """Questions of the captured API pages (one JSON document per line) under a path."""
    pages = spark.read.schema(API_PAGE).json(path)
    ordered = pages.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    return flatten_pages(ordered, n_questions)


# --- Sinks ---


def write_raw_questions(questions: DataFrame, path: str) -> None:
    """Overwrite the raw question CSV, wrong answers as JSON text; refuses to write nothing.

    The questions are kept while they are counted and written, so both see the same ones.
    """
    kept = questions.persist()
    try:
        if kept.isEmpty():
            raise ValueError("no question collected: nothing is written")
        kept.withColumn("incorrect_answers", F.to_json("incorrect_answers")).select(
            *RAW_QUESTIONS.fieldNames()
        ).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
    finally:
        kept.unpersist()


def write_clean_questions(questions: DataFrame, path: str) -> None:
    questions.select(*CLEAN_QUESTIONS.fieldNames()).write.mode("overwrite").parquet(path)


def append_responses(responses: DataFrame, path: str, batch_size: int | None = None) -> None:
    """Append response parts with pinned column types, at most ``batch_size`` rows per file."""
    typed = responses.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RESPONSES))
    writer = typed.write.mode("append").options(**COMPRESSED)
    if batch_size is not None:
        writer = writer.option("maxRecordsPerFile", batch_size)
    with settings(responses.sparkSession, DROP_SHUFFLES):
        writer.parquet(path)
