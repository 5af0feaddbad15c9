"""Preparing what is asked: samples, work lists, options and prompts."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from askgauge.functions.metrics import ratio, round_to
from askgauge.schemas import (
    BOOLEAN_CHOICES,
    LABEL_STYLES,
    NO_THINKING_SUFFIX,
    OPTION_LABELS,
    RUN_COMPLETE,
    RUN_DONE_BEFORE,
    RUN_INCOMPLETE,
    RUN_MODEL_MISSING,
    TRIAL_ERRORS,
    TRIAL_OK,
    TRIAL_SILENT,
)


# --- Samples and work lists ---


def sample_key(seed: Column, question_id: Column) -> Column:
    """Sort key of a question under a seed: reproducible and independent of file layout."""
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), question_id))


def seeded_permutation(questions: DataFrame, seeds, n: int | None = None, digits: int = 3) -> DataFrame:
    """Questions in a seeded order, numbered from 1 in ``sample_rank``, once per seed.

    ``questions`` holds one row per ``question_id``. A global row number would sort everything in one
    task. The hash is split instead into 16**digits ranges of equal expected size; each range is
    numbered on its own and shifted by the number of questions in the ranges before it, a table of at
    most 16**digits rows per seed. ``seeds`` is a list, or a DataFrame with a column ``sample_seed``,
    whose distinct values are read when the plan runs. ``n`` keeps the head of the permutation.
    """
    if isinstance(seeds, DataFrame):
        given = seeds.agg(F.sort_array(F.collect_set("sample_seed"))).scalar()
    else:
        given = F.array(*map(F.lit, sorted(set(seeds))))
    keyed = (
        questions.withColumn("sample_seed", F.explode(given))
        .withColumn("_hash", sample_key(F.col("sample_seed"), F.col("question_id")))
        .withColumn("_range", F.substring("_hash", 1, digits))
    )
    before = Window.partitionBy("sample_seed").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        keyed.groupBy("sample_seed", "_range")
        .agg(F.count("*").alias("_size"))
        .select("sample_seed", "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    )
    if n is not None:
        shifts = shifts.where(F.col("_shift") < n)
    in_range = Window.partitionBy("sample_seed", "_range").orderBy("_hash", "question_id")
    ranked = (
        keyed.join(shifts, ["sample_seed", "_range"])
        .withColumn("sample_rank", (F.col("_shift") + F.row_number().over(in_range)).cast("int"))
        .drop("_hash", "_range", "_shift")
    )
    return ranked if n is None else ranked.where(F.col("sample_rank") <= n)


def first_by_id(questions: DataFrame, n: int) -> DataFrame:
    """The n questions with the smallest identifiers: identifiers are hashes, so this is a sample."""
    return questions.orderBy("question_id").limit(n)


def select_runs(config: DataFrame, run_orders=None) -> DataFrame:
    """Runs to execute, in order; refuses an empty selection."""
    chosen = config if run_orders is None else config.where(F.col("run_order").isin(*run_orders))
    if chosen.isEmpty():
        raise ValueError(f"no run matches run_orders={run_orders}")
    return chosen.orderBy("run_order")


def work_list(runs: DataFrame, questions: DataFrame, n: int | None = None) -> DataFrame:
    """Every (run, question) to ask: each run takes the head of the permutation of its own seed.

    The seeds are those of the runs, whatever they are. Runs and questions meet on the seed; Spark
    broadcasts the runs when they turn out small, and splits a seed that holds most questions otherwise.
    """
    return seeded_permutation(questions, runs, n).join(runs, "sample_seed")


def remaining_work(work: DataFrame, answered: DataFrame, keys=("run_id", "question_id")) -> DataFrame:
    """Work not answered yet. Answers are reduced to their distinct keys before they are shuffled."""
    return work.join(answered.select(*keys).distinct(), list(keys), "left_anti")


# --- Options and prompts ---


def build_choices(question_id: Column, question_type: Column, correct: Column, wrong: Column) -> Column:
    """Options in the order shown: fixed for booleans, otherwise shuffled by the question identifier.

    The order depends on nothing but the question, so every model and prompt sees the same one.
    """
    keyed = F.transform(
        F.concat(F.array(correct), wrong),
        lambda option: F.struct(
            F.md5(F.concat(question_id, F.lit("|"), option)).alias("key"), option.alias("option")
        ),
    )
    shuffled = F.transform(F.array_sort(keyed), lambda pair: pair["option"])
    return F.when(question_type == "boolean", F.array(*map(F.lit, BOOLEAN_CHOICES))).otherwise(shuffled)


def _labels(style: Column) -> Column:
    branches = None
    for name, labels in OPTION_LABELS.items():
        branches = (F.when if branches is None else branches.when)(style == name, F.array(*map(F.lit, labels)))
    return branches


def render_options(choices: Column, style: Column, mark: str = ". ") -> Column:
    """One option per line, labelled by letter or number, or as a dashed list for text answers."""
    labels = _labels(style)
    labelled = F.transform(choices, lambda option, i: F.concat(F.get(labels, i), F.lit(mark), option))
    dashed = F.transform(choices, lambda option: F.concat(F.lit("- "), option))
    return F.array_join(F.when(style == "text", dashed).otherwise(labelled), "\n")


def option_listings(choices: Column) -> Column:
    """``render_options`` for every style, by its name."""
    return F.create_map(*(c for s in LABEL_STYLES for c in (F.lit(s), render_options(choices, F.lit(s)))))


def correct_label(choices: Column, correct: Column, style: Column) -> Column:
    """Label of the correct option: a letter, a digit, or its text. NULL when it is not an option."""
    place = F.nullif(F.array_position(choices, correct), F.lit(0).cast("bigint")).cast("int")
    return F.get(F.when(style == "text", choices).otherwise(_labels(style)), place - 1)


def fill_template(template: Column, question: Column, options: Column) -> Column:
    """Fill ``{question}`` and ``{options}``; braces inside the texts themselves are left alone."""
    pieces = F.split(template, r"\{options\}", -1)
    filled = F.transform(pieces, lambda piece: F.replace(piece, F.lit("{question}"), question))
    return F.call_function("array_join", filled, options)


def final_system_prompt(system_prompt: Column, disable_thinking: Column) -> Column:
    off = F.lower(disable_thinking.cast("string")) == "true"
    return F.concat(system_prompt, F.when(off, NO_THINKING_SUFFIX).otherwise(""))


def prompt_text(system_prompt: Column, user_prompt: Column) -> Column:
    """What is sent, as one text: a blank system prompt is left out of the conversation."""
    parts = F.array(F.when(F.trim(system_prompt) != "", system_prompt), user_prompt)
    return F.array_join(parts, "\n\n")


def render_prompts(work: DataFrame) -> DataFrame:
    """Add ``choices``, ``correct_label`` and the final prompts to a work list.

    A work list that carries ``choices``, or ``listings`` of them, keeps them: a question asked many times is
    best given its options before it is joined to its runs.
    """
    style = F.col("label_style")
    if "choices" not in work.columns:
        choices = build_choices(F.col("question_id"), F.col("type"), F.col("correct_answer"), F.col("incorrect_answers"))
        work = work.withColumn("choices", choices)
    options = render_options(F.col("choices"), style)
    if "listings" in work.columns:
        options = F.when(style.isin(*LABEL_STYLES), F.try_element_at("listings", style)).otherwise(options)
    return work.withColumns(
        {
            "correct_label": correct_label(F.col("choices"), F.col("correct_answer"), style),
            "system_prompt": final_system_prompt(F.col("system_prompt"), F.col("disable_thinking")),
            "user_prompt": fill_template(F.col("user_template"), F.col("question"), options),
        }
    )


# --- Run follow-up ---


def runs_per_model(config: DataFrame) -> DataFrame:
    return config.groupBy("lmstudio_id").agg(F.count("*").alias("n_runs"))


def one_run_per_model(config: DataFrame, prompt_version: str | None = None) -> DataFrame:
    """First configured run of each model, within one prompt version when given."""
    chosen = config if prompt_version is None else config.where(F.col("prompt_version") == prompt_version)
    first = F.row_number().over(Window.partitionBy("lmstudio_id").orderBy("run_order"))
    return chosen.withColumn("_place", first).where(F.col("_place") == 1).drop("_place")


def run_summary(runs: DataFrame, todo: DataFrame, graded: DataFrame, missing_models=()) -> DataFrame:
    """Outcome of each run: status, new answers, provisional scores and minutes spent.

    ``todo`` is the remaining work the runs started from, ``graded`` what they answered. A run that had
    nothing to do, or whose model is missing, was not asked: it has no new answers and no scores.
    """
    planned = todo.groupBy("run_id").agg(F.count("*").alias("n_todo"))
    seconds = F.unix_timestamp(F.max("created_at").cast("timestamp")) - F.unix_timestamp(
        F.min("created_at").cast("timestamp")
    )
    obtained = graded.groupBy("run_id").agg(
        F.count("*").alias("n_got"),
        F.count_if("ai_correct").alias("n_right"),
        F.count_if("is_valid_format").alias("n_valid"),
        seconds.alias("seconds"),
    )
    todo_n, got = F.coalesce("n_todo", F.lit(0)), F.coalesce("n_got", F.lit(0))
    missing = F.col("lmstudio_id").isin(*missing_models) if missing_models else F.lit(False)
    status = (
        F.when(todo_n == 0, RUN_DONE_BEFORE)
        .when(missing, RUN_MODEL_MISSING)
        .when(got == todo_n, RUN_COMPLETE)
        .otherwise(RUN_INCOMPLETE)
    )
    asked = ~F.col("status").isin(RUN_DONE_BEFORE, RUN_MODEL_MISSING)
    return (
        runs.select("run_id", "lmstudio_id")
        .join(planned, "run_id", "left")
        .join(obtained, "run_id", "left")
        .withColumn("status", status)
        .select(
            "run_id",
            "status",
            F.when(asked, got).otherwise(0).cast("bigint").alias("n_new"),
            F.when(asked, round_to(ratio(F.col("n_right"), F.col("n_got")), 4)).alias("provisional_accuracy"),
            F.when(asked, round_to(ratio(F.col("n_valid"), F.col("n_got")), 4)).alias("valid_format_rate"),
            F.when(asked, round_to(ratio(F.col("seconds"), F.lit(60.0)), 1)).alias("duration_min"),
        )
    )


def trial_outcome(n_answers: Column, n_errors: Column) -> Column:
    """OK, with errors, or without any answer."""
    return F.when(n_answers == 0, TRIAL_SILENT).when(n_errors == 0, TRIAL_OK).otherwise(TRIAL_ERRORS)


def trial_summary(graded: DataFrame, todo: DataFrame) -> DataFrame:
    """Outcome of trial runs: answers, errors, readable and right answers, and whether all were given.

    ``graded`` has an ``error`` per row, null for an answer; ``todo`` (run_id, n_todo) what was asked. A
    row with an error is neither readable nor right, whatever its text. A run without any row is silent.
    """
    answered = F.col("error").isNull()
    counted = graded.groupBy("run_id").agg(
        F.count_if(answered).alias("n_answers"),
        F.count_if(~answered).alias("n_errors"),
        F.count_if(answered & F.col("is_valid_format")).alias("n_valid"),
        F.count_if(answered & F.col("ai_correct")).alias("n_right"),
    )
    names = ("n_answers", "n_errors", "n_valid", "n_right")
    known = todo.join(counted, "run_id", "left").na.fill(0, list(names))
    done = F.col("n_answers") + F.col("n_errors") >= F.col("n_todo")
    return known.select(
        "run_id",
        F.when(done, RUN_COMPLETE).otherwise(RUN_INCOMPLETE).alias("status"),
        *names,
        trial_outcome(F.col("n_answers"), F.col("n_errors")).alias("outcome"),
    )


def projected_minutes(responses: DataFrame, config: DataFrame, n_questions: int) -> DataFrame:
    """Minutes a model would need for all its runs, from its mean time per question."""
    pace = responses.groupBy("lmstudio_id").agg(F.avg("response_time_s").alias("seconds"))
    minutes = F.col("seconds") * F.lit(float(n_questions)) * F.col("n_runs") / F.lit(60.0)
    return runs_per_model(config).join(pace, "lmstudio_id").select(
        "lmstudio_id",
        "n_runs",
        round_to(F.col("seconds"), 2).alias("seconds_per_question"),
        round_to(minutes, 1).alias("projected_min"),
    )


def invalid_examples(graded: DataFrame, n: int = 5) -> DataFrame:
    """A few unreadable answers, in a fixed order, to show what a model does wrong.

    The unreadable ones are sorted to the front and the rest dropped behind the limit. A filter on the grade
    in front of it would be moved below the grading, with every step of it written out in the condition.
    """
    readable = F.coalesce("is_valid_format", F.lit(True)).alias("readable")
    return (
        graded.select("run_id", "question_id", "raw_response", readable)
        .orderBy("readable", "run_id", "question_id")
        .limit(n)
        .where(~F.col("readable"))
        .drop("readable")
    )
