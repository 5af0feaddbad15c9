"""Evaluation data derived from general-purpose tables.

The library is exercised on tables that hold no quiz questions, so questions come from ``part`` and
answers from ``lineitem``: every part becomes a question, every line item a model's answer to the
question about its part. All expressions are row-wise or keyed, so the derived tables grow with the
source tables. ``oracles.py`` states the same derivation in SQL.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from askgauge.operators.cleaning import derive_attributes
from askgauge.operators.enrich import enrich_responses
from askgauge.operators.prompting import build_choices, option_listings, render_prompts
from askgauge.operators.scoring import grade_responses
from askgauge.operators.staging import stage_questions, stage_responses
from askgauge.schemas import API_QUESTION, CLEAN_QUESTIONS, RAW_QUESTIONS, RESPONSES, RUN_CONFIG

SAMPLE_SEED = 42
N_MODELS = 4
PROMPT_VERSIONS = ("v1_letters", "v2_numbers", "v3_text", "v4_letters_hot")
LABEL_STYLE_BY_PROMPT = ("letters", "numbers", "text", "letters")
MODEL_SIZES = (1.0, 1.2, 3.0, 8.0)
MODEL_COUNTRIES = ("US", "US", "CN", "FR")
USER_TEMPLATE = "Question: {question}\n{options}\nAnswer:"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index):
    return F.get(F.array(*map(F.lit, values)), index)


def _brand(shift):
    number = F.substring("p_brand", 7, 10).cast("int")
    return F.concat(F.lit("Brand#"), ((number + shift) % 25 + 1).cast("string"))


def question_rows(spark: SparkSession, sf_dir: str, question=None) -> DataFrame:
    """One question per part, before any derived attribute; ``seq`` is the collection order."""
    asked = F.concat(F.lit("Which brand makes "), "p_name", F.lit(" no. "), F.col("p_partkey").cast("string"), F.lit("?"))
    boolean = F.col("p_size") % 6 == 0
    even = F.col("p_partkey") % 2 == 0
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"),
        F.when(boolean, "boolean").otherwise("multiple").alias("type"),
        _pick(("easy", "medium", "hard"), (F.col("p_partkey") % 3).cast("int")).alias("difficulty"),
        F.when(F.col("p_size") < 25, F.concat(F.lit("Entertainment: "), "p_type"))
        .when(F.col("p_type") == "PROMO", "Science & Nature")
        .otherwise(F.col("p_type"))
        .alias("category"),
        (asked if question is None else question).alias("question"),
        F.when(boolean, F.when(even, "True").otherwise("False")).otherwise(F.col("p_brand")).alias("correct_answer"),
        F.when(boolean, F.array(F.when(even, "False").otherwise("True")))
        .otherwise(F.array(_brand(6), _brand(12), _brand(18)))
        .alias("incorrect_answers"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean questions in their file layout, plus ``seq``."""
    return derive_attributes(question_rows(spark, sf_dir)).select(*CLEAN_QUESTIONS.fieldNames(), "seq")


def run_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs whose answers ``lineitem`` holds: one per (supplier, line number) class."""
    model, prompt = F.col("m"), F.col("p")
    number = model.cast("string")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            (F.col("l_suppkey") % N_MODELS).cast("int").alias("m"),
            (F.col("l_linenumber") % len(PROMPT_VERSIONS)).cast("int").alias("p"),
        )
        .distinct()
        .withColumns(
            {
                "run_order": model * len(PROMPT_VERSIONS) + prompt + 1,
                "model_key": F.concat(F.lit("m"), number),
                "lmstudio_id": F.concat(F.lit("lab/model-"), number),
                "model_name": F.concat(F.lit("Model "), number),
                "publisher": F.concat(F.lit("Lab "), (model % 3).cast("string")),
                "country": _pick(MODEL_COUNTRIES, model),
                "params_b": _pick(MODEL_SIZES, model),
                "disable_thinking": F.when(model == 2, "true").otherwise("false"),
                "prompt_version": _pick(PROMPT_VERSIONS, prompt),
                "label_style": _pick(LABEL_STYLE_BY_PROMPT, prompt),
                "temperature": F.when(prompt == 3, 1.0).otherwise(0.0),
                "max_tokens": F.when(prompt == 2, 40).otherwise(5),
                "n_questions": F.lit(1000),
                # One seed per pair of models.
                "sample_seed": (F.floor(model / 2) + SAMPLE_SEED).cast("int"),
                "user_template": F.lit(USER_TEMPLATE),
            }
        )
        .withColumns(
            {
                "run_id": F.concat_ws("__", "model_key", "prompt_version"),
                "prompt_description": F.concat(F.lit("Answer by "), "label_style"),
                "system_prompt": F.concat(F.lit("Reply with "), "label_style", F.lit(" only.")),
            }
        )
        .select(*RUN_CONFIG.fieldNames())
    )


def prompt_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompts of the runs as their file holds them: line breaks written out, a flag as text."""
    return run_config(spark, sf_dir).select(
        "prompt_version",
        "system_prompt",
        F.replace("user_template", F.lit("\n"), F.lit("\\n")).alias("user_template"),
        F.when(F.col("prompt_version") == "v2_numbers", " True").otherwise("false").alias("structured_output"),
    ).distinct()


def _raw_answer():
    """Twelve ways a model may word its choice, driven by the quantity of the line item."""
    token, choice, line = F.col("token"), F.col("choice"), F.lit("\n")
    text_style = F.col("label_style") == "text"
    wordings = [
        token,
        F.concat(F.lit("("), token, F.lit(")")),
        F.concat(F.lower(token), F.lit(".")),
        F.concat(F.lit("Answer: "), token),
        F.concat(F.lit("<think>because"), line, F.lit("x</think>"), line, token),
        F.when(text_style, F.concat(token, line, F.lit("note"))).otherwise(F.concat(token, F.lit(". "), choice)),
        F.concat(token, F.lit(". Nothing")),
        F.concat(F.lit("The answer is "), token),
        F.lit(""),
        F.concat(F.lit("*"), F.upper(choice), F.lit("*.")),
        F.concat(F.lit("RÉPONSE - "), token),
        F.concat(F.lit("x_REASONING_END_0a__"), token, line),
    ]
    result = F.when(F.col("wording") == 0, wordings[0])
    for i, wording in enumerate(wordings[1:], start=1):
        result = result.when(F.col("wording") == i, wording)
    return result


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw responses in their file layout: one per line item.

    Line items of the same run and part are attempts at the same question. The first keeps the name of
    its run; the others are runs of their own, named after their number, so that run and question stay
    a key. A part has few attempts per run, so the window holds little whatever the table's size.

    The line items move once, by part: the window, the join to the questions and whatever counts per
    question find them together. Options are put in order and listed per question, before the join.
    """
    line_order = (
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
    )
    attempt = F.row_number().over(Window.partitionBy("l_partkey", "m", "p").orderBy(*line_order))
    lines = (
        table(spark, sf_dir, "lineitem")
        .select(
            *line_order,
            "l_partkey",
            (F.col("l_suppkey") % N_MODELS).cast("int").alias("m"),
            (F.col("l_linenumber") % len(PROMPT_VERSIONS)).cast("int").alias("p"),
        )
        .repartition("l_partkey")
        .withColumn("place", attempt)
        .withColumn("run_order", F.col("m") * len(PROMPT_VERSIONS) + F.col("p") + 1)
    )
    choices = build_choices(F.col("question_id"), F.col("type"), F.col("correct_answer"), F.col("incorrect_answers"))
    shown = questions(spark, sf_dir).withColumn("choices", choices).withColumn("listings", option_listings(F.col("choices")))
    asked = (
        lines.join(shown, F.col("l_partkey") == F.col("seq"))
        # At most 16 runs exist by construction (4 x 4 remainders), so this side is always small.
        .join(F.broadcast(run_config(spark, sf_dir)), "run_order")
    )
    prompted = render_prompts(asked)
    right = F.array_position("choices", F.col("correct_answer"))
    options = F.size("choices")
    sure, fooled = F.col("l_partkey") % 11 == 0, F.col("l_partkey") % 9 == 0
    knows = F.col("l_orderkey") % 10 < 3 + 2 * F.col("m")
    chosen = (
        F.when(sure | (~fooled & knows), right)
        .when(fooled, right % options + 1)
        .otherwise(1 + (F.col("l_orderkey") + F.col("l_linenumber")) % options)
    )
    quantity = F.col("l_quantity").cast("int")
    answered = (
        prompted.withColumn("pick", chosen.cast("int"))
        .withColumn("choice", F.get("choices", F.col("pick") - 1))
        .withColumns(
            {
                "token": F.when(F.col("label_style") == "letters", F.substr(F.lit("ABCD"), "pick", F.lit(1)))
                .when(F.col("label_style") == "numbers", F.col("pick").cast("string"))
                .otherwise(F.col("choice")),
                "wording": F.when(sure, 0).otherwise(quantity % 12),
            }
        )
    )
    seconds = (F.col("l_orderkey") % 997 + 3).cast("double") / F.lit(1000.0)
    return answered.withColumns(
        {
            "run_id": F.when(F.col("place") == 1, F.col("run_id")).otherwise(
                F.concat("run_id", F.lit("__a"), F.col("place").cast("string"))
            ),
            "sample_rank": F.col("seq").cast("int"),
            "raw_response": _raw_answer(),
            "response_time": seconds,
            "prompt_tokens": quantity + 40,
            "completion_tokens": quantity,
            "time_to_first_token": seconds / F.lit(4.0),
            "stop_reason": F.when(F.col("l_returnflag") == "A", "eosFound").when(
                F.col("l_returnflag") == "N", "maxPredictedTokensReached"
            ),
            "created_at": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"),
        }
    ).select(*RESPONSES.fieldNames())


def staged_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_questions(questions(spark, sf_dir).drop("seq"))


def staged_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_responses(responses(spark, sf_dir))


def graded_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_responses(staged_responses(spark, sf_dir))


def enriched_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_responses(graded_responses(spark, sf_dir), staged_questions(spark, sf_dir))


def trial_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded responses of the configured runs, some of which failed: every call of one run, others here and there."""
    graded = graded_responses(spark, sf_dir).where(F.size(F.split("run_id", "__")) == 2)
    failed = (F.col("completion_tokens") % 13 == 0) & (F.col("model_key") != "m1")
    return graded.withColumn("error", F.when(failed | (F.col("run_id") == "m3__v3_text"), "timeout"))


def trial_work(answers: DataFrame) -> DataFrame:
    """(run_id, n_todo): what the runs were asked; those of two models stopped before their last question."""
    n = F.count("*") + F.when(F.col("run_id").rlike("^m[02]"), 1).otherwise(0)
    return answers.groupBy("run_id").agg(n.alias("n_todo"))


# --- Inputs with something wrong in them ---

MID_PERIOD = "1995-01-01T00:00:00"


def _every(n, wrong, right):
    """Every n-th question gets the wrong value."""
    return F.when(F.col("seq") % n == 0, wrong).otherwise(right)


def faulty_raw_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw questions that break the bronze contract here and there."""
    wrong = F.col("incorrect_answers")
    return (
        question_rows(spark, sf_dir)
        .withColumns(
            {
                "correct_answer": F.when(
                    (F.col("type") == "boolean") & (F.col("seq") % 127 == 0), "Maybe"
                ).otherwise(F.col("correct_answer")),
                "type": _every(101, F.lit("open"), F.col("type")),
                "difficulty": _every(103, F.lit("extreme"), F.col("difficulty")),
                "category": _every(107, F.lit(""), F.col("category")),
                "incorrect_answers": F.when(F.col("seq") % 109 == 0, "not json").otherwise(
                    F.to_json(_every(113, F.slice(wrong, 1, 2), wrong))
                ),
            }
        )
        .select(*RAW_QUESTIONS.fieldNames())
    )


def faulty_clean_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean questions that break the silver contract here and there."""
    wrong, text = F.col("incorrect_answers"), F.col("question")
    spoiled = F.when(F.col("seq") % 137 == 0, F.concat(text, F.lit(" "))).otherwise(
        _every(139, F.concat(text, F.lit(" &amp; more")), text)
    )
    answer = F.when(F.col("seq") % 149 == 0, "").otherwise(
        _every(151, F.get(wrong, F.lit(0)), F.col("correct_answer"))
    )
    return (
        questions(spark, sf_dir)
        .withColumns(
            {
                "question_id": _every(131, F.lit("0" * 12), F.col("question_id")),
                "question": spoiled,
                "correct_answer": answer,
                "incorrect_answers": _every(157, F.concat(wrong, F.array(F.upper(F.get(wrong, F.lit(0))))), wrong),
            }
        )
        .select(*CLEAN_QUESTIONS.fieldNames())
    )


def repeated_raw_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw questions asked again and again in slightly different spacing, case and entities."""
    spaced = F.concat(
        F.lit("  Which&nbsp;brand makes \t"), F.translate("p_name", " ", "\u00a0"), F.lit("&#63;\u00ad ")
    )
    shouted = F.upper(F.concat(F.lit("Which brand makes "), "p_name", F.lit("?")))
    said = F.when(F.col("p_partkey") % 3 == 0, shouted).otherwise(spaced)
    return question_rows(spark, sf_dir, question=said).select(
        "type",
        "difficulty",
        "category",
        "question",
        "correct_answer",
        F.to_json("incorrect_answers").alias("incorrect_answers"),
        "seq",
    )


def api_pages(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """Captured API pages as JSON text: two questions each, every response code that may occur.

    ``in_order`` puts them into one file in the order of the parts, as a client would append them.
    """
    last = F.col("seq") % 10
    code = F.when(last == 3, 1).when(last == 7, 4).when(last == 9, 5).otherwise(0)

    def result(suffix):
        fields = [
            F.concat("question", F.lit(suffix)).alias("question") if f.name == "question" else F.col(f.name)
            for f in API_QUESTION
        ]
        return F.struct(*fields)

    page = F.struct(code.alias("response_code"), F.array(result(""), result(" (bis)")).alias("results"))
    rows = question_rows(spark, sf_dir)
    return (rows.orderBy("seq").coalesce(1) if in_order else rows).select(F.to_json(page).alias("body"))


def chatty_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers around a letter in ten wordings, from the line items."""
    letter = F.substr(F.lit("ABCDE"), (F.col("l_partkey") % 5 + 1).cast("int"), F.lit(1))
    wordings = (
        ('{"answer": "', '"}'),
        ('{"answer": " ', ' "}'),
        ('{"answer": 1, "note": "', '"}'),
        ("", ") Mars"),
        ("(", ")"),
        ("", " : x\n"),
        ("The answer is (", "), I think"),
        ("I would say ANSWER: ", ""),
        ("Because ", "!"),
        ('{"reply": "', '"}'),
    )
    kind = F.col("l_orderkey") % len(wordings)
    raw = F.when(F.lit(False), "")
    for i, (before, after) in enumerate(wordings):
        raw = raw.when(kind == i, F.concat(F.lit(before), letter, F.lit(after)))
    return table(spark, sf_dir, "lineitem").select(
        raw.alias("raw"),
        F.when(F.col("l_suppkey") % 2 == 0, 2).otherwise(4).alias("nb"),
        (F.col("l_linenumber") % 2 == 0).alias("structured"),
    )
