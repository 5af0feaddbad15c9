"""Report queries over the evaluation tables.

Inputs are the tables built by ``marts``. Apart from the question table, which has one row per
question and is only filtered, aggregated or range-sorted here, they have as many rows as there are
models, prompts, categories and positions.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from askgauge.functions.labels import label_or_code, rank_in
from askgauge.functions.metrics import ratio, round_to, share_of
from askgauge.schemas import (
    ANSWERS_GAINED,
    ANSWERS_LOST,
    DIFFICULTY_LABELS,
    DIFFICULTY_LEVELS,
    FORMAT_LABELS,
    KNOWLEDGE_MEASURES,
    POSITION_MEASURES,
    PROMPT_LABELS,
    QUESTION_TYPE_LABELS,
    QUESTION_TYPES,
    SAMPLE_NOTE,
    SMALL_SAMPLE,
    SMALL_SAMPLE_NOTE,
    STATUS_SHARES,
    TEMPERATURE_RUNS,
)

REFERENCE_PROMPT = "v1_letters"
DIMENSION_LABELS = {
    "prompt_version": ("prompt_label", PROMPT_LABELS),
    "difficulty": ("difficulty_label", DIFFICULTY_LABELS),
    "question_type": ("type_label", QUESTION_TYPE_LABELS),
    "label_style": ("format_label", FORMAT_LABELS),
}


# --- Shared steps ---


def with_labels(df: DataFrame) -> DataFrame:
    """Add the display label of every known dimension the table has."""
    return df.withColumns(
        {
            name: label_or_code(F.col(code), mapping)
            for code, (name, mapping) in DIMENSION_LABELS.items()
            if code in df.columns
        }
    )


def with_sample_note(df: DataFrame) -> DataFrame:
    """Flag rows resting on few questions and say on how many."""
    low, size = F.col("n_questions") < SMALL_SAMPLE, F.col("n_questions").cast("string")
    note = F.concat(F.when(low, SMALL_SAMPLE_NOTE).otherwise(SAMPLE_NOTE), size)
    return df.withColumns({"low_n": low, "sample_note": note})


def as_percent(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(100.0) for c in columns if c in df.columns})


def one_row(*parts: DataFrame) -> DataFrame:
    """Put single-row results side by side."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(*(F.max(c).alias(c) for c in merged.columns))


def _top(df: DataFrame, *order: Column, n: int = 1) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _place(*partition, order) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


# --- Home ---


def volumes(leaderboard: DataFrame, insights: DataFrame) -> DataFrame:
    """How much was asked: responses, questions, models, prompts, runs."""
    runs = leaderboard.agg(
        F.sum("n_questions").alias("n_responses"),
        F.count_distinct("model_key").alias("n_models"),
        F.count_distinct("prompt_version").alias("n_prompts"),
        F.count("*").alias("n_runs"),
    )
    return one_row(runs, insights.agg(F.count("*").alias("n_questions")))


def leaderboard_selection(leaderboard: DataFrame, models=None, prompt: str | None = None) -> DataFrame:
    """Chosen runs, best first. Without a prompt, every run is ranked on its own, never averaged."""
    chosen = leaderboard if models is None else leaderboard.where(F.col("model_key").isin(*models))
    if prompt is not None:
        chosen = chosen.where(F.col("prompt_version") == prompt)
    labelled = with_labels(chosen)
    return labelled.withColumn("run_label", F.concat("model_name", F.lit(" · "), "prompt_label")).orderBy(
        F.desc("accuracy"), "model_key", "prompt_version"
    )


def winner_vs_runner_up(leaderboard: DataFrame) -> DataFrame:
    """Per prompt: the two best models, their gap, and whether their intervals are disjoint."""
    placed = leaderboard.withColumn(
        "place", _place("prompt_version", order=(F.desc("accuracy"), F.col("model_key")))
    )

    def of(place, column):
        return F.max(F.when(F.col("place") == place, F.col(column)))

    return (
        placed.groupBy("prompt_version")
        .agg(
            of(1, "model_name").alias("best_model"),
            of(1, "accuracy").alias("best_accuracy"),
            of(2, "model_name").alias("second_model"),
            of(2, "accuracy").alias("second_accuracy"),
            round_to(of(1, "accuracy") - of(2, "accuracy"), 4).alias("gap"),
            (of(1, "accuracy_ci_low") > of(2, "accuracy_ci_high")).alias("is_significant"),
            F.min("n_questions").alias("n_questions_min"),
            F.max("n_questions").alias("n_questions_max"),
            F.count("*").alias("n_models"),
        )
    )


def status_shares(leaderboard: DataFrame) -> DataFrame:
    """Right, wrong and unreadable shares of each run, long form, with the sample note."""
    valid, right = F.col("valid_format_rate"), F.col("accuracy")
    kept = ["model_name", "prompt_version", "n_questions", "low_n", "sample_note"]
    shares = (right, round_to(valid - right, 4), round_to(F.lit(1.0) - valid, 4))
    named = (share.alias(status) for status, share in zip(STATUS_SHARES, shares))
    return with_sample_note(leaderboard).select(*kept, *named).unpivot(kept, list(STATUS_SHARES), "status", "share")


# --- Models ---


def profile_with_baseline(profile: DataFrame, leaderboard: DataFrame) -> DataFrame:
    """Profiles, best first, with the guessing level of the model's first temperature-0 run."""
    baseline = (
        leaderboard.where(F.col("temperature") == 0)
        .groupBy("model_key")
        .agg(F.min_by("random_baseline", "prompt_version").alias("random_baseline"))
    )
    return best_first(profile.join(baseline, "model_key", "left"))


def best_first(profile: DataFrame) -> DataFrame:
    """Profiles in the order of the report; ``model_profile`` can give them their guessing level itself."""
    return profile.orderBy(F.desc("accuracy"), "model_key")


def profile_summary(profile: DataFrame) -> DataFrame:
    """Best, fastest and largest model, and whether accuracy follows size exactly."""
    by_accuracy = Window.orderBy(F.desc("accuracy"), "model_key")
    larger_before = F.lag("model_params_b").over(by_accuracy)
    stepped = profile.withColumn("out_of_order", F.coalesce(F.col("model_params_b") > larger_before, F.lit(False)))
    name = F.col("model_name")
    return stepped.agg(
        F.min_by(name, F.struct((-F.col("accuracy")).alias("a"), "model_key")).alias("best_model"),
        F.min_by(name, F.struct("avg_response_time_s", "model_key")).alias("fastest_model"),
        F.min_by(name, F.struct((-F.col("model_params_b")).alias("s"), "model_key")).alias("largest_model"),
        ((F.count_if("out_of_order") == 0) & (F.count("*") > 1)).alias("size_follows_accuracy"),
    )


def knowledge_vs_format(profile: DataFrame) -> DataFrame:
    """Accuracy and accuracy among readable answers, long form."""
    kept = ["model_key", "model_name", "model_params_b", "n_responses", "valid_format_rate"]
    return profile.unpivot(kept, list(KNOWLEDGE_MEASURES), "measure", "value").withColumn(
        "measure", label_or_code(F.col("measure"), KNOWLEDGE_MEASURES)
    )


# --- Prompt formats ---


def format_report(formats: DataFrame, leaderboard: DataFrame) -> DataFrame:
    """Formats with the interval and guessing level of the same run."""
    run = ["model_key", "prompt_version"]
    bounds = leaderboard.select(*run, "accuracy_ci_low", "accuracy_ci_high", "random_baseline")
    return with_sample_note(with_labels(formats)).join(bounds, run, "left")


def format_means(formats: DataFrame) -> DataFrame:
    """Mean accuracy of each format over the models, best first."""
    return (
        with_labels(formats)
        .groupBy("format_label")
        .agg(round_to(F.avg("accuracy"), 4).alias("mean_accuracy"))
        .orderBy(F.desc("mean_accuracy"), "format_label")
    )


def most_format_sensitive(formats: DataFrame) -> DataFrame:
    """The model and format furthest from the model's letters prompt."""
    away = with_labels(formats.where(F.col("label_style") != "letters"))
    return _top(
        away, F.abs("accuracy_delta_vs_letters").desc(), F.col("model_key"), F.col("prompt_version")
    ).select("model_name", "format_label", "accuracy_delta_vs_letters")


# --- Temperature ---


def temperature_overall(effect: DataFrame, leaderboard: DataFrame, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """Total rows of the temperature table with the guessing level of the reference prompt."""
    baseline = leaderboard.where(F.col("prompt_version") == prompt).select("model_key", "random_baseline")
    return effect.where(F.col("difficulty") == "all").join(baseline, "model_key", "left")


def temperature_by_difficulty(effect: DataFrame) -> DataFrame:
    """Rows of one difficulty each, labelled, with the sample note."""
    return with_sample_note(with_labels(effect.where(F.col("difficulty") != "all")))


def temperature_extremes(overall: DataFrame) -> DataFrame:
    """The model that loses most accuracy, and the one that repeats its answers most."""
    steady = F.struct((-F.col("answer_stability")).alias("s"), "model_key")
    loser = F.struct("accuracy_delta", "model_key")
    return overall.agg(
        F.min_by("model_name", loser).alias("worst_model"),
        F.min("accuracy_delta").alias("worst_delta"),
        F.min_by("model_name", steady).alias("steadiest_model"),
        F.max("answer_stability").alias("best_stability"),
    )


def cold_hot_long(overall: DataFrame) -> DataFrame:
    kept = ["model_name", "n_questions", "accuracy_delta"]
    return overall.unpivot(kept, list(TEMPERATURE_RUNS), "run", "accuracy").withColumn(
        "run", label_or_code(F.col("run"), TEMPERATURE_RUNS)
    )


def lost_and_gained(overall: DataFrame) -> DataFrame:
    """Answers lost (negative share) and gained (positive share) at a positive temperature."""
    flows = F.array(
        F.struct(
            F.lit(ANSWERS_LOST).alias("direction"),
            (F.lit(0.0) - F.col("rate_correct_to_wrong")).alias("share"),
            F.col("rate_correct_to_wrong").alias("rate"),
        ),
        F.struct(
            F.lit(ANSWERS_GAINED).alias("direction"),
            F.col("rate_wrong_to_correct").alias("share"),
            F.col("rate_wrong_to_correct").alias("rate"),
        ),
    )
    return overall.select("model_name", "n_questions", F.inline(flows))


# --- Categories ---


def family_rollup(perf: DataFrame, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """Categories pooled by group: right answers over questions, never a mean of means.

    ``theme_order`` numbers the groups from the best answered to the worst over all models.
    """
    pooled = (
        perf.where(F.col("prompt_version") == prompt)
        .groupBy("model_key", "model_name", "category_group")
        .agg(
            F.sum("n_correct").alias("n_correct"),
            F.sum("n_questions").alias("n_questions"),
            F.max("model_accuracy").alias("model_accuracy"),
        )
    )
    group = Window.partitionBy("category_group")
    accuracy = ratio(F.col("n_correct"), F.col("n_questions"))
    everyone = ratio(F.sum("n_correct").over(group), F.sum("n_questions").over(group))
    return (
        pooled.withColumns({"own": accuracy, "everyone": everyone})
        .withColumns(
            {
                "rank_in_category": F.rank().over(group.orderBy(F.desc("own"))),
                "theme_order": F.dense_rank().over(Window.orderBy(F.desc("everyone"), "category_group")),
            }
        )
        .select(
            "model_key",
            "model_name",
            F.col("category_group").alias("category"),
            "n_correct",
            "n_questions",
            "model_accuracy",
            round_to(F.col("own"), 4).alias("accuracy"),
            round_to(F.col("own") - F.col("model_accuracy"), 4).alias("delta_vs_model_average"),
            round_to(F.col("everyone"), 4).alias("category_accuracy_all_models"),
            "rank_in_category",
            "theme_order",
        )
    )


def category_order(perf: DataFrame, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """Categories from the best answered to the worst over all models."""
    return (
        perf.where(F.col("prompt_version") == prompt)
        .groupBy("category_group", "category_name")
        .agg(F.max("category_accuracy_all_models").alias("category_accuracy_all_models"))
        .orderBy(F.desc("category_accuracy_all_models"), "category_group", "category_name")
    )


def category_wins(perf: DataFrame, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """Number of categories each model leads, zero included."""
    return (
        perf.where(F.col("prompt_version") == prompt)
        .groupBy("model_key", "model_name")
        .agg(F.count_distinct(F.when(F.col("is_best_in_category"), F.col("category_name"))).alias("n_wins"))
    )


def strong_and_weak_categories(perf: DataFrame, prompt: str = REFERENCE_PROMPT, n: int = 3) -> DataFrame:
    """The n best and n worst categories of each model, relative to its own mean."""
    delta = F.col("delta_vs_model_average")
    name = (F.col("category_group"), F.col("category_name"))
    placed = perf.where(F.col("prompt_version") == prompt).withColumns(
        {
            "best_place": _place("model_key", order=(delta.desc(), *name)),
            "worst_place": _place("model_key", order=(delta.asc(), *(c.desc() for c in name))),
        }
    )
    strong, weak = F.col("best_place") <= n, F.col("worst_place") <= n
    return placed.where(strong | weak).select(
        "model_key",
        "category_group",
        "category_name",
        "delta_vs_model_average",
        strong.alias("is_strong"),
        weak.alias("is_weak"),
    )


def subgroup_hypothesis(perf: DataFrame, categories, target: str, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """On chosen categories, does the target model fall further below its own mean than all others?"""
    pooled = (
        perf.where((F.col("prompt_version") == prompt) & F.col("category_name").isin(*categories))
        .groupBy("model_key", "model_name")
        .agg(
            F.sum("n_correct").alias("n_correct"),
            F.sum("n_questions").alias("n_questions"),
            F.max("model_accuracy").alias("model_accuracy"),
        )
        .withColumn("raw", ratio(F.col("n_correct"), F.col("n_questions")))
        .withColumn("raw_delta", F.col("raw") - F.col("model_accuracy"))
        .withColumn("is_target", F.contains(F.lower("model_name"), F.lit(target.lower())))
    )
    lowest_other = F.min(F.when(~F.col("is_target"), F.col("raw_delta"))).over(Window.partitionBy())
    return pooled.withColumn("lowest_other", lowest_other).select(
        "model_key",
        "model_name",
        "n_questions",
        round_to(F.col("raw"), 4).alias("subgroup_accuracy"),
        round_to(F.col("raw_delta"), 4).alias("delta"),
        "is_target",
        F.coalesce(F.col("is_target") & (F.col("raw_delta") < F.col("lowest_other")), F.lit(False)).alias(
            "supports_hypothesis"
        ),
    )


# --- Difficulty ---


def difficulty_drop(perf: DataFrame, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """Pooled accuracy on easy and hard questions, and the drop between them, per model."""

    def pooled(level):
        at = F.col("difficulty") == level
        return ratio(F.sum(F.when(at, F.col("n_correct"))), F.sum(F.when(at, F.col("n_questions"))))

    return (
        perf.where(F.col("prompt_version") == prompt)
        .groupBy("model_name")
        .agg(
            round_to(pooled("easy"), 4).alias("easy"),
            round_to(pooled("hard"), 4).alias("hard"),
            round_to(pooled("easy") - pooled("hard"), 4).alias("drop"),
        )
        .orderBy(F.desc("drop"), "model_name")
    )


def difficulty_pivot(perf: DataFrame, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """Accuracy in percent, one row per model, one column per difficulty and question type."""
    columns = [f"{level}_{kind}" for kind in QUESTION_TYPES for level in DIFFICULTY_LEVELS]
    return as_percent(
        perf.where(F.col("prompt_version") == prompt)
        .withColumn("cell", F.concat_ws("_", "difficulty", "question_type"))
        .groupBy("model_name")
        .pivot("cell", columns)
        .agg(F.max("accuracy")),
        columns,
    )


def facet_baseline(perf: DataFrame, prompt: str = REFERENCE_PROMPT) -> DataFrame:
    """Mean guessing level per question type."""
    return (
        with_labels(perf.where(F.col("prompt_version") == prompt))
        .groupBy("type_label")
        .agg(round_to(F.avg("random_baseline"), 4).alias("mean_baseline"))
    )


# --- Position bias ---


def strongest_bias(bias: DataFrame) -> DataFrame:
    """Per prompt and question type, the model and position furthest from their expected share."""
    order = (F.abs("position_bias").desc(), F.col("model_key"), F.col("position"))
    return (
        bias.withColumn("place", _place("prompt_version", "question_type", order=order))
        .where(F.col("place") == 1)
        .select(
            "prompt_version",
            "question_type",
            "model_name",
            "position_label",
            "share_chosen",
            "share_expected",
            "position_bias",
        )
    )


def true_share(bias: DataFrame) -> DataFrame:
    """Share of ``True`` among boolean answers, against its share among right answers."""
    return bias.where((F.col("question_type") == "boolean") & (F.col("position") == 1)).select(
        "model_name", "prompt_version", "share_chosen", "share_expected", "position_bias"
    )


def position_shares(bias: DataFrame) -> DataFrame:
    """Given and expected shares of every position, long form."""
    kept = [
        "model_name",
        "prompt_version",
        "question_type",
        "position",
        "position_label",
        "n_chosen",
        "n_correct_here",
        "position_bias",
    ]
    return bias.unpivot(kept, list(POSITION_MEASURES), "measure", "share").withColumn(
        "measure", label_or_code(F.col("measure"), POSITION_MEASURES)
    )


# --- Questions ---


def search_questions(
    insights: DataFrame, groups=None, difficulties=None, types=None, text: str | None = None
) -> DataFrame:
    """Questions matching every given filter; the text is searched literally, ignoring case."""
    found = insights
    for column, values in (("category_group", groups), ("difficulty", difficulties), ("question_type", types)):
        if values is not None:
            found = found.where(F.col(column).isin(*values))
    if text:
        found = found.where(F.contains(F.lower("question_text"), F.lit(text.lower())))
    return found


def question_explorer(insights: DataFrame) -> DataFrame:
    """All questions, hardest first, success in percent."""
    labelled = with_labels(insights).withColumn(
        "ai_difficulty_label", label_or_code(F.col("ai_difficulty"), DIFFICULTY_LABELS)
    )
    return as_percent(labelled, ["success_rate"]).orderBy("success_rate", "question_id")


def trap_list(insights: DataFrame) -> DataFrame:
    """Questions on which the models agree on the same wrong answer, most agreed first."""
    return (
        insights.where("is_common_trap")
        .select(
            "question_id",
            "question_text",
            "category_name",
            "difficulty",
            "correct_answer",
            "top_wrong_answer",
            "top_wrong_votes",
            "n_answers",
        )
        .orderBy(F.desc("top_wrong_votes"), "question_id")
    )


def trap_summary(insights: DataFrame) -> DataFrame:
    """Shares and counts of questions missed by all, solved by all, and common traps."""
    return insights.agg(
        F.count("*").alias("n_questions"),
        round_to(share_of(F.col("is_all_wrong")), 4).alias("all_wrong_share"),
        F.count_if("is_all_wrong").alias("n_all_wrong"),
        F.count_if("is_common_trap").alias("n_traps"),
        round_to(share_of(F.col("is_all_correct")), 4).alias("all_correct_share"),
        F.count_if("is_all_correct").alias("n_all_correct"),
    )


def majority_vs_best(insights: DataFrame, profile: DataFrame) -> DataFrame:
    """Accuracy of the majority vote of all models against the best model alone."""
    crowd = insights.agg(share_of(F.col("is_majority_correct")).alias("crowd"))
    best = _top(profile, F.desc("accuracy"), F.col("model_key")).select(
        F.col("model_name").alias("best_model"), F.col("accuracy").alias("best_accuracy")
    )
    return one_row(crowd, best).select(
        round_to(F.col("crowd"), 4).alias("majority_accuracy"),
        "best_model",
        "best_accuracy",
        round_to(F.col("crowd") - F.col("best_accuracy"), 4).alias("gain"),
        (F.col("crowd") > F.col("best_accuracy")).alias("majority_is_better"),
    )


def difficulty_crosstab(insights: DataFrame) -> DataFrame:
    """Announced against experienced difficulty: counts, row shares, and the overall agreement."""
    levels = list(DIFFICULTY_LEVELS)
    counts = insights.groupBy("difficulty").pivot("ai_difficulty", levels).agg(F.count(F.lit(1))).na.fill(0, levels)
    everything = Window.partitionBy()
    total = sum((F.col(c) for c in levels), F.lit(0))
    diagonal = F.coalesce(*(F.when(F.col("difficulty") == c, F.col(c)) for c in levels), F.lit(0))
    return (
        counts.withColumns(
            {
                "row_total": total,
                "agreement": round_to(ratio(F.sum(diagonal).over(everything), F.sum(total).over(everything)), 4),
            }
        )
        .unpivot(["difficulty", "row_total", "agreement"], levels, "lived", "n")
        .select(
            F.col("difficulty").alias("announced"),
            "lived",
            "n",
            round_to(ratio(F.col("n"), F.col("row_total")), 4).alias("row_share"),
            "agreement",
        )
    )


def success_histogram(insights: DataFrame) -> DataFrame:
    """Questions by number of right answers out of the number of answers, and by difficulty."""
    return (
        insights.withColumn("score", F.col("n_correct").cast("int"))
        .withColumn("bucket", F.concat_ws("/", F.col("score").cast("string"), F.col("n_answers").cast("string")))
        .groupBy("score", "bucket", "difficulty")
        .agg(F.count("*").alias("n"))
        .withColumn("color_rank", rank_in(F.col("difficulty"), DIFFICULTY_LEVELS))
        .orderBy("score", "bucket", "color_rank")
    )


# --- Display order ---


def display_order(df: DataFrame, fallback_order=()) -> DataFrame:
    """Models numbered by size then name; without sizes, by a given order, unknown models last."""
    if "model_params_b" in df.columns:
        models = df.groupBy("model_key").agg(
            F.max("model_name").alias("model_name"), F.max("model_params_b").alias("sort_value")
        )
    else:
        models = df.groupBy("model_key").agg(F.max("model_name").alias("model_name")).withColumn(
            "sort_value", rank_in(F.col("model_key"), fallback_order).cast("double")
        )
    place = F.row_number().over(Window.orderBy("sort_value", "model_name", "model_key"))
    return models.select("model_key", "model_name", place.alias("display_order"))


def ordered_values(df: DataFrame, column: str, order) -> DataFrame:
    """Distinct values of a column in a reference order, unknown values last, alphabetically."""
    known = rank_in(F.col(column), order)
    place = F.row_number().over(Window.orderBy(known, column))
    return df.select(column).distinct().where(F.col(column).isNotNull()).select(
        column, place.alias("display_order")
    )
