"""The eight evaluation tables.

Each function takes the enriched responses and returns one table. All of them follow one shape: the
response table is scanned once and reduced, with map-side combining, to a table whose size depends
on the number of models, prompts, categories and options, not on the number of responses. Totals,
reference rows and ranks are then windows over that reduced table. Nothing joins the responses to
themselves, so an over-represented model or question never meets a second large side. Where several
windows share a key, the reduced table is repartitioned on that key once; left alone, Spark would
shuffle it for each window.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from askgauge.functions.metrics import chance_corrected, ratio, round_to, wilson_high, wilson_low
from askgauge.schemas import SIZE_CLASSES


def _counts():
    """Responses, right ones and readable ones."""
    return [
        F.count("*").alias("n"),
        F.count_if("ai_correct").alias("n_correct"),
        F.count_if("is_valid_format").alias("n_valid"),
    ]


def _mean_parts(column, name):
    """Sum and non-null count of a column: a mean that can be summed up further."""
    return [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]


# What five of the tables are made of: everything they group by but for the question, and its measures.
CELL = (
    "model_key",
    "model_name",
    "model_publisher",
    "model_country",
    "model_params_b",
    "prompt_version",
    "label_style",
    "temperature",
    "category_group",
    "category_name",
    "difficulty",
    "difficulty_level",
    "question_type",
    "correct_position",
    "ai_position",
    "is_valid_format",
)
MEASURES = (
    "n",
    "n_correct",
    "n_valid",
    "n_correct_valid",
    "n_truncated",
    "truncated_n",
    "baseline_sum",
    "baseline_n",
    "token_sum",
    "token_n",
    "time_sum",
    "time_n",
)


def _reduce(source: DataFrame, *keys) -> DataFrame:
    """All measures per key, from responses or from counted responses; Spark drops those not used."""
    if "n_correct" in source.columns:
        return source.groupBy(*keys).agg(*_sums(*MEASURES))
    return source.groupBy(*keys).agg(
        *_counts(),
        F.count_if(F.col("is_valid_format") & F.col("ai_correct")).alias("n_correct_valid"),
        F.count_if("is_truncated").alias("n_truncated"),
        F.count("is_truncated").alias("truncated_n"),
        *_mean_parts("random_baseline", "baseline"),
        *_mean_parts("completion_tokens", "token"),
        *_mean_parts("response_time_s", "time"),
    )


def count_responses(enriched: DataFrame) -> DataFrame:
    """Responses counted per ``CELL``: the tables in ``FROM_COUNTS`` can be made from this as well.

    Its size is set by models, prompts, categories and options, so whoever needs several of them scans
    the responses once.
    """
    return _reduce(enriched, *CELL)


def _sums(*names):
    return [F.sum(name).alias(name) for name in names]


def _over(keys, *names):
    """Window totals of already reduced columns, named after the column."""
    window = Window.partitionBy(*keys)
    return [F.sum(name).over(window) for name in names]


def _rank_by(value: Column, *partition) -> Column:
    return F.rank().over(Window.partitionBy(*partition).orderBy(value.desc_nulls_last()))


def _per_minute(count: Column, seconds: Column) -> Column:
    return ratio(count, seconds / F.lit(60.0))


def _ci(successes: Column, total: Column):
    return (
        round_to(wilson_low(successes, total), 4).alias("accuracy_ci_low"),
        round_to(wilson_high(successes, total), 4).alias("accuracy_ci_high"),
    )


def _time_bucket(seconds: Column) -> Column:
    """A bucket number that never falls as the time grows: steps of under one percent, finer near zero."""
    steps = F.signum(seconds) * F.log1p(F.abs(seconds) * 1000) * 128
    return F.when(F.isnan(seconds), 2**62).when(seconds.isNotNull(), F.floor(steps))


# What a run is told apart by, and what the leaderboard adds up over it.
RUN = (
    "model_key",
    "model_name",
    "model_publisher",
    "model_country",
    "model_params_b",
    "prompt_version",
    "label_style",
    "temperature",
)
RUN_SUMS = ("n", "n_correct", "n_valid", "n_truncated", "baseline_sum", "baseline_n", "token_sum", "token_n", "time_sum")
# Buckets whose times are stored together: under four percent of a time, and 5,800 ranges over all doubles.
BUCKETS_PER_RANGE = 32


def _run_measures():
    return [
        *_counts(),
        F.count_if("is_truncated").alias("n_truncated"),
        *_mean_parts("random_baseline", "baseline"),
        *_mean_parts("completion_tokens", "token"),
        F.sum("response_time_s").alias("time_sum"),
    ]


def _placed(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("bucket", _time_bucket(F.col("response_time_s")))


def run_times(enriched: DataFrame) -> DataFrame:
    """Responses counted per run and distinct time: a histogram that can be added up and stored.

    ``bucket_range`` is what it is to be partitioned by: ``leaderboard_of`` reads the ranges around
    the quantiles only.
    """
    ranged = F.floor(F.col("bucket") / BUCKETS_PER_RANGE).alias("bucket_range")
    return _placed(enriched).groupBy(*RUN, "bucket", ranged, "response_time_s").agg(*_run_measures())


def run_buckets(times: DataFrame) -> DataFrame:
    """The histogram of ``run_times`` per run and bucket."""
    return times.groupBy(*RUN, "bucket").agg(*_sums(*RUN_SUMS))


def leaderboard(enriched: DataFrame, quantile: float | None = 0.95) -> DataFrame:
    """Accuracy, format discipline and speed of every run, ranked.

    The response-time quantile is exact and interpolated. Rows are counted per run and narrow time
    bucket; the running count over a run's few thousand buckets tells which one or two hold the values
    around the quantile. A second scan, of the run's columns and the time, counts the distinct times
    of those buckets only. No task holds the responses or all distinct times of a run. With no quantile
    the column is left out, and with it the second scan.
    """
    if quantile is None:
        return _scored_runs(_reduce(enriched, *RUN))
    placed = _placed(enriched)
    counted = placed.groupBy(*RUN, "bucket").agg(*_run_measures())
    return _leaderboard(counted, placed.select(*RUN, "bucket", "response_time_s", F.lit(1).alias("n")), quantile)


def leaderboard_of(buckets: DataFrame, times: DataFrame, quantile: float = 0.95) -> DataFrame:
    """The leaderboard from stored ``run_buckets`` and ``run_times``: no response is read.

    Of the times only the ranges that hold the values around a run's quantile are read. Their numbers
    come to the driver: 5,800 at most, however many runs and times there are.
    """
    ranged = F.floor(F.col("bucket") / BUCKETS_PER_RANGE).alias("bucket_range")
    found = _around(buckets, quantile).where("held").select(ranged).distinct().toArrow().column(0).to_pylist()
    here = F.col("bucket_range").isin([x for x in found if x is not None])
    if None in found:
        here = here | F.col("bucket_range").isNull()
    return _leaderboard(buckets, times.where(here).select(*RUN, "bucket", "response_time_s", "n"), quantile)


def _around(counted: DataFrame, quantile: float) -> DataFrame:
    """Buckets with the responses before them, the place of the quantile, and whether they hold its values."""
    by_run = Window.partitionBy(*RUN)
    before = by_run.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    timed = F.when(F.col("bucket").isNotNull(), F.col("n")).otherwise(F.lit(0))
    buckets = (
        counted.withColumn("passed", F.coalesce(F.sum(timed).over(before), F.lit(0)))
        .withColumn("time_n", F.sum(timed).over(by_run))
        .withColumn("spot", F.lit(quantile) * (F.col("time_n") - 1))
    )
    # Buckets that hold the two values; a run without times points to its rows without times.
    around = F.when(F.col("time_n") == 0, F.col("bucket").isNull()).otherwise(
        F.col("bucket").isNotNull()
        & (F.col("passed") <= F.ceil("spot"))
        & (F.col("passed") + F.col("n") > F.floor("spot"))
    )
    return buckets.withColumn("held", around)


def _leaderboard(counted: DataFrame, times: DataFrame, quantile: float) -> DataFrame:
    """The leaderboard from counts per run and bucket, and times that stand for ``n`` responses each."""
    run = RUN
    totals = _around(counted, quantile).groupBy(*run).agg(
        *_sums(*RUN_SUMS),
        F.max("time_n").alias("time_n"),
        F.max("spot").alias("spot"),
        F.collect_list(F.when(F.col("held"), F.struct("bucket", "passed"))).alias("around"),
    )
    carried = (*RUN_SUMS, "time_n", "spot")
    wanted = totals.select(
        *(F.col(c).alias(f"_{c}") for c in run), F.struct(*carried).alias("totals"), F.inline("around")
    ).withColumnsRenamed({"bucket": "_bucket", "passed": "_passed"})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*run, "bucket")))
    # At most three rows per run. Rows of other buckets go before anything is shuffled.
    near = (
        times.join(F.broadcast(wanted), same)
        .groupBy(*run, "bucket", "_passed", "response_time_s")
        .agg(F.sum("n").alias("here"), F.any_value("totals").alias("totals"))
    )
    upto = Window.partitionBy(*run, "bucket").orderBy("response_time_s").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    seen = F.col("_passed") + F.sum("here").over(upto)

    def time_at(index):
        return F.min(F.when(F.col("seen") > index, F.col("response_time_s")))

    runs = (
        near.withColumn("seen", seen)
        .groupBy(*run)
        .agg(
            F.any_value("totals").alias("totals"),
            time_at(F.floor("totals.spot")).alias("time_below"),
            time_at(F.ceil("totals.spot")).alias("time_above"),
        )
        .select(*run, "totals.*", "time_below", "time_above")
    )
    beyond = F.col("spot") - F.floor("spot")
    p_time = F.col("time_below") * (F.lit(1.0) - beyond) + F.col("time_above") * beyond
    # Rounded twice: an interpolated value halfway between two roundings carries double noise.
    return _scored_runs(runs, round_to(round_to(p_time, 9), 4).alias("p95_response_time_s"))


def _run_baseline() -> Column:
    return round_to(ratio(F.col("baseline_sum"), F.col("baseline_n")), 4).alias("random_baseline")


def _scored_runs(runs: DataFrame, *quantiles) -> DataFrame:
    """The leaderboard from one row of sums per run, with its quantile if there is one."""
    n, right, valid = F.col("n"), F.col("n_correct"), F.col("n_valid")
    accuracy, baseline = ratio(right, n), ratio(F.col("baseline_sum"), F.col("baseline_n"))
    return runs.select(
        *RUN,
        (F.col("temperature") > 0).alias("is_temperature_variant"),
        n.alias("n_questions"),
        right.alias("n_correct"),
        round_to(accuracy, 4).alias("accuracy"),
        *_ci(right, n),
        _run_baseline(),
        round_to(chance_corrected(accuracy, baseline), 4).alias("chance_corrected_score"),
        round_to(ratio(valid, n), 4).alias("valid_format_rate"),
        round_to(ratio(right, valid), 4).alias("accuracy_when_valid"),
        round_to(ratio(F.col("n_truncated"), n), 4).alias("truncated_rate"),
        round_to(ratio(F.col("time_sum"), F.col("time_n")), 4).alias("avg_response_time_s"),
        *quantiles,
        round_to(ratio(F.col("token_sum"), F.col("token_n")), 2).alias("avg_completion_tokens"),
        round_to(_per_minute(right, F.col("time_sum")), 1).alias("correct_per_minute"),
        _rank_by(accuracy).alias("accuracy_rank"),
    )


def size_class(params: Column, classes=SIZE_CLASSES) -> Column:
    """Class of a model size; each class but the last has an exclusive upper bound."""
    *bounded, (_, largest) = classes
    result = F.when(F.lit(False), F.lit(largest))
    for bound, label in bounded:
        result = result.when(params < F.lit(bound), F.lit(label))
    return result.otherwise(F.lit(largest))


def model_profile(enriched: DataFrame, with_baseline: bool = False) -> DataFrame:
    """One row per model over its temperature-0 prompts, with its best and worst prompt.

    Equal accuracies are resolved in favour of the alphabetically first prompt. ``with_baseline`` adds
    ``random_baseline``, the leaderboard's guessing level of the model's first run, from the same counts.
    """
    model = ("model_key", "model_name", "model_publisher", "model_country", "model_params_b")
    reduced = _reduce(
        enriched.where((F.col("temperature") == 0) & F.col("model_key").isNotNull()),
        *(RUN if with_baseline else (*model, "prompt_version")),
    )
    n_here, right_here = _over(("model_key", "prompt_version"), "n", "n_correct")
    prompt, score = F.col("prompt_version"), F.col("prompt_accuracy")

    def named(ranked):
        return F.min(F.when(prompt.isNotNull(), ranked)).over(Window.partitionBy("model_key"))

    models = (
        reduced.repartition("model_key")
        .withColumn("prompt_accuracy", ratio(right_here, n_here))
        .withColumns(
            {
                # A group without prompt version counts for the scores, but is never named.
                "best": named(F.struct((-score).alias("score"), prompt)),
                "worst": named(F.struct(score.alias("score"), prompt)),
                "highest": F.max(score).over(Window.partitionBy("model_key")),
                "lowest": F.min(score).over(Window.partitionBy("model_key")),
                "first_baseline": F.min_by(_run_baseline(), "prompt_version").over(Window.partitionBy("model_key")),
            }
        )
        .groupBy(*model)
        .agg(
            *_sums("n", "n_correct", "n_valid", "baseline_sum", "baseline_n", "time_sum", "time_n"),
            *(F.any_value(c).alias(c) for c in ("best", "worst", "highest", "lowest", "first_baseline")),
        )
    )
    n, right, valid = F.col("n"), F.col("n_correct"), F.col("n_valid")
    accuracy, baseline = ratio(right, n), ratio(F.col("baseline_sum"), F.col("baseline_n"))
    best_score, worst_score = F.col("highest"), F.col("lowest")
    return models.select(
        *model,
        size_class(F.col("model_params_b")).alias("size_class"),
        n.alias("n_responses"),
        round_to(accuracy, 4).alias("accuracy"),
        *_ci(right, n),
        round_to(chance_corrected(accuracy, baseline), 4).alias("chance_corrected_score"),
        round_to(ratio(valid, n), 4).alias("valid_format_rate"),
        round_to(ratio(right, valid), 4).alias("accuracy_when_valid"),
        F.col("best.prompt_version").alias("best_prompt"),
        round_to(best_score, 4).alias("best_prompt_accuracy"),
        F.col("worst.prompt_version").alias("worst_prompt"),
        round_to(worst_score, 4).alias("worst_prompt_accuracy"),
        round_to(best_score - worst_score, 4).alias("prompt_spread"),
        round_to(ratio(F.col("time_sum"), F.col("time_n")), 4).alias("avg_response_time_s"),
        round_to(_per_minute(right, F.col("time_sum")), 1).alias("correct_per_minute"),
        _rank_by(accuracy).alias("accuracy_rank"),
        *([F.col("first_baseline").alias("random_baseline")] if with_baseline else []),
    )


def prompt_format(enriched: DataFrame) -> DataFrame:
    """Answer formats of each model at temperature 0, compared with its letters prompt.

    A model with several letters prompts gives one row per format and letters prompt.
    """
    keys = ("model_key", "model_name", "model_params_b", "prompt_version", "label_style")
    formats = _reduce(enriched.where(F.col("temperature") == 0), *keys).withColumns(
        {
            "accuracy_": ratio(F.col("n_correct"), F.col("n")),
            "valid_": ratio(F.col("n_valid"), F.col("n")),
            "truncated": ratio(F.col("n_truncated"), F.col("truncated_n")),
            "tokens": ratio(F.col("token_sum"), F.col("token_n")),
            "seconds": ratio(F.col("time_sum"), F.col("time_n")),
        }
    )
    letters = F.collect_list(
        F.when(
            (F.col("label_style") == "letters") & F.col("model_key").isNotNull(),
            F.struct(F.col("accuracy_").alias("accuracy"), F.col("valid_").alias("valid")),
        )
    ).over(Window.partitionBy("model_key"))
    compared = formats.withColumn("letters", letters).withColumn("reference", F.explode_outer("letters"))
    accuracy, valid = F.col("accuracy_"), F.col("valid_")
    return compared.select(
        *keys,
        F.col("n").alias("n_questions"),
        round_to(accuracy, 4).alias("accuracy"),
        round_to(valid, 4).alias("valid_format_rate"),
        round_to(ratio(F.col("n_correct_valid"), F.col("n_valid")), 4).alias("accuracy_when_valid"),
        round_to(accuracy - F.col("reference.accuracy"), 4).alias("accuracy_delta_vs_letters"),
        round_to(valid - F.col("reference.valid"), 4).alias("valid_format_delta_vs_letters"),
        round_to(F.col("truncated"), 4).alias("truncated_rate"),
        round_to(F.col("tokens"), 2).alias("avg_completion_tokens"),
        round_to(F.col("seconds"), 4).alias("avg_response_time_s"),
        _rank_by(accuracy, "model_key").alias("rank_within_model"),
    )


def temperature_effect(enriched: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """Letters prompts at temperature 0 against temperature > 0, question by question.

    Every temperature-0 response of a question counts once for each hot response of the same model
    and question. The pairs are counted, never built: what is needed of the hot side is its size and
    its number of right, valid and same-position answers, so each cold row is weighted by those. A
    question answered a million times at each temperature costs a handful of rows, not 10^12.

    ``difficulty`` is ``all`` on the total rows. A question without difficulty carries the same
    label; ``with_grouping_id`` adds the column that tells them apart (1 on total rows).
    """
    return temperature_effect_of(temperature_cells(enriched), with_grouping_id)


DESCRIBED = ("model_name", "model_params_b", "difficulty", "difficulty_level")


def temperature_cells(enriched: DataFrame) -> DataFrame:
    """Letters answers counted per model, question, side and position: what ``temperature_effect`` is made of."""
    hot = F.col("temperature") > 0
    described = DESCRIBED
    return (
        enriched.where(
            (F.col("label_style") == "letters")
            & (hot | (F.col("temperature") == 0))
            & F.col("model_key").isNotNull()
            & F.col("question_id").isNotNull()
        )
        .select(
            "model_key",
            "question_id",
            hot.alias("hot"),
            *(F.when(~hot, F.col(c)).alias(c) for c in described),
            "ai_position",
            "ai_correct",
            "is_valid_format",
            "temperature",
        )
        .groupBy("model_key", "question_id", "hot", *described, "ai_position")
        .agg(*_counts(), F.min("temperature").alias("temperature"))
    )


def temperature_effect_of(answers: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """``temperature_effect`` from counted answers, such as stored ones that were added up."""
    described = DESCRIBED
    pair = Window.partitionBy("model_key", "question_id")
    same_spot = Window.partitionBy("model_key", "question_id", "ai_position")
    is_hot = F.col("hot")

    def hot_sum(name, window=pair):
        return F.coalesce(F.sum(F.when(is_hot, F.col(name))).over(window), F.lit(0))

    weighted = (
        answers.repartition("model_key", "question_id")
        .withColumns(
            {
                "hot_n": hot_sum("n"),
                "hot_correct": hot_sum("n_correct"),
                "hot_valid": hot_sum("n_valid"),
                "hot_same": hot_sum("n", same_spot),
                "hot_temperature": F.min(F.when(is_hot, F.col("temperature"))).over(pair),
            }
        )
        .where(~is_hot & (F.col("hot_n") > 0))
        .groupBy("model_key", *described)
        .agg(
            F.min("temperature").alias("cold_t"),
            F.min("hot_temperature").alias("hot_t"),
            F.sum(F.col("n") * F.col("hot_n")).alias("pairs"),
            F.sum(F.col("n_correct") * F.col("hot_n")).alias("cold_right"),
            F.sum(F.col("n") * F.col("hot_correct")).alias("hot_right"),
            F.sum(F.col("n_valid") * F.col("hot_n")).alias("cold_valid"),
            F.sum(F.col("n") * F.col("hot_valid")).alias("hot_valid"),
            F.sum(F.col("n") * F.col("hot_same")).alias("same"),
            F.sum(F.col("n_correct") * (F.col("hot_n") - F.col("hot_correct"))).alias("lost"),
            F.sum((F.col("n") - F.col("n_correct")) * F.col("hot_correct")).alias("gained"),
        )
    )
    return temperature_rates(weighted, with_grouping_id)


PAIR_SUMS = ("pairs", "cold_right", "hot_right", "cold_valid", "hot_valid", "same", "lost", "gained")


def temperature_rates(counted: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """``temperature_effect`` from pairs counted per model and difficulty: ``PAIR_SUMS``, ``cold_t`` and ``hot_t``.

    Several rows of one model and difficulty add up, so counts of parts may be unioned.
    """
    model = [F.col(c) for c in ("model_key", "model_name", "model_params_b")]
    level = [F.col("difficulty"), F.col("difficulty_level")]
    totals = counted.groupingSets([model + level, model], *model, *level).agg(
        F.min("cold_t").alias("temperature_cold"),
        F.min("hot_t").alias("temperature_hot"),
        *_sums(*PAIR_SUMS),
        F.grouping("difficulty").cast("int").alias("grouping_id"),
    )
    pairs = F.col("pairs")

    def rate(name):
        return ratio(F.col(name), pairs)

    return totals.select(
        "model_key",
        "model_name",
        "model_params_b",
        F.coalesce("difficulty", F.lit("all")).alias("difficulty"),
        F.coalesce(F.col("difficulty_level").cast("int"), F.lit(0)).alias("difficulty_level"),
        "temperature_cold",
        "temperature_hot",
        pairs.alias("n_questions"),
        round_to(rate("cold_right"), 4).alias("accuracy_cold"),
        round_to(rate("hot_right"), 4).alias("accuracy_hot"),
        round_to(rate("hot_right") - rate("cold_right"), 4).alias("accuracy_delta"),
        round_to(rate("cold_valid"), 4).alias("valid_format_rate_cold"),
        round_to(rate("hot_valid"), 4).alias("valid_format_rate_hot"),
        round_to(rate("same"), 4).alias("answer_stability"),
        round_to(rate("lost"), 4).alias("rate_correct_to_wrong"),
        round_to(rate("gained"), 4).alias("rate_wrong_to_correct"),
        *(["grouping_id"] if with_grouping_id else []),
    )


def perf_by_category(enriched: DataFrame) -> DataFrame:
    """Accuracy per model, prompt and category, against the model's mean and the other models."""
    keys = (
        "model_key",
        "model_name",
        "model_country",
        "prompt_version",
        "temperature",
        "category_group",
        "category_name",
    )
    reduced = _reduce(enriched, *keys)
    category = ("prompt_version", "category_group", "category_name")
    model_n, model_right = _over(("model_key", "prompt_version"), "n", "n_correct")
    all_n, all_right = _over(category, "n", "n_correct")
    measured = reduced.withColumns(
        {
            "accuracy_": ratio(F.col("n_correct"), F.col("n")),
            "model_": ratio(model_right, model_n),
            "everyone_": ratio(all_right, all_n),
        }
    ).where(
        # A row without one of its keys has no mean to be compared with.
        F.col("model_key").isNotNull()
        & F.col("prompt_version").isNotNull()
        & F.col("category_group").isNotNull()
        & F.col("category_name").isNotNull()
    )
    accuracy, place = F.col("accuracy_"), F.col("rank_in_category")
    return (
        measured.withColumn("rank_in_category", _rank_by(accuracy, *category))
        .select(
            *keys,
            F.col("n").alias("n_questions"),
            "n_correct",
            round_to(accuracy, 4).alias("accuracy"),
            *_ci(F.col("n_correct"), F.col("n")),
            round_to(F.col("model_"), 4).alias("model_accuracy"),
            round_to(accuracy - F.col("model_"), 4).alias("delta_vs_model_average"),
            round_to(F.col("everyone_"), 4).alias("category_accuracy_all_models"),
            "rank_in_category",
            (place == 1).alias("is_best_in_category"),
        )
    )


def perf_by_difficulty(enriched: DataFrame) -> DataFrame:
    """Accuracy per model, prompt, announced difficulty and question type, against guessing."""
    keys = (
        "model_key",
        "model_name",
        "model_params_b",
        "prompt_version",
        "temperature",
        "difficulty",
        "difficulty_level",
        "question_type",
    )
    reduced = _reduce(enriched, *keys)
    n, right = F.col("n"), F.col("n_correct")
    accuracy, baseline = ratio(right, n), ratio(F.col("baseline_sum"), F.col("baseline_n"))
    return reduced.select(
        *keys,
        n.alias("n_questions"),
        "n_correct",
        round_to(accuracy, 4).alias("accuracy"),
        *_ci(right, n),
        round_to(baseline, 4).alias("random_baseline"),
        round_to(chance_corrected(accuracy, baseline), 4).alias("chance_corrected_score"),
        round_to(ratio(F.col("n_valid"), n), 4).alias("valid_format_rate"),
    )


def position_bias(enriched: DataFrame) -> DataFrame:
    """How often each option position is chosen, against how often it is right.

    The responses are reduced to counts per (correct position, chosen position). Each count then
    plays two parts, one at the position that was right and one at the position that was chosen, and
    windows put the two side by side. Positions that are never right do not appear.
    """
    block = ("model_key", "prompt_version", "question_type")
    described = ("model_name", "label_style", "temperature")
    counted = _reduce(enriched, *block, *described, "correct_position", "ai_position", "is_valid_format")

    def part(position, here, found, chosen, valid):
        return F.struct(
            position.alias("position"),
            here.alias("n_here"),
            found.alias("n_found"),
            chosen.alias("n_chosen"),
            valid.alias("n_valid"),
        )

    n, none, valid_n = F.col("n"), F.lit(0).cast("bigint"), F.when(F.col("is_valid_format"), F.col("n")).otherwise(0)
    parts = counted.repartition(*block).select(
        *block,
        *described,
        F.inline(
            F.array(
                part(F.col("correct_position"), n, F.col("n_correct"), none, valid_n),
                part(F.col("ai_position"), none, none, valid_n, none),
            )
        ),
    )
    (chosen,) = _over((*block, "position"), "n_chosen")
    total, valid = _over(block, "n_here", "n_valid")
    rows = (
        parts.withColumns({"chosen": chosen, "total": total, "valid": valid})
        .where(
            (F.col("n_here") > 0)
            & F.col("model_key").isNotNull()
            & F.col("prompt_version").isNotNull()
            & F.col("question_type").isNotNull()
        )
        .groupBy(*block, *described, "position")
        .agg(
            *_sums("n_here", "n_found"),
            F.max("chosen").alias("n_chosen"),
            F.max("total").alias("total"),
            F.max("valid").alias("valid"),
        )
    )
    position, here = F.col("position"), F.col("n_here")
    share, expected = ratio(F.col("n_chosen"), F.col("valid")), ratio(here, F.col("total"))
    label = F.when(
        F.col("question_type") == "boolean", F.when(position == 1, "True").otherwise("False")
    ).otherwise(F.char(F.lit(64) + position))
    return rows.select(
        "model_key",
        "model_name",
        "prompt_version",
        "label_style",
        "temperature",
        "question_type",
        "position",
        label.alias("position_label"),
        "n_chosen",
        here.alias("n_correct_here"),
        round_to(share, 4).alias("share_chosen"),
        round_to(expected, 4).alias("share_expected"),
        round_to(share - expected, 4).alias("position_bias"),
        round_to(ratio(F.col("n_found"), here), 4).alias("accuracy_when_correct_here"),
    )


ATTRIBUTES = (
    "question_text",
    "question_type",
    "difficulty",
    "difficulty_level",
    "category_group",
    "category_name",
    "correct_answer",
)
# Models that share one 64-bit word of a stored set.
WORD = 64


def question_votes(enriched: DataFrame, models: DataFrame) -> DataFrame:
    """Temperature-0 responses counted per question and answer, with the sets of models as bits.

    A distinct count cannot be added up, a set can: ``models`` numbers the models (model_key, number);
    ``seen`` and ``right`` are the models of one ``word`` of 64 that gave the answer, and were right by it.
    Stored votes merge by sums and ORs. A response without model counts, but belongs to no set.
    """
    bit = F.expr("shiftleft(1L, cast(number % 64 as int))")
    numbered = enriched.where(F.col("temperature") == 0).join(models, "model_key", "left")
    word = F.floor(F.col("number") / WORD)
    return numbered.groupBy("question_id", *ATTRIBUTES, "ai_answer", "is_valid_format", word.alias("word")).agg(
        *_counts(), F.bit_or(bit).alias("seen"), F.bit_or(F.when(F.col("ai_correct"), bit)).alias("right")
    )


def insights_of(votes: DataFrame) -> DataFrame:
    """``question_insights`` from stored ``question_votes``."""
    placed = votes.repartition("question_id")
    sets = (
        placed.groupBy("question_id", "word")
        .agg(F.bit_or("seen").alias("seen"), F.bit_or("right").alias("right"))
        .groupBy("question_id")
        .agg(
            F.sum(F.coalesce(F.bit_count("seen"), F.lit(0))).alias("n_models"),
            F.sum(F.coalesce(F.bit_count("right"), F.lit(0))).alias("n_models_correct_once"),
        )
    )
    is_right = F.col("ai_answer") == F.col("correct_answer")
    per_answer = Window.partitionBy("question_id", "is_valid_format", "ai_answer", "is_right")
    ballot = F.when(F.col("is_valid_format"), F.struct((-F.col("votes")).alias("votes"), "ai_answer"))
    flagged = placed.withColumn("is_right", is_right).withColumn("votes", F.sum("n").over(per_answer))
    questions = flagged.withColumn("ballot", ballot).groupBy("question_id").agg(*_question_measures())
    # Null-safe, since responses without a question id are one question too.
    named = sets.withColumnRenamed("question_id", "_question")
    return _insights(questions.join(named, F.col("question_id").eqNullSafe(F.col("_question"))))


def _question_measures(attributes=ATTRIBUTES):
    return [
        *(F.any_value(c, True).alias(c) for c in attributes),
        *_sums("n", "n_correct"),
        F.min("ballot").alias("winner"),
        F.min(F.when(~F.col("is_right"), F.col("ballot"))).alias("decoy"),
    ]


def question_insights(enriched: DataFrame) -> DataFrame:
    """Success, majority vote and traps per question, over all temperature-0 responses.

    Responses are first counted per question, model and answer, so a question that dominates the
    table is reduced where it is read. What follows works on at most (models x options) rows per
    question, all windows sharing one shuffle on the question. The question attributes ride along as
    grouping keys because picking one of several texts would need a sort of the responses. Equal vote
    counts go to the alphabetically first answer.
    """
    return _insights(_per_question(enriched, ATTRIBUTES))


def question_insights_of(graded: DataFrame, questions: DataFrame) -> DataFrame:
    """``question_insights`` of the responses that ``enrich_responses`` would join, joined last.

    Counts carry the answer alone; the texts of a question meet one row per question. A question listed
    several times would give each of its responses as often, so its counts are multiplied. Questions are
    shuffled before one is picked per identifier, since that sorts them and a file may be one task.
    """
    counted = _per_question(graded, ("correct_answer",))
    told = [c for c in ATTRIBUTES if c != "correct_answer"]
    described = (
        questions.select("question_id", *told)
        .repartition("question_id")
        .groupBy("question_id")
        .agg(*(F.any_value(c, True).alias(c) for c in told), F.count("*").alias("copies"))
    )
    copies = F.col("copies")
    joined = counted.join(described, "question_id")
    return _insights(
        joined.withColumns(
            {c: F.col(c) * copies for c in ("n", "n_correct")}
            | {c: F.col(c).withField("votes", F.col(f"{c}.votes") * copies) for c in ("winner", "decoy")}
        )
    )


def _per_question(responses: DataFrame, attributes) -> DataFrame:
    """One row of counts per question of the temperature-0 responses, with some of its attributes."""
    cells = (
        responses.where(F.col("temperature") == 0)
        .groupBy("question_id", *attributes, "model_key", "ai_answer", "is_valid_format")
        .agg(*_counts())
    )

    per_model = Window.partitionBy("question_id", "model_key")
    in_model = per_model.orderBy("is_valid_format", "ai_answer")
    is_right = F.col("ai_answer") == F.col("correct_answer")
    per_answer = Window.partitionBy("question_id", "is_valid_format", "ai_answer", "is_right")
    flagged = (
        # One shuffle of the reduced rows serves both windows and the last aggregation.
        cells.repartition("question_id")
        .withColumn("is_right", is_right)
        .withColumns(
            {
                "model_rows": F.row_number().over(in_model),
                "model_right": F.sum("n_correct").over(per_model),
                "votes": F.sum("n").over(per_answer),
            }
        )
        .withColumns(
            {
                "counts_model": (F.col("model_rows") == 1) & F.col("model_key").isNotNull(),
                "ballot": F.when(F.col("is_valid_format"), F.struct((-F.col("votes")).alias("votes"), "ai_answer")),
            }
        )
    )
    return flagged.groupBy("question_id").agg(
        *_question_measures(attributes),
        F.count_if("counts_model").alias("n_models"),
        F.count_if(F.col("counts_model") & (F.col("model_right") > 0)).alias("n_models_correct_once"),
    )


def _insights(questions: DataFrame) -> DataFrame:
    """The table from one row of counts per question."""
    n, right = F.col("n"), F.col("n_correct")
    success = ratio(right, n)
    majority, decoy_votes = F.col("winner.ai_answer"), F.coalesce(-F.col("decoy.votes"), F.lit(0))

    def by_success(easy, medium, hard):
        return (
            F.when(success >= F.lit(2.0) / F.lit(3.0), easy)
            .when(success >= F.lit(1.0) / F.lit(3.0), medium)
            .otherwise(hard)
        )

    return questions.select(
        "question_id",
        *ATTRIBUTES,
        "n_models",
        n.alias("n_answers"),
        right.alias("n_correct"),
        round_to(success, 4).alias("success_rate"),
        by_success("easy", "medium", "hard").alias("ai_difficulty"),
        by_success(1, 2, 3).alias("ai_difficulty_level"),
        "n_models_correct_once",
        majority.alias("majority_answer"),
        (-F.col("winner.votes")).alias("majority_votes"),
        F.coalesce(majority == F.col("correct_answer"), F.lit(False)).alias("is_majority_correct"),
        F.col("decoy.ai_answer").alias("top_wrong_answer"),
        decoy_votes.alias("top_wrong_votes"),
        (right == 0).alias("is_all_wrong"),
        (right == n).alias("is_all_correct"),
        ((right == 0) & (decoy_votes * 2 >= n)).alias("is_common_trap"),
    )


MART_BUILDERS = {
    "mart_leaderboard": leaderboard,
    "mart_model_profile": model_profile,
    "mart_prompt_format": prompt_format,
    "mart_temperature_effect": temperature_effect,
    "mart_perf_by_category": perf_by_category,
    "mart_perf_by_difficulty": perf_by_difficulty,
    "mart_position_bias": position_bias,
    "mart_question_insights": question_insights,
}
FROM_COUNTS = (
    "mart_model_profile",
    "mart_prompt_format",
    "mart_perf_by_category",
    "mart_perf_by_difficulty",
    "mart_position_bias",
)
