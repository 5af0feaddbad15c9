"""Every capability as a named query over the given tables, with its DuckDB counterpart."""

import uuid
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Observation, functions as F

from askgauge.functions.metrics import ratio, round_to, wilson_high, wilson_low
from askgauge.functions.text import clean_text, tidy_spaces
from askgauge.operators import cleaning, prompting, quality
from askgauge.operators.enrich import answer_options, enrich_responses
from askgauge.operators.scoring import lenient_letter
from askgauge.operators.search import TextIndex
from askgauge.oracles import ORACLES
from askgauge.plans import marts, publish, reports, warehouse
from askgauge.schemas import CLEAN_QUESTIONS, DIFFICULTY_LEVELS, ENRICHED_COLUMNS
from askgauge.sources import derived, files
from askgauge.streaming import follow_up, grading, pairs, tables

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def scratch(spark):
    """A new folder that every executor reaches: where the session keeps checkpoints, else in its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{shared}/askgauge-{uuid.uuid4().hex}"


class Tables:
    """The evaluation tables of one source directory, each planned on first use."""

    def __init__(self, spark, sf_dir):
        self.graded = derived.graded_responses(spark, sf_dir)
        self.questions = derived.staged_questions(spark, sf_dir)
        self.enriched = enrich_responses(self.graded, self.questions)
        self._made = {}

    @cached_property
    def question_insights(self):
        return marts.question_insights_of(self.graded, self.questions)

    @cached_property
    def scores(self):
        """The leaderboard for reports that do not show its quantile, which costs a second scan."""
        return marts.leaderboard(self.enriched, quantile=None)

    def __getattr__(self, name):
        if name not in self._made:
            self._made[name] = marts.MART_BUILDERS[f"mart_{name}"](self.enriched)
        return self._made[name]


# --- Contracts and cleaning ---


@query
def contract_bronze(spark, sf_dir):
    return quality.check_raw_questions(derived.faulty_raw_questions(spark, sf_dir))


@query
def contract_silver(spark, sf_dir):
    return quality.check_clean_questions(derived.faulty_clean_questions(spark, sf_dir))


@query
def contract_read_back(spark, sf_dir):
    """The contract on the question file: written, counted while it is written, and read again."""
    path, sent = f"{scratch(spark)}/questions", Observation()
    clean = derived.questions(spark, sf_dir).observe(sent, F.count("*").alias("n"))
    files.write_clean_questions(clean, path)
    return quality.check_written_questions(files.read_clean_questions(spark, path), sent.get["n"])


def _apart(spark, rows, conditions):
    """Rows judged while they are written, read again with the checks they fail."""
    path = f"{scratch(spark)}/judged"
    quality.write_apart(rows, conditions, path)
    return quality.read_apart(spark, path, rows.schema)


@query
def contract_silver_while_writing(spark, sf_dir):
    """The silver contract judged in the pass that writes the rows; the same report."""
    conditions = quality.clean_question_conditions()
    written = _apart(spark, derived.faulty_clean_questions(spark, sf_dir), conditions)
    return quality.check_written_apart(written, conditions, "silver", quality.unique_question_check())


@query
def quarantined_questions(spark, sf_dir):
    """Collected questions set aside while they are written, with the checks each one fails."""
    written = _apart(spark, derived.faulty_raw_questions(spark, sf_dir), quality.raw_question_conditions())
    refused = quality.refused_rows(written)
    return refused.withColumn("failed_checks", F.concat_ws(",", "failed_checks")).drop("incorrect_answers")


@query
def accepted_questions(spark, sf_dir):
    """Clean questions from a collection in which some break the contract: those are left behind."""
    path = scratch(spark)
    collected = derived.faulty_raw_questions(spark, sf_dir)
    collected.write.options(header=True, quote='"', escape='"').csv(f"{path}/raw")
    accepted, _ = warehouse.build_accepted_questions(files.read_raw_questions(spark, f"{path}/raw"), path, spark)
    return accepted.groupBy("type", "difficulty", "category").agg(F.count("*").alias("n_questions"))


# --- Files written and read again ---


@query
def raw_question_file(spark, sf_dir):
    path = f"{scratch(spark)}/raw"
    files.write_raw_questions(derived.question_rows(spark, sf_dir), path)
    return files.read_raw_questions(spark, path).drop(*files.ORDER_COLUMNS)


@query
def first_collected(spark, sf_dir):
    """Captured pages read back, the first questions in the order they were collected."""
    path = f"{scratch(spark)}/pages"
    derived.api_pages(spark, sf_dir, in_order=True).write.text(path)
    return files.read_api_pages(spark, path, n_questions=150)


@query
def page_file(spark, sf_dir):
    path = f"{scratch(spark)}/pages"
    derived.api_pages(spark, sf_dir).write.text(path)
    return files.read_api_pages(spark, path)


@query
def clean_question_file(spark, sf_dir):
    path = f"{scratch(spark)}/questions"
    files.write_clean_questions(derived.questions(spark, sf_dir), path)
    return files.read_clean_questions(spark, path)


@query
def run_config_file(spark, sf_dir):
    """The configuration file and a selection of its runs."""
    path = f"{scratch(spark)}/runs"
    derived.run_config(spark, sf_dir).write.options(header=True, quote='"', escape='"').csv(path)
    return files.read_run_config(spark, path, run_orders=range(1, 13))


@query
def prompt_set_file(spark, sf_dir):
    path = f"{scratch(spark)}/prompts"
    derived.prompt_set(spark, sf_dir).write.options(header=True, quote='"', escape='"').csv(path)
    return files.read_prompt_set(spark, path)


@query
def response_file(spark, sf_dir):
    """Response parts of limited size."""
    path = f"{scratch(spark)}/responses"
    files.append_responses(derived.responses(spark, sf_dir), path, batch_size=10_000)
    return files.read_responses(spark, path)


@query
def answered_pairs_file(spark, sf_dir):
    path = f"{scratch(spark)}/responses"
    files.append_responses(derived.responses(spark, sf_dir), path)
    return files.answered_pairs(spark, path)


def _built(spark, sf_dir):
    """The name of a gold layer that was built anew."""
    layer = uuid.uuid4().hex
    names = {"silver": f"silver_{layer}", "gold": f"gold_{layer}"}
    warehouse.build(spark, derived.questions(spark, sf_dir).drop("seq"), derived.responses(spark, sf_dir), **names)
    return names["gold"]


@query
def built_leaderboard(spark, sf_dir):
    """All layers built as tables, and one of them loaded by its name."""
    return warehouse.load_mart(spark, "mart_leaderboard", _built(spark, sf_dir))


def _buckets(spark):
    """A database of its own for bucketed tables, and their number of buckets."""
    return f"buckets_{uuid.uuid4().hex}", max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _bucketed(spark, sf_dir):
    """Silver tables bucketed by question, in a database of their own; its name."""
    silver, n = _buckets(spark)
    questions = derived.questions(spark, sf_dir).drop("seq")
    warehouse.build_silver(spark, questions, derived.responses(spark, sf_dir), silver, buckets=n)
    return silver


@query
def bucketed_enriched(spark, sf_dir):
    """Grades joined to their questions from tables bucketed by question."""
    return warehouse.columns_of(spark.table(f"{_bucketed(spark, sf_dir)}.int_responses_enriched"), ENRICHED_COLUMNS)


@query
def bucketed_question_insights(spark, sf_dir):
    return marts.question_insights(spark.table(f"{_bucketed(spark, sf_dir)}.int_responses_enriched"))


@query
def bucketed_resume(spark, sf_dir):
    """Work not answered yet, from the answered pairs bucketed by run and question.

    Of the silver tables only the pairs are built: no answer is graded for a work list.
    """
    silver, n = _buckets(spark)
    answered = spark.table(warehouse.build_answered_pairs(spark, derived.responses(spark, sf_dir), silver, n))
    questions = derived.questions(spark, sf_dir).select("question_id")
    runs = derived.run_config(spark, sf_dir).select("run_id", "sample_seed")
    return prompting.remaining_work(prompting.work_list(runs, questions), answered)


@query
def published_leaderboard(spark, sf_dir):
    """All layers built as a version of their own, published, and one table loaded from the snapshot."""
    layer = f"published_{uuid.uuid4().hex}"
    questions = derived.questions(spark, sf_dir).select(*CLEAN_QUESTIONS.fieldNames())
    publish.publish(spark, questions, derived.responses(spark, sf_dir), layer)
    return publish.snapshot(spark, layer).load("mart_leaderboard")


@query
def built_tables(spark, sf_dir):
    """The tables that a build leaves in the gold layer, and how many rows each has."""
    gold = _built(spark, sf_dir)
    made = [
        warehouse.load_mart(spark, name, gold).agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"))
        for name in sorted(warehouse.available_marts(spark, gold))
    ]
    return reduce(DataFrame.unionByName, made)


@query
def clean_text_documents(spark, sf_dir):
    documents = derived.table(spark, sf_dir, "documents")
    return documents.select("doc_id", "lang", tidy_spaces(F.col("text")).alias("clean_text"))


@query
def clean_html_pages(spark, sf_dir):
    pages = derived.table(spark, sf_dir, "pages")
    return pages.select("page_id", clean_text(F.col("html")).alias("clean_html"))


@query
def flatten_api_pages(spark, sf_dir):
    pages = files.parse_pages(derived.api_pages(spark, sf_dir), "body")
    return files.flatten_pages(pages)


@query
def category_split(spark, sf_dir):
    return cleaning.derive_attributes(derived.question_rows(spark, sf_dir)).select(
        "seq", "category", "category_group", "category_name", "difficulty_level", "nb_options"
    )


@query
def question_ids_dedup(spark, sf_dir):
    raw = derived.repeated_raw_questions(spark, sf_dir)
    return cleaning.clean_questions(raw, "seq")


@query
def duplicate_groups(spark, sf_dir):
    identified = cleaning.derive_attributes(cleaning.clean_texts(derived.repeated_raw_questions(spark, sf_dir)))
    return cleaning.duplicate_rows(identified, "question_id").select(
        "question_id", "seq", "category", "question", "correct_answer"
    ).orderBy("question_id", "seq")


@query
def duplicate_summary(spark, sf_dir):
    identified = cleaning.derive_attributes(cleaning.clean_texts(derived.repeated_raw_questions(spark, sf_dir)))
    return cleaning.duplicate_summary(identified, "question_id")


# --- Samples, work lists, prompts ---


@query
def seeded_permutation(spark, sf_dir):
    questions = derived.questions(spark, sf_dir).select("question_id")
    return prompting.seeded_permutation(questions, seeds=(7, derived.SAMPLE_SEED))


@query
def seeded_sample(spark, sf_dir):
    questions = derived.questions(spark, sf_dir).select("question_id", "difficulty")
    return prompting.seeded_permutation(questions, seeds=(derived.SAMPLE_SEED,), n=150)


@query
def first_questions_by_id(spark, sf_dir):
    questions = derived.questions(spark, sf_dir).select("question_id", "question")
    return prompting.first_by_id(questions, 120)


@query
def resume_work_list(spark, sf_dir):
    questions = derived.questions(spark, sf_dir).select("question_id")
    runs = derived.run_config(spark, sf_dir).select("run_id", "sample_seed")
    work = prompting.work_list(runs, questions)
    return prompting.remaining_work(work, derived.responses(spark, sf_dir))


@query
def resume_on_triple_key(spark, sf_dir):
    """Answers of the second half of the period, minus what was answered before, on three keys."""
    asked = derived.responses(spark, sf_dir).select(
        "question_id", F.col("model_key").alias("model"), "prompt_version", "created_at"
    )
    done = asked.where(F.col("created_at") < derived.MID_PERIOD)
    keys = ("question_id", "model", "prompt_version")
    return prompting.remaining_work(asked, done, keys).select(*keys)


@query
def build_choices(spark, sf_dir):
    questions = derived.questions(spark, sf_dir)
    choices = prompting.build_choices(
        F.col("question_id"), F.col("type"), F.col("correct_answer"), F.col("incorrect_answers")
    )
    with_choices = questions.withColumn("choices", choices)
    return with_choices.select(
        "question_id",
        "choices",
        *(
            prompting.correct_label(F.col("choices"), F.col("correct_answer"), F.lit(style)).alias(f"{style}_label")
            for style in ("letters", "numbers", "text")
        ),
        prompting.render_options(F.col("choices"), F.lit("letters"), mark=") ").alias("listing"),
    )


@query
def render_prompts(spark, sf_dir):
    return derived.responses(spark, sf_dir).select(
        "run_id",
        "question_id",
        "choices",
        "correct_label",
        "system_prompt",
        "user_prompt",
        prompting.prompt_text(F.col("system_prompt"), F.col("user_prompt")).alias("prompt_text"),
    )


@query
def run_summary(spark, sf_dir):
    """Follow-up of a second session: what was answered before the middle of the period is resumed."""
    graded = derived.graded_responses(spark, sf_dir)
    middle = F.to_timestamp_ntz(F.lit(derived.MID_PERIOD))
    runs = derived.run_config(spark, sf_dir)
    # The first model has one prompt with nothing left to do; its other runs answer all they are asked.
    old, finished = F.col("created_at") < middle, F.col("run_id") == "m0__v1_letters"
    asked = graded.where(F.col("model_key") == "m0").select("run_id", "question_id")
    questions = derived.questions(spark, sf_dir).select("question_id")
    others = runs.where(F.col("model_key") != "m0").select("run_id", "sample_seed")
    listed = prompting.work_list(others, questions).select("run_id", "question_id")
    todo = prompting.remaining_work(asked.unionByName(listed), graded.where(old | finished))
    return prompting.run_summary(runs, todo, graded.where(~old & ~finished), missing_models=("lab/model-3",))


@query
def trial_summary(spark, sf_dir):
    answers = derived.trial_answers(spark, sf_dir)
    return prompting.trial_summary(answers, derived.trial_work(answers))


@query
def followed_trials(spark, sf_dir):
    """The same outcomes reported by a stream: on the last answer of a run, or when it has been silent for a day."""
    base = scratch(spark)
    derived.trial_answers(spark, sf_dir).write.parquet(f"{base}/all")
    answers = spark.read.parquet(f"{base}/all")
    derived.trial_work(answers).write.parquet(f"{base}/work")
    early = F.year("created_at") < 1995
    # An answer of another run, much later, moves the clock past every silence.
    later = answers.limit(1).withColumns({"run_id": F.lit("later"), "created_at": F.to_timestamp_ntz(F.lit("2100-01-01"))})
    work = spark.read.parquet(f"{base}/work")
    options = {"silence": "1 day", "delay": "20000 days"}
    for part in (answers.where(early), answers.where(~early), later):  # every run goes on where the last one stopped
        part.write.mode("append").parquet(f"{base}/answers")
        stream = spark.readStream.schema(answers.schema).parquet(f"{base}/answers")
        follow_up.start_following(spark, stream, work, f"{base}/reports", f"{base}/progress", **options).awaitTermination()
    return follow_up.latest_reports(spark.read.parquet(f"{base}/reports"))


@query
def projected_minutes(spark, sf_dir):
    staged = derived.staged_responses(spark, sf_dir)
    return prompting.projected_minutes(staged, derived.run_config(spark, sf_dir), n_questions=1000)


@query
def one_run_per_model(spark, sf_dir):
    return prompting.one_run_per_model(derived.run_config(spark, sf_dir), "v3_text")


@query
def invalid_examples(spark, sf_dir):
    return prompting.invalid_examples(derived.graded_responses(spark, sf_dir), 5)


# --- Staging, grading, joining ---

QUERIES["stage_questions"] = derived.staged_questions
QUERIES["stage_responses"] = derived.staged_responses
QUERIES["grade_responses"] = derived.graded_responses
QUERIES["enriched"] = derived.enriched_responses


@query
def lenient_letters(spark, sf_dir):
    answers = derived.chatty_answers(spark, sf_dir).groupBy("raw", "nb", "structured").agg(F.count("*").alias("n"))
    return answers.withColumn("letter", lenient_letter(F.col("raw"), F.col("nb"), F.col("structured")))


@query
def answer_option_table(spark, sf_dir):
    return answer_options(derived.staged_questions(spark, sf_dir))


@query
def grade_stream(spark, sf_dir):
    """Response files graded by a stream, then read back."""
    return _streamed(spark, sf_dir)


@query
def grade_stream_watermarked(spark, sf_dir):
    """The same with state that is cleared; the delay covers the period of the responses."""
    return _streamed(spark, sf_dir, "20000 days")


@query
def grade_stream_expiring(spark, sf_dir):
    """Accepted responses per year, and those too late to be judged, with a state that forgets after 30 days.

    The responses arrive in two halves, then all of the first half once more, each as it was and again
    dated 20 years later. By then the old pairs are forgotten: as they were they are too late, and what
    carries a new date is accepted again.
    """
    base = scratch(spark)
    sent, old = derived.responses(spark, sf_dir), F.col("created_at") < derived.MID_PERIOD
    year = F.substring("created_at", 1, 4).cast("int")
    again = F.concat((year + 20).cast("string"), F.substring("created_at", 5, 15))

    def once_more():
        """The first half as it has landed: it is not derived again, nor kept in a copy beside."""
        landed = files.read_responses(spark, f"{base}/responses").where(old)
        return landed.withColumn("created_at", F.explode(F.array("created_at", again)))

    late = 0
    with grading.StateLog(spark) as log:
        for part in (lambda: sent.where(old), lambda: sent.where(~old), once_more):  # every run goes on where the last one stopped
            files.append_responses(part(), f"{base}/responses")
            stream = grading.start_grading(spark, f"{base}/responses", f"{base}/graded", f"{base}/progress", "30 days")
            stream.awaitTermination()
            late += sum(b.n_late for b in log.of(stream))
    graded = spark.read.parquet(f"{base}/graded")
    accepted = graded.groupBy(F.year("created_at").alias("year")).agg(F.count("*").alias("n"))
    dropped = spark.range(1).select(F.lit(None).cast("int").alias("year"), F.lit(late).cast("bigint").alias("n"))
    return accepted.unionByName(dropped)


def _streamed(spark, sf_dir, watermark=None):
    base = scratch(spark)
    files.append_responses(derived.responses(spark, sf_dir), f"{base}/responses")
    stream = grading.start_grading(spark, f"{base}/responses", f"{base}/graded", f"{base}/progress", watermark)
    stream.awaitTermination()
    return spark.read.parquet(f"{base}/graded")


# --- Evaluation tables that follow the stream ---


def _followed(name):
    def build(spark, sf_dir):
        """Response files counted batch by batch, one batch a second time; the table from stored counts."""
        base = scratch(spark)
        files.append_responses(derived.responses(spark, sf_dir), f"{base}/responses")
        derived.staged_questions(spark, sf_dir).write.parquet(f"{base}/questions")
        questions, store = spark.read.parquet(f"{base}/questions"), tables.CountStore(spark, f"{base}/counts")
        # A third of the files per batch, however many the responses fill.
        third = -(-len(files.read_responses(spark, f"{base}/responses").inputFiles()) // 3)
        options = {"max_files": third}
        tables.start_counting(spark, f"{base}/responses", questions, store, f"{base}/progress", **options).awaitTermination()
        store.add(store.ledger()[0][0], store.responses())
        return store.tables()[f"mart_{name}"]

    return build


for _name in ("leaderboard", "question_insights", "temperature_effect", "prompt_format"):
    QUERIES[f"followed_{_name}"] = _followed(_name)


@query
def paired_temperature_effect(spark, sf_dir):
    """Cold and hot answers joined as two streams; the hot ones arrive first, and the period is waited for."""
    base = scratch(spark)
    derived.enriched_responses(spark, sf_dir).select(*pairs.READ).write.parquet(f"{base}/all")
    answers = spark.read.parquet(f"{base}/all")
    for part in ("temperature > 0", "temperature = 0"):
        answers.where(part).write.mode("append").parquet(f"{base}/answers")
        cold, hot = (spark.readStream.schema(answers.schema).parquet(f"{base}/answers") for _ in range(2))
        paired = pairs.pair_stream(cold, hot, "20000 days", "20000 days")
        pairs.start_pairing(paired, f"{base}/pairs", f"{base}/progress").awaitTermination()
    return pairs.paired_effect(spark, f"{base}/pairs")


# --- Evaluation tables ---


def _mart(name):
    return lambda spark, sf_dir: getattr(Tables(spark, sf_dir), name)


for _name in marts.MART_BUILDERS:
    _short = _name.removeprefix("mart_")
    QUERIES[_short] = _mart(_short)


@query
def quality_by_source(spark, sf_dir):
    """The same interval on human labels: share of good documents per source."""
    documents = derived.table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = derived.table(spark, sf_dir, "labels").select("doc_id", "quality")
    good, n = F.col("n_good"), F.col("n_labelled")
    return (
        labels.join(documents, "doc_id")
        .groupBy("source")
        .agg(F.count("*").alias("n_labelled"), F.sum("quality").alias("n_good"))
        .select(
            "source",
            n,
            good,
            round_to(ratio(good, n), 4).alias("share_good"),
            round_to(wilson_low(good, n), 4).alias("ci_low"),
            round_to(wilson_high(good, n), 4).alias("ci_high"),
        )
    )


# --- Reports ---


def report(name, build):
    QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))


report("volumes", lambda t: reports.volumes(t.scores, t.question_insights))
report("leaderboard_selection", lambda t: reports.leaderboard_selection(t.leaderboard, models=("m0", "m2", "m3")))
report("winner_vs_runner_up", lambda t: reports.winner_vs_runner_up(t.scores))
report("status_shares", lambda t: reports.status_shares(t.scores))
report("profile_report", lambda t: reports.best_first(marts.model_profile(t.enriched, with_baseline=True)))
report("profile_summary", lambda t: reports.profile_summary(t.model_profile))
report("knowledge_vs_format", lambda t: reports.knowledge_vs_format(t.model_profile))
report("format_report", lambda t: reports.format_report(t.prompt_format, t.scores))
report("format_means", lambda t: reports.format_means(t.prompt_format))
report("most_format_sensitive", lambda t: reports.most_format_sensitive(t.prompt_format))
report("temperature_report", lambda t: reports.temperature_overall(t.temperature_effect, t.scores))
report(
    "temperature_extremes",
    lambda t: reports.temperature_extremes(t.temperature_effect.where(F.col("difficulty") == "all")),
)
report("temperature_by_difficulty", lambda t: reports.temperature_by_difficulty(t.temperature_effect))
report("cold_hot_long", lambda t: reports.cold_hot_long(t.temperature_effect.where(F.col("difficulty") == "all")))
report("lost_and_gained", lambda t: reports.lost_and_gained(t.temperature_effect.where(F.col("difficulty") == "all")))
report("family_rollup", lambda t: reports.family_rollup(t.perf_by_category))
report("category_order", lambda t: reports.category_order(t.perf_by_category))
report("category_wins", lambda t: reports.category_wins(t.perf_by_category))
report("strong_and_weak_categories", lambda t: reports.strong_and_weak_categories(t.perf_by_category))
report(
    "subgroup_hypothesis",
    lambda t: reports.subgroup_hypothesis(t.perf_by_category, ("ECONOMY", "STANDARD", "Nature"), "model 2"),
)
report("difficulty_drop", lambda t: reports.difficulty_drop(t.perf_by_difficulty))
report("difficulty_pivot", lambda t: reports.difficulty_pivot(t.perf_by_difficulty))
report("facet_baseline", lambda t: reports.facet_baseline(t.perf_by_difficulty))
report("strongest_bias", lambda t: reports.strongest_bias(t.position_bias))
report("true_share", lambda t: reports.true_share(t.position_bias))
report("position_shares", lambda t: reports.position_shares(t.position_bias))
report(
    "question_search",
    lambda t: reports.search_questions(
        t.question_insights, groups=("Entertainment", "Science"), difficulties=("easy", "hard"), text="SMALL"
    ),
)


@query
def question_search_indexed(spark, sf_dir):
    """The same search through a stored index of trigrams."""
    path = scratch(spark)
    Tables(spark, sf_dir).question_insights.write.parquet(f"{path}/insights")
    insights = spark.read.parquet(f"{path}/insights")
    index = TextIndex.build(insights, "question_id", "question_text", f"{path}/index")
    found = index.search(insights, "question_id", "question_text", "SMALL")
    return reports.search_questions(found, groups=("Entertainment", "Science"), difficulties=("easy", "hard"))


report("question_explorer", lambda t: reports.question_explorer(t.question_insights))
report("trap_list", lambda t: reports.trap_list(t.question_insights))
report("trap_summary", lambda t: reports.trap_summary(t.question_insights))
report("majority_vs_best", lambda t: reports.majority_vs_best(t.question_insights, t.model_profile))
report("difficulty_crosstab", lambda t: reports.difficulty_crosstab(t.question_insights))
report("success_histogram", lambda t: reports.success_histogram(t.question_insights))
report("model_display_order", lambda t: reports.display_order(t.model_profile))
report("model_fallback_order", lambda t: reports.display_order(t.position_bias, ("m3", "m1")))
report(
    "difficulty_display_order",
    lambda t: reports.ordered_values(t.temperature_effect, "difficulty", DIFFICULTY_LEVELS),
)
report(
    "dimension_labels",
    lambda t: reports.with_labels(
        t.enriched.groupBy(*reports.DIMENSION_LABELS).agg(F.count("*").alias("n"))
    ),
)
