"""Builds published while they are read, and search by index."""

import threading

import pytest
from pyspark.sql import functions as F

from askgauge.operators.search import TextIndex
from askgauge.plans import publish, warehouse
from askgauge.schemas import CLEAN_QUESTIONS, MARTS
from askgauge.sources import derived, files
from conftest import plan_of


@pytest.fixture(scope="module")
def silver(spark, sf_dir, tmp_path_factory):
    home = tmp_path_factory.mktemp("published")
    files.write_clean_questions(derived.questions(spark, sf_dir), f"{home}/questions")
    files.append_responses(derived.responses(spark, sf_dir), f"{home}/responses")
    return files.read_clean_questions(spark, f"{home}/questions"), files.read_responses(spark, f"{home}/responses")


def answers(table, name):
    column = {"mart_leaderboard": "n_questions", "mart_question_insights": "n_answers"}[name]
    return table.agg(F.sum(column)).first()[0]


def test_readers_see_one_build_or_the_other(spark, silver):
    questions, responses = silver
    fewer = responses.where("run_order <= 8")
    layer = "pub_gold"
    with pytest.raises(warehouse.MartMissing):
        publish.snapshot(spark, layer)
    first = publish.publish(spark, questions, responses, layer, keep=2)
    seen, problems, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                now = publish.snapshot(spark, layer)
                by_run = answers(now.load("mart_leaderboard"), "mart_leaderboard")
                by_question = answers(now.load("mart_question_insights"), "mart_question_insights")
                seen.append((by_run, by_question, spark.table(f"{layer}.mart_leaderboard").count()))
            except Exception as problem:  # noqa: BLE001
                problems.append(problem)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        second = publish.publish(spark, questions, fewer, layer, keep=2)
    finally:
        done.set()
        reader.join()
    assert problems == [] and seen

    def of(build):
        return tuple(answers(build.load(name), name) for name in ("mart_leaderboard", "mart_question_insights"))

    assert of(first) != of(second) and {(a, b) for a, b, _ in seen} <= {of(first), of(second)}
    assert publish.snapshot(spark, layer).build == second.build != first.build
    assert answers(first.load("mart_leaderboard"), "mart_leaderboard") == responses.count()  # kept for running readers
    assert publish.retire(spark, layer, keep=1) == [first.build] and publish.retire(spark, layer, keep=1) == []
    with pytest.raises(warehouse.MartMissing):
        first.load(MARTS[0])
    assert {t.name for t in spark.catalog.listTables(layer) if not t.isTemporary} == set(MARTS)
    assert spark.table(f"{layer}.mart_leaderboard").count() == second.load("mart_leaderboard").count()


def test_failed_build_changes_nothing(spark, silver):
    questions, responses = silver
    broken = responses.withColumn("raw_response", F.raise_error(F.lit("broken file")).cast("string"))
    with pytest.raises(Exception, match="broken file"):
        publish.publish(spark, questions, broken, "pub_broken")
    assert publish.published(spark, "pub_broken") == []
    assert [d.name for d in spark.catalog.listDatabases() if d.name.startswith("pub_broken_")] == []
    with pytest.raises(ValueError):
        publish.publish(spark, questions, responses, "pub_broken", keep=0)


# --- Search ---

TEXTS = [
    (1, "What is the SMALL print?"), (2, "smallest of all"), (3, "a 50% share_of it"), (4, "Élan vital, ÉTÉ"), (5, ""),
    (6, None), (7, "ab"), (8, "日本語の質問"), (9, "all small, all smaller"), (9, "all small, all smaller"), (10, "sma mal all"),
    (None, "small without a key"),
]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    texts = spark.createDataFrame(TEXTS, "id int, body string")
    return texts, TextIndex.build(texts, "id", "body", f"{tmp_path_factory.mktemp('index')}/i")


@pytest.mark.parametrize("term", ["small", "SMALL", "all s", "50%", "e_o", "été", "本語の", "ab", "", "zzz", "smallzzz", "sma mal", "aaa"])
def test_search_equals_the_scan(indexed, term):
    texts, index = indexed
    want = sorted(i for i, t in TEXTS if i and t is not None and term.lower() in t.lower())
    got = sorted(r.id for r in index.search(texts.where("id IS NOT NULL"), "id", "body", term).collect())
    assert got == want


def test_search_on_given_questions(spark, sf_dir, tmp_path):
    questions = derived.questions(spark, sf_dir).select("question_id", "question").persist()
    index = TextIndex.build(questions, "question_id", "question", f"{tmp_path}/i")
    texts = [(r.question_id, r.question) for r in questions.collect()]
    terms = [t[k % 20 : k % 20 + 3 + k % 9] for k, (_, t) in enumerate(texts[:25])]
    for term in terms:
        want = sorted(i for i, t in texts if term.lower() in t.lower())
        assert sorted(r.question_id for r in index.search(questions, "question_id", "question", term).collect()) == want


def test_only_the_lists_of_the_rarest_trigrams_are_read(spark, indexed):
    texts, index = indexed
    plan = plan_of(index.candidates("smaller"))
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(gram" in plan and "body" not in plan
    assert len(index.rarest("smaller")) == 4 and index.rarest("smallx") is None
    empty = TextIndex.build(texts.limit(0), "id", "body", f"{index.path}-none")
    assert CLEAN_QUESTIONS and empty.search(texts, "id", "body", "small").count() == 0
