"""State that expires: pairs are forgotten behind the watermark, late rows are counted, the state stays bounded."""

import pytest
from pyspark.sql import functions as F

from askgauge.sources import files
from askgauge.streaming import grading
from askgauge.schemas import RESPONSES

FIELDS = {f.name: None for f in RESPONSES} | {"label_style": "letters", "prompt_version": "v1_letters"}


def response(spark, *rows):
    """Rows of (question, hour, answer) of one run."""
    made = [
        tuple((FIELDS | {"run_id": "r", "question_id": q, "raw_response": a, "created_at": f"2024-05-{1 + h // 24:02d}T{h % 24:02d}:00:00"}).values())
        for q, h, a in rows
    ]
    return spark.createDataFrame(made, RESPONSES)


@pytest.fixture
def send(spark, tmp_path):
    """Lands a file, grades what is new, and returns the batches."""
    with grading.StateLog(spark) as log:

        def run(*rows):
            files.append_responses(response(spark, *rows).coalesce(1), f"{tmp_path}/in")
            paths = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/progress"
            query = grading.start_grading(spark, *paths, watermark="3 hours")
            query.awaitTermination()
            return log.of(query)

        run.accepted = lambda: sorted(
            (r["question_id"], r["hour"]) for r in spark.read.parquet(f"{tmp_path}/out").select(
                "question_id", ((F.dayofmonth("created_at") - 1) * 24 + F.hour("created_at")).alias("hour")
            ).collect()
        )
        yield run


def late(batches):
    return sum(b.n_late for b in batches)


def test_repeats_late_rows_and_forgotten_pairs(send):
    assert late(send(("a", 10, "A"), ("b", 10, "B"))) == 0
    assert late(send(("a", 11, "B"), ("c", 8, "A"))) == 0  # a repeat is dropped, but not late; c is within the delay
    assert send.accepted() == [("a", 10), ("b", 10), ("c", 8)]
    assert late(send(("d", 20, "A"))) == 0  # the clock goes to 17 h: all before is forgotten
    assert late(send(("a", 12, "A"), ("e", 16, "A"), ("f", 18, "A"))) == 2
    assert send.accepted() == [("a", 10), ("b", 10), ("c", 8), ("d", 20), ("f", 18)]
    assert late(send(("a", 19, "A"), ("d", 19, "A"))) == 0  # a is accepted again, d still is a repeat
    assert send.accepted() == [("a", 10), ("a", 19), ("b", 10), ("c", 8), ("d", 20), ("f", 18)]


def test_the_state_stays_bounded(send):
    held, forgotten = [], 0
    for day in range(5):
        batches = send(*((f"q{day}-{i}", 24 * day, "A") for i in range(50)))
        held.append(batches[-1].n_held)
        forgotten += sum(b.n_forgotten for b in batches)
    assert max(held) == held[-1] == 50 and forgotten == 200
    assert len(send.accepted()) == 250 and batches[-1].watermark.startswith("2024-05-04T21:00")


def test_a_query_that_has_not_ended_is_not_waited_for_without_end(spark):
    class Running:
        runId = "no such run"

    with grading.StateLog(spark) as log, pytest.raises(TimeoutError):
        log.of(Running, seconds=0.1)
