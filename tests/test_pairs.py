"""Cold and hot answers joined as streams, against the batch table."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from askgauge.plans import marts
from askgauge.streaming import grading, pairs
from test_follow import same
from test_marts import SCHEMA as JOINED

SCHEMA = StructType(list(JOINED.fields)).add("created_at", TimestampNTZType())
START = datetime.datetime(2024, 5, 1)
BLANK = {f.name: None for f in SCHEMA} | {"label_style": "letters", "model_name": "M", "model_params_b": 1.0, "prompt_version": "v"}


def answer(question, hour, temperature, right=True, model="m", **more):
    made = BLANK | {
        "model_key": model, "question_id": question, "temperature": temperature, "ai_correct": right, "is_valid_format": right,
        "ai_position": 1 if right else None, "difficulty": "easy", "difficulty_level": 1,
        "created_at": START + datetime.timedelta(hours=hour),
    }
    return tuple((made | more).values())


@pytest.fixture
def send(spark, tmp_path):
    """Lands a file and joins what is new; returns the batches."""
    with grading.StateLog(spark) as log:

        def run(rows, within="2 hours", delay="1 hour", max_files=1):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            sides = [spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", max_files).parquet(f"{tmp_path}/in") for _ in "ch"]
            query = pairs.start_pairing(pairs.pair_stream(*sides, within, delay), f"{tmp_path}/out", f"{tmp_path}/progress")
            query.awaitTermination()
            return log.of(query)

        run.table = lambda: pairs.paired_effect(spark, f"{tmp_path}/out")
        run.counted = lambda: spark.read.parquet(f"{tmp_path}/out").agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
        run.all = lambda: spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in")
        yield run


def test_any_order_of_arrival_gives_the_batch_table(send):
    """Repeated answers, unknown positions, models without partner, other styles and missing keys, dealt out at random."""
    chance = random.Random(3)
    rows = [
        answer(f"q{i % 17}", chance.randrange(500), t, chance.random() < 0.6, f"m{i % 3}")
        for i in range(150)
        for t in ((0.0, 0.7) if i % 5 else (0.0,))
    ]
    rows += [answer("q1", 3, None), answer(None, 3, 0.0), answer("q1", 3, 0.0, model=None), answer("q1", 3, 1.0, label_style="text")]
    rows += [answer("q2", 7, 0.0, None, difficulty=None, difficulty_level=None), answer("alone", 1, 0.0, model="cold only")]
    chance.shuffle(rows)
    for k in range(3):
        send(rows[k::3], within="40 days", delay="40 days")
    same(send.table(), marts.temperature_effect(send.all()))


def test_partners_wait_no_longer_than_stated(send):
    send([answer("a", 0, 0.0), answer("b", 0, 0.0)])
    assert send.counted() == 0
    send([answer("a", 2, 0.7), answer("b", 3, 0.7)])  # exactly as long as is waited for, and one hour over it
    assert send.counted() == 1
    send([answer("c", 20, 0.0), answer("c", 20, 0.7)])  # both sides are past a and b
    # Exactly the delay behind is late.
    batches = send([answer("a", 0, 0.7), answer("c", 19, 0.0), answer("c", 19.5, 0.0)])
    assert sum(b.n_late for b in batches) == 2 and send.counted() == 3


def test_the_state_stays_bounded(send):
    held = []
    for day in range(4):
        batches = send([answer(f"q{day}-{i}", 24 * day, t) for i in range(20) for t in (0.0, 0.7)])
        held.append(batches[-1].n_held)
    assert max(held) <= 40 and send.counted() == 80
    same(send.table(), marts.temperature_effect(send.all()))


def test_a_batch_that_comes_again_overwrites_itself(spark, send, tmp_path):
    send([answer("a", 0, 0.0), answer("a", 1, 0.7)])
    commits = tmp_path / "progress" / "commits"
    written = {p.name for p in (tmp_path / "out").glob("batch=*")}
    for done in [*commits.glob("[0-9]*"), *commits.glob(".[0-9]*")]:
        done.unlink()  # as if the driver was lost before it noted what it had written
    batches = send([answer("b", 0, 0.0), answer("b", 1, 0.7)])
    # The batch of the first file runs again with its own number.
    assert {f"batch={b.batch}" for b in batches} & written and send.counted() == 2
