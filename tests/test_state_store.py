"""The state of graded streams: pairs on disk instead of the heap, set for the stream alone."""

import os

import pytest
from pyspark.sql import functions as F

from askgauge.catalogue import ORACLES, QUERIES
from askgauge.settings import ROCKS_DB, UNCOUNTED
from askgauge.sources import derived, files
from askgauge.streaming import grading, tables
from oracle_compare import compare, connect

PROVIDER = next(name for name in ROCKS_DB if name.endswith("providerClass"))


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("state"))
    files.append_responses(derived.responses(spark, sf_dir).limit(200), f"{path}/responses")
    derived.staged_questions(spark, sf_dir).write.parquet(f"{path}/questions")
    return path


def provider_of(checkpoint):
    """What a stream noted down when it started."""
    with open(f"{checkpoint}/offsets/0") as noted:
        return next(word for word in noted.read().split('"') if word.endswith("StateStoreProvider"))


@pytest.mark.parametrize("watermark", [None, "20000 days"])
def test_graded_streams_hold_pairs_on_disk(spark, landed, tmp_path, watermark):
    """F4, F8, F10: the session's own store stays as it was."""
    before = {name: spark.conf.get(name, None) for name in ROCKS_DB | UNCOUNTED}
    grading.start_grading(spark, f"{landed}/responses", f"{tmp_path}/out", f"{tmp_path}/progress", watermark).awaitTermination()
    assert provider_of(f"{tmp_path}/progress") == ROCKS_DB[PROVIDER]
    assert {name: spark.conf.get(name, None) for name in before} == before
    assert spark.read.parquet(f"{tmp_path}/out").count() == 200


def test_counting_streams_hold_pairs_on_disk(spark, landed, tmp_path):
    """F1, F2, F5, F9."""
    store = tables.CountStore(spark, f"{tmp_path}/counts")
    questions = spark.read.parquet(f"{landed}/questions")
    tables.start_counting(spark, f"{landed}/responses", questions, store, f"{tmp_path}/progress").awaitTermination()
    assert provider_of(f"{tmp_path}/progress") == ROCKS_DB[PROVIDER]
    assert store.responses().count() == 200


def test_models_are_named_by_the_counts(spark, sf_dir, tmp_path):
    """new models are numbered on, one without answers in a batch keeps its number."""
    store, joined = tables.CountStore(spark, str(tmp_path)), derived.enriched_responses(spark, sf_dir).cache()
    known = joined.withColumn("model_key", F.when(F.col("model_key") != "m0", F.col("model_key")))
    store.add(0, known.where("model_key IS NULL OR model_key = 'm2'"))
    store.add(1, known.where("model_key <> 'm2'"))
    assert sorted(store.models([0, 1]).collect()) == [("m1", 1), ("m2", 0), ("m3", 2)]


def test_halves_sent_again(spark, sf_dir, tmp_path):
    """answers before the middle of the period, which the given tables have none of, land twice more; no copy is kept beside."""
    shifted = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_shipdate") - F.expr("INTERVAL 1500 DAYS")).otherwise(F.col("l_shipdate"))
    for name in ("part", "lineitem"):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (rows if name == "part" else rows.withColumn("l_shipdate", shifted)).write.parquet(f"{tmp_path}/{name}.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    kept = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    con = connect(sf_dir)
    con.execute(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    n, problems, *_ = compare(spark, con, QUERIES["grade_stream_expiring"], ORACLES["grade_stream_expiring"], str(tmp_path))
    assert problems == [] and n > 14
    (made,) = set(os.listdir(shared)) - kept
    assert sorted(os.listdir(f"{shared}/{made}")) == ["graded", "progress", "responses"]
