"""Runs followed by a stream with state and timers, against the batch summary."""

import datetime

from pyspark.sql import functions as F

from askgauge.operators.prompting import trial_summary
from askgauge.streaming import follow_up

SCHEMA = "run_id string, created_at timestamp_ntz, error string, is_valid_format boolean, ai_correct boolean"
START = datetime.datetime(2024, 5, 1, 12)


def answer(run, minute, error=None, valid=True, right=True):
    return run, START + datetime.timedelta(minutes=minute), error, valid, right


PARTS = [
    [answer("whole", 0), answer("whole", 1, valid=False, right=False), answer("stops", 0), answer("fails", 0, "timeout")],
    [answer("whole", 2, right=False), answer("fails", 1, "lost", right=True), answer("errors", 2, "timeout")],
    [answer("errors", 3), answer("other", 30)],  # the clock passes the silence of all others
    [answer("stops", 31), answer("other", 60)],  # an answer after the report: reported anew
    [answer("other", 90)],
]
WORK = [("whole", 3), ("stops", 5), ("fails", 2), ("errors", 3), ("unheard", 4)]


def test_reports_equal_the_batch(spark, tmp_path):
    work = spark.createDataFrame(WORK, "run_id string, n_todo long")
    for k, rows in enumerate(PARTS):  # one file, and a query that goes on where the last one stopped
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/answers")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/answers")
        paths = f"{tmp_path}/reports", f"{tmp_path}/progress"
        query = follow_up.start_following(spark, stream, work, *paths, silence="10 minutes", delay="1 minute")
        query.awaitTermination()
    reports = spark.read.parquet(f"{tmp_path}/reports").cache()
    revisions = {r["run_id"]: r["n"] for r in reports.groupBy("run_id").agg(F.count("*").alias("n")).collect()}
    assert revisions["whole"] == revisions["fails"] == revisions["errors"] == 1 and revisions["stops"] == 2
    answers = spark.read.parquet(f"{tmp_path}/answers")
    batch = trial_summary(answers, work)
    got = {r["run_id"]: r for r in follow_up.latest_reports(reports).collect()}
    want = {r["run_id"]: r for r in batch.collect()}
    for run in ("whole", "stops", "fails", "errors"):
        assert got[run].asDict() == want[run].asDict()
    assert [want[r]["outcome"] for r in ("whole", "stops", "fails", "errors", "unheard")] == [
        "OK", "OK", "aucune réponse", "erreurs", "aucune réponse"]
    assert [want[r]["status"] for r in ("whole", "stops", "fails", "errors")] == [
        "terminée", "incomplète", "terminée", "incomplète"]
    assert spark.conf.get(follow_up.PROVIDER) != follow_up.ROCKS_DB
