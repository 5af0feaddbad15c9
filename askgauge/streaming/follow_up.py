"""Following trial runs while they answer: counts per run in state, and a timer for silence."""

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from askgauge.operators.prompting import trial_outcome
from askgauge.schemas import RUN_COMPLETE, RUN_INCOMPLETE

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
COUNTS = ("n_answers", "n_errors", "n_valid", "n_right")
STATE = ", ".join(f"{c} bigint" for c in (*COUNTS, "last_ms", "revision"))
REPORT = "run_id string, revision bigint, status string, " + ", ".join(f"{c} bigint" for c in COUNTS)


class RunFollowUp(StatefulProcessor):
    """One report when a run has answered all it was asked, or has been silent for ``silence_ms``.

    Answers that come after a report are counted on and reported anew, with the next revision.
    """

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("counts", STATE)

    def report(self, run_id, status, known):
        values = dict(zip((*COUNTS, "last_ms", "revision"), known))
        row = {"run_id": run_id, "revision": values["revision"], "status": status} | {c: values[c] for c in COUNTS}
        return pd.DataFrame([row])

    def handleInputRows(self, key, rows, timerValues):
        known = list(self.state.get()) if self.state.exists() else [0] * (len(COUNTS) + 2)
        todo = None
        for part in rows:  # batches of a run's new rows: summed, never held
            for i, c in enumerate(COUNTS):
                known[i] += int(part[c].sum())
            known[4] = max(known[4], int(part["last_ms"].max()))
            todo = int(part["n_todo"].max()) if part["n_todo"].notna().any() else todo
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if todo is not None and known[0] + known[1] >= todo:
            known[5] += 1
            self.state.update(tuple(known))
            yield self.report(key[0], RUN_COMPLETE, known)
        else:
            self.state.update(tuple(known))
            self.handle.registerTimer(known[4] + self.silence_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        known = list(self.state.get())
        known[5] += 1
        self.state.update(tuple(known))
        yield self.report(key[0], RUN_INCOMPLETE, known)

    def close(self):
        pass


def follow_runs(graded: DataFrame, todo: DataFrame, silence: str = "10 minutes", delay: str = "1 minute") -> DataFrame:
    """A stream of reports from a stream of graded answers with ``error`` and ``created_at``.

    ``todo`` has (run_id, n_todo), what each run was asked. The clock is the newest ``created_at`` less
    ``delay``: a run is silent once that is ``silence`` behind its last answer. What moves is a narrow row
    per answer, without its texts; the new rows of a run reach its state in chunks that are summed in turn.
    """
    spark = graded.sparkSession
    silence_ms = int(pd.Timedelta(silence).total_seconds() * 1000)
    answered = F.col("error").isNull()
    timed = graded.withColumn("event_time", F.col("created_at").cast("timestamp")).withWatermark("event_time", delay)
    # One narrow row per answer; the join side is one row per run.
    rows = timed.join(todo, "run_id", "left").select(
        "run_id",
        "event_time",
        answered.cast("bigint").alias("n_answers"),
        (~answered).cast("bigint").alias("n_errors"),
        (answered & F.col("is_valid_format")).cast("bigint").alias("n_valid"),
        (answered & F.col("ai_correct")).cast("bigint").alias("n_right"),
        F.unix_millis("event_time").alias("last_ms"),
        "n_todo",
    )
    reports = rows.groupBy("run_id").transformWithStateInPandas(
        RunFollowUp(silence_ms), outputStructType=REPORT, outputMode="Append", timeMode="eventTime"
    )
    return reports.withColumn("outcome", trial_outcome(F.col("n_answers"), F.col("n_errors")))


def start_following(
    spark: SparkSession, graded: DataFrame, todo: DataFrame, sink: str, checkpoint: str, **options
) -> StreamingQuery:
    """Report on all answers not followed yet, append the reports to ``sink`` and stop."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS_DB)  # timers need it; a query keeps the provider it was started with
    try:
        return (
            follow_runs(graded, todo, **options)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(sink)
        )
    finally:
        spark.conf.set(PROVIDER, before)


def latest_reports(reports: DataFrame) -> DataFrame:
    """The last report of every run."""
    columns = [c for c in reports.columns if c not in ("run_id", "revision")]
    last = F.max_by(F.struct(*columns), "revision").alias("last")
    return reports.groupBy("run_id").agg(last).select("run_id", "last.*")
