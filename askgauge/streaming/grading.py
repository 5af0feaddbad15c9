"""Grading response files as they arrive.

Grading is row-wise, so the batch function runs unchanged on a stream and the order of arrival has no
influence. The only state is the set of (run, question) pairs already seen. With a watermark that set is
bounded by what arrives within the delay; ``StateLog`` tells what it holds, what it forgot and how many
rows came too late to be judged against it.
"""

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from askgauge.operators.scoring import grade_responses
from askgauge.operators.staging import stage_responses
from askgauge.schemas import RESPONSES
from askgauge.settings import ROCKS_DB, UNCOUNTED, settings
from askgauge.sources.files import COMPRESSED

PAIR = ["run_id", "question_id"]


def response_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New response parts under a directory; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(RESPONSES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def grade_stream(responses: DataFrame, watermark: str | None = None) -> DataFrame:
    """Staged, de-duplicated and graded stream.

    Without a watermark every pair ever seen stays in the state store. With one, a repeat is dropped
    when it arrives within that delay of the first, and the state is cleared behind it. The columns
    and their types are those of the batch either way.
    """
    staged = stage_responses(responses)
    if watermark is None:
        return grade_responses(staged.dropDuplicates(PAIR))
    # Event time must be a timestamp; a copy is, so that the column itself stays as it was.
    timed = staged.withColumn("_event_time", staged["created_at"].cast("timestamp"))
    unique = timed.withWatermark("_event_time", watermark).dropDuplicatesWithinWatermark(PAIR)
    return grade_responses(unique.drop("_event_time"))


def state_settings(watermark: str | None) -> dict[str, str]:
    """How a graded stream keeps its pairs: on the executors' disks, counted only where some are forgotten."""
    return ROCKS_DB if watermark is not None else ROCKS_DB | UNCOUNTED


@dataclass(frozen=True)
class BatchState:
    """What one micro-batch read, dropped as too late, holds in its state and cleared from it.

    ``n_held`` is counted with a watermark only. Without one every pair accepted is held.
    """

    run_id: str
    batch: int
    n_rows: int
    n_late: int
    n_held: int
    n_forgotten: int
    watermark: str | None


class StateLog(StreamingQueryListener):
    """The state of every micro-batch that runs while this is open.

    ``with StateLog(spark) as log:`` listens to all queries of the session; ``of(query)`` waits until
    the reports of a finished query are in, since they arrive after it has ended. A batch that only
    clears state has no rows. Late rows are counted where they are dropped, so a batch that was repeated
    after a failure counts them once per successful run.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.batches = spark, []
        self._ended, self._news = set(), threading.Condition()

    def __enter__(self) -> "StateLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def of(self, query: StreamingQuery, seconds: float = 60) -> list[BatchState]:
        """All batches of a query that has ended; ``TimeoutError`` if its end is not reported in time."""
        run = str(query.runId)
        with self._news:
            if not self._news.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"the end of {run} was not reported in {seconds} s")
            return [b for b in self.batches if b.run_id == run]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p, states = event.progress, event.progress.stateOperators
        late, held, gone = (
            sum(getattr(s, name) for s in states)
            for name in ("numRowsDroppedByWatermark", "numRowsTotal", "numRowsRemoved")
        )
        made = BatchState(str(p.runId), p.batchId, p.numInputRows, late, held, gone, dict(p.eventTime).get("watermark"))
        with self._news:
            self.batches.append(made)

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()


def start_grading(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    watermark: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Grade everything not graded yet, append it to ``sink`` and stop.

    Progress is kept in ``checkpoint``: calling this again picks up only the files added since. The pairs seen
    are on the executors' disks, in bounded memory; a query keeps the state store it was first started with.
    """
    graded = grade_stream(response_stream(spark, source, max_files), watermark)
    with settings(spark, state_settings(watermark)):
        return (
            graded.writeStream.format("parquet")
            .outputMode("append")
            .options(**COMPRESSED)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(sink)
        )
