"""Evaluation tables that follow the response stream.

A micro-batch is graded and joined once and leaves its counts behind: one small table per kind of count,
in a partition of its own number. All counts can be added up, so the eight tables are made from their
sums and no response is graded or counted twice. A batch is seen from the moment its number is in the
ledger, which is written last; a batch that comes again, or comes again after a failure, overwrites its
own partitions or is passed over, so it adds nothing.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from askgauge.operators.enrich import enrich_responses
from askgauge.plans import marts
from askgauge.schemas import ENRICHED_COLUMNS
from askgauge.settings import DROP_SHUFFLES, NO_WIDE_SORTS, settings
from askgauge.sources.files import COMPRESSED
from askgauge.streaming.grading import grade_stream, response_stream, state_settings

COMPACT_AFTER = 32  # batches in sight after which they are added up into one

# How the rows of each kind of count add up: keys, and an aggregate per measure.
_SUM = {name: F.sum for name in ("n", "n_correct", "n_valid")}
KINDS = {
    "cells": (marts.CELL, {name: F.sum for name in marts.MEASURES}),
    "times": ((*marts.RUN, "bucket", "bucket_range", "response_time_s"), {name: F.sum for name in marts.RUN_SUMS}),
    "buckets": ((*marts.RUN, "bucket"), {name: F.sum for name in marts.RUN_SUMS}),
    "pairs": (
        ("model_key", "question_id", "hot", *marts.DESCRIBED, "ai_position"),
        _SUM | {"temperature": F.min},
    ),
    "votes": (
        ("question_id", *marts.ATTRIBUTES, "ai_answer", "is_valid_format", "word"),
        _SUM | {"seen": F.bit_or, "right": F.bit_or},
    ),
}


def add_up(kind: str, rows: DataFrame) -> DataFrame:
    """Counts of one kind, one row per key."""
    keys, measures = KINDS[kind]
    return rows.groupBy(*keys).agg(*(add(name).alias(name) for name, add in measures.items()))


class CountStore:
    """Counts of all batches under one path that every executor reaches.

    ``responses/batch=n`` holds what a batch graded and joined, ``models/batch=n`` the models it met
    first, ``<kind>/batch=n`` its counts, ``ledger/batch=n`` that it is complete. A compaction is a batch
    below zero that stands for all batches up to ``upto``. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, name: str, batch: int | None = None) -> str:
        return f"{self.path}/{name}" + ("" if batch is None else f"/batch={batch}")

    def _exists(self, folder: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return hadoop, hadoop.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def ledger(self) -> tuple[list[int], int]:
        """The batches in sight, and the last one that a compaction stands for (-1 before any).

        The ledger has a row per batch since the last compaction, so it stays short.
        """
        hadoop, files = self._exists(self._folder("ledger"))
        if not files.exists(hadoop):
            return [], -1
        schema = StructType.fromDDL("batch bigint, upto bigint")
        rows = [(r["batch"], r["upto"]) for r in self.spark.read.schema(schema).parquet(self._folder("ledger")).collect()]
        upto = max((u for _, u in rows if u is not None), default=-1)
        return sorted(b for b, u in rows if b > upto or u == upto and u is not None), upto

    def knows(self, batch: int) -> bool:
        seen, upto = self.ledger()
        return batch <= upto or batch in seen

    def _write(self, df: DataFrame, name: str, batch: int, by=()) -> None:
        df.write.mode("overwrite").options(**COMPRESSED).partitionBy(*by).parquet(self._folder(name, batch))

    def _finish(self, batch: int, upto: int | None) -> None:
        row = self.spark.createDataFrame([(upto,)], "upto bigint")
        row.coalesce(1).write.mode("overwrite").parquet(self._folder("ledger", batch))

    def _rows(self, name: str, seen: list[int]) -> DataFrame:
        """Stored rows of the batches in sight; partitions of others are never read."""
        return self.spark.read.parquet(self._folder(name)).where(F.col("batch").isin(seen))

    def models(self, seen: list[int]) -> DataFrame | None:
        return self._rows("models", seen).select("model_key", "number") if seen else None

    def _new_models(self, rows: DataFrame, known: DataFrame | None) -> DataFrame:
        """Models not met before, numbered on from the known ones."""
        met = rows.where("model_key is not null").select("model_key").distinct()
        first = 0
        if known is not None:
            met = met.join(known, "model_key", "left_anti")
            first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        # One row per model that is new: a short list.
        place = F.row_number().over(Window.orderBy("model_key")) - 1
        return met.select("model_key", (place + F.lit(first)).cast("bigint").alias("number"))

    def add(self, batch: int, enriched: DataFrame) -> bool:
        """Count a batch of joined responses; False, and nothing done, if it is counted already."""
        seen, upto = self.ledger()
        if batch <= upto or batch in seen:
            return False
        with settings(self.spark, DROP_SHUFFLES):
            self._write(enriched.select(*ENRICHED_COLUMNS), "responses", batch)
            rows = self.spark.read.parquet(self._folder("responses", batch))
            self._write(marts.count_responses(rows), "cells", batch)
            known = self.models(seen)
            cells = self.spark.read.parquet(self._folder("cells", batch))  # they name every model that answered
            self._write(self._new_models(cells, known), "models", batch)
            fresh = self.spark.read.parquet(self._folder("models", batch))
            models = fresh if known is None else known.unionByName(fresh)
            self._write(marts.run_times(rows), "times", batch, ("bucket_range",))
            self._write(marts.run_buckets(self.spark.read.parquet(self._folder("times", batch))), "buckets", batch)
            self._write(marts.temperature_cells(rows), "pairs", batch)
            self._write(marts.question_votes(rows, models), "votes", batch)
            self._finish(batch, None)
        if len(seen) + 1 > COMPACT_AFTER:
            self.compact()
        return True

    def compact(self) -> None:
        """Add the batches in sight up into one; their partitions are dropped once the new one stands for them."""
        seen, upto = self.ledger()
        last = max(seen, default=-1)
        if len(seen) < 2:
            return
        batch = -2 - last
        with settings(self.spark, DROP_SHUFFLES):
            self._write(self.models(seen), "models", batch)
            for kind in KINDS:
                by = ("bucket_range",) if kind == "times" else ()
                self._write(add_up(kind, self._rows(kind, seen)), kind, batch, by)
        self._finish(batch, last)
        for name in ("models", *KINDS, "ledger"):  # the responses stay: they are the silver table
            for old in seen:
                hadoop, files = self._exists(self._folder(name, old))
                files.delete(hadoop, True)

    def counts(self, kind: str) -> DataFrame:
        """The stored counts of one kind, added up over all batches in sight."""
        return add_up(kind, self._rows(kind, self.ledger()[0]))

    def responses(self) -> DataFrame:
        """All graded and joined responses of complete batches, each with its ``batch``."""
        seen, upto = self.ledger()
        batch = F.col("batch")
        done = (batch <= upto) | batch.isin([b for b in seen if b >= 0])
        return self.spark.read.parquet(self._folder("responses")).where(done)

    def tables(self) -> dict[str, DataFrame]:
        """The eight evaluation tables, from counts alone."""
        cells = self.counts("cells")
        made = {name: marts.MART_BUILDERS[name](cells) for name in marts.FROM_COUNTS}
        # Stored times are added up below the ranges that are read, so the rest stays unread.
        times = self._rows("times", self.ledger()[0])
        made["mart_leaderboard"] = marts.leaderboard_of(self.counts("buckets"), times)
        made["mart_temperature_effect"] = marts.temperature_effect_of(self.counts("pairs"))
        made["mart_question_insights"] = marts.insights_of(self.counts("votes"))
        return made


def start_counting(
    spark: SparkSession,
    source: str,
    questions: DataFrame,
    store: CountStore,
    checkpoint: str,
    watermark: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Grade and count every response file not counted yet, batch by batch, and stop.

    ``questions`` are the staged questions; each batch joins them as they are then.
    """
    graded = grade_stream(response_stream(spark, source, max_files), watermark)
    with settings(spark, state_settings(watermark), DROP_SHUFFLES, NO_WIDE_SORTS):
        return (
            graded.writeStream.foreachBatch(lambda batch, number: store.add(number, enrich_responses(batch, questions)) and None)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
