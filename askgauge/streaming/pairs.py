"""Cold answers meet hot ones as they arrive: a join of two streams with state that expires.

Either side waits for the other for a stated time and is forgotten behind the watermark. A micro-batch's
pairs are counted per model and difficulty where they are joined, so what is stored is a few rows per
batch, in a partition of the batch's own number: a batch that comes again overwrites itself.

Unlike the batch table, which counts pairs without building them, a join of streams builds each pair once:
a question that a model answered c times cold and h times hot within the waiting time costs c * h rows.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from askgauge.plans.marts import DESCRIBED, PAIR_SUMS, temperature_rates

PAIR = ("model_key", "question_id")
JUDGED = ("ai_position", "ai_correct", "is_valid_format", "temperature")
# All that is read of an answer: files that are written for the pairing alone need no more.
READ = (*PAIR, *JUDGED, *DESCRIBED, "label_style", "created_at")


def _side(enriched: DataFrame, hot: bool, delay: str) -> DataFrame:
    """Narrow rows of one side, under names of its own, with their event time."""
    prefix = "hot" if hot else "cold"
    wanted = F.col("temperature") > 0 if hot else F.col("temperature") == 0
    rows = enriched.where((F.col("label_style") == "letters") & wanted).dropna(subset=[*PAIR, "created_at"])
    # The description of a pair is that of its cold answer.
    described = () if hot else DESCRIBED
    return rows.select(
        *(F.col(c).alias(f"{prefix}_{c}") for c in PAIR + JUDGED),
        *described,
        F.col("created_at").cast("timestamp").alias(f"{prefix}_time"),
    ).withWatermark(f"{prefix}_time", delay)


def pair_stream(cold: DataFrame, hot: DataFrame, within: str, delay: str) -> DataFrame:
    """Every cold answer with each hot one of the same model and question at most ``within`` before or after it.

    ``cold`` and ``hot`` are streams of graded answers joined to their questions; the same files read twice
    will do. Rows ``delay`` or more behind the newest are late and dropped; answers without a time, a model or
    a question have no partner. An unknown position equals an unknown position, as in the batch table.
    """
    left, right = _side(cold, False, delay), _side(hot, True, delay)
    wait = F.expr(f"INTERVAL {within}")
    matched = (
        (F.col("cold_model_key") == F.col("hot_model_key"))
        & (F.col("cold_question_id") == F.col("hot_question_id"))
        & (F.col("hot_time") >= F.col("cold_time") - wait)
        & (F.col("hot_time") <= F.col("cold_time") + wait)
    )
    return left.join(right, matched, "inner")


def count_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs counted per model and difficulty, as ``marts.temperature_rates`` takes them."""

    def true(name):
        return F.coalesce(F.col(name), F.lit(False))

    right = {side: true(f"{side}_ai_correct") for side in ("cold", "hot")}
    counted = {
        "pairs": F.lit(True),
        "cold_right": right["cold"],
        "hot_right": right["hot"],
        "cold_valid": true("cold_is_valid_format"),
        "hot_valid": true("hot_is_valid_format"),
        "same": F.col("cold_ai_position").eqNullSafe(F.col("hot_ai_position")),
        "lost": right["cold"] & ~right["hot"],
        "gained": ~right["cold"] & right["hot"],
    }
    return pairs.groupBy(F.col("cold_model_key").alias("model_key"), *DESCRIBED).agg(
        F.min("cold_temperature").alias("cold_t"),
        F.min("hot_temperature").alias("hot_t"),
        *(F.count_if(counted[name]).alias(name) for name in PAIR_SUMS),
    )


def start_pairing(pairs: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Count the pairs of all files not read yet under ``sink`` and stop; a later run goes on with the state."""

    def store(batch: DataFrame, number: int) -> None:
        count_pairs(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return (
        pairs.writeStream.foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def paired_effect(spark: SparkSession, sink: str, with_grouping_id: bool = False) -> DataFrame:
    """The temperature table from the pairs counted so far."""
    return temperature_rates(spark.read.parquet(sink), with_grouping_id)
