"""Publishing builds of the tables without a gap.

Every build is written into databases of its own and never touched again. One manifest row, written
last, makes it the current one: readers that ask for a snapshot see all tables of one build or all of
another. Views under the layer's own name are switched after that, one by one, for SQL users; builds
older than those to keep are dropped last.
"""

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from askgauge.plans import warehouse
from askgauge.schemas import MARTS

MANIFEST = "build string, silver string, gold string"


@dataclass(frozen=True)
class Snapshot:
    """The tables of one build, whatever is published meanwhile."""

    spark: SparkSession
    build: str
    silver: str
    gold: str

    def load(self, name: str) -> DataFrame:
        return warehouse.load_mart(self.spark, name, self.gold)


def _manifest_path(spark: SparkSession, layer: str) -> str:
    """Beside the layer's tables, in the warehouse that all executors share."""
    return f"{spark.catalog.getDatabase(layer).locationUri}/_builds"


def published(spark: SparkSession, layer: str = warehouse.GOLD, most: int | None = None) -> list[Snapshot]:
    """Published builds that are still there, newest first; at most ``most`` of them reach the driver."""
    if not spark.catalog.databaseExists(layer):
        return []
    try:
        manifest = spark.read.schema(MANIFEST).json(_manifest_path(spark, layer))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    rows = manifest.orderBy(F.desc("build"))
    return [Snapshot(spark, *row) for row in (rows if most is None else rows.limit(most)).collect()]


def snapshot(spark: SparkSession, layer: str = warehouse.GOLD) -> Snapshot:
    """The build published last; its tables belong together."""
    newest = published(spark, layer, 1)
    if not newest:
        raise warehouse.MartMissing(f"nothing has been published in {layer}")
    return newest[0]


def publish(
    spark: SparkSession,
    questions: DataFrame,
    responses: DataFrame | None,
    layer: str = warehouse.GOLD,
    keep: int = 2,
    **options,
) -> Snapshot:
    """Build all tables anew and make them the current ones; ``options`` are those of ``warehouse.build``.

    A build that fails is dropped and leaves the published one as it is. ``keep`` builds stay, so a
    query that started on the one before can end. Two publishers at a time do not disturb each other's
    tables; the later one to start is the current one.
    """
    if keep < 1:
        raise ValueError("the current build has to be kept")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    build = f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    made = Snapshot(spark, build, f"{layer}_silver_{build}", f"{layer}_gold_{build}")
    try:
        warehouse.build(spark, questions, responses, made.silver, made.gold, **options)
    except BaseException:
        _drop(spark, made)
        raise
    row = spark.createDataFrame([(build, made.silver, made.gold)], MANIFEST).coalesce(1)
    row.write.mode("append").json(_manifest_path(spark, layer))
    for name in MARTS:
        spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS SELECT * FROM {made.gold}.{name}")
    retire(spark, layer, keep)
    return made


def retire(spark: SparkSession, layer: str = warehouse.GOLD, keep: int = 2) -> list[str]:
    """Drop all published builds but the newest ``keep``; returns those dropped."""
    old = [made for made in published(spark, layer)[keep:] if spark.catalog.databaseExists(made.gold)]
    for made in old:
        _drop(spark, made)
    return [made.build for made in old]


def _drop(spark: SparkSession, made: Snapshot) -> None:
    for database in (made.gold, made.silver):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
