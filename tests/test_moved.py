"""What is moved and left on disk: wide rows are written where they are made, shuffles go with the write that made them."""

import os

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from askgauge.plans import marts, warehouse
from askgauge.schemas import ENRICHED_COLUMNS
from askgauge.settings import DROP_SHUFFLES, NO_WIDE_SORTS, settings
from askgauge.sources import derived
from test_follow import same

CLEANUP = next(iter(DROP_SHUFFLES))


def files_of(spark, table):
    """Data files per folder of a table."""
    found = {}
    for file in spark.table(table).inputFiles():
        found.setdefault(os.path.dirname(file), []).append(file)
    return found


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    questions = derived.questions(spark, sf_dir).drop("seq")
    given = derived.responses(spark, sf_dir)
    landed = spark.createDataFrame(given.collect(), given.schema).repartition(3).cache()
    assert warehouse.build(spark, questions, landed, "tm_silver", "tm_gold")
    return landed


def test_rows_are_written_by_the_tasks_that_made_them(spark, built):
    """three tasks hold rows of every style and temperature; none of those are sent to another."""
    files = files_of(spark, "tm_silver.int_ai_responses_scored")
    assert len(files) == 4 and all(len(names) == 3 for names in files.values())
    assert spark.table("tm_silver.int_responses_enriched").count() == built.count()


def test_tables_are_those_of_the_joined_responses(spark, built):
    enriched = warehouse.columns_of(spark.table("tm_silver.int_responses_enriched"), ENRICHED_COLUMNS)
    for name, make in marts.MART_BUILDERS.items():
        same(warehouse.load_mart(spark, name, "tm_gold"), make(enriched))


def test_a_build_drops_its_shuffles(spark, sf_dir, monkeypatch):
    """the session's own setting is back afterwards."""
    before, seen, write = spark.conf.get(CLEANUP), [], DataFrameWriter.saveAsTable

    def noted(writer, *args, **more):
        seen.append(spark.conf.get(CLEANUP))
        return write(writer, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", noted)
    questions = derived.questions(spark, sf_dir).drop("seq")
    warehouse.build(spark, questions, derived.responses(spark, sf_dir).limit(50), "td_silver", "td_gold")
    assert len(seen) == 13 and set(seen) == {"true"} and spark.conf.get(CLEANUP) == before


def test_settings_are_put_back(spark):
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "3")
    try:
        with pytest.raises(ValueError), settings(spark, DROP_SHUFFLES, NO_WIDE_SORTS, {"askgauge.test": "x"}):
            assert all(spark.conf.get(k) == v for k, v in (DROP_SHUFFLES | NO_WIDE_SORTS).items())
            raise ValueError
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"
        assert spark.conf.get("askgauge.test", None) is None and spark.conf.get(CLEANUP, None) is None
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")


def test_many_partitions_are_written_as_before(spark):
    """More partitions than files that a task keeps open: it sorts the rest."""
    rows = spark.range(0, 4000, 1, 2).select((F.col("id") % 40).alias("k"), F.col("id").cast("string").alias("v"))
    spark.sql("CREATE DATABASE IF NOT EXISTS tm_parts")
    with settings(spark, NO_WIDE_SORTS):
        warehouse.save(rows, "tm_parts.t", ("k",), together=False)
    assert sorted(spark.table("tm_parts.t").select("k", "v").collect()) == sorted(rows.collect())
