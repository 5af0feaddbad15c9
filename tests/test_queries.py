"""Every registered query against its DuckDB statement.

The evaluation tables and reports read the enriched responses from a file written once, itself
checked by the queries before them, so that they are not derived again dozens of times.
"""

import pytest

import __spark_entry__ as entry_points
from askgauge.catalogue import ORACLES, QUERIES
from askgauge.sources import derived
from oracle_compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry_reads_the_smoke_tables(spark):
    assert entry_points.entry(spark).count() == 16


@pytest.fixture(scope="module")
def written(spark, sf_dir, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('enriched')}/table"
    derived.enriched_responses(spark, sf_dir).write.parquet(path)
    return path


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, written, monkeypatch, name):
    if name != "enriched":
        monkeypatch.setattr(derived, "enriched_responses", lambda spark, _: spark.read.parquet(written))
    n, problems, *_ = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
    assert problems == []
    assert n > 0
