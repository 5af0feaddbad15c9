"""What the pairing of two streams writes before it starts."""

from askgauge import catalogue
from askgauge.streaming import pairs


def test_files_for_the_pairing_hold_what_it_reads(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "scratch", lambda _: str(tmp_path))
    made = catalogue.QUERIES["paired_temperature_effect"](spark, sf_dir)
    theirs = catalogue.QUERIES["temperature_effect"](spark, sf_dir)
    assert sorted(map(str, made.collect())) == sorted(map(str, theirs.select(*made.columns).collect()))
    for name in ("all", "answers"):
        written = spark.read.parquet(f"{tmp_path}/{name}")
        assert sorted(written.columns) == sorted(pairs.READ)
    assert spark.read.parquet(f"{tmp_path}/all").count() == catalogue.QUERIES["enriched"](spark, sf_dir).count()
