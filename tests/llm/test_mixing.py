import math

from pyspark.sql import functions as F

from askgauge.llm import mixing, queries
from oracle_compare import compare, connect


def corpus(spark, n=4_000):
    rows = [(i, "x" * (10 + i % 7), "big" if i % 4 else "small") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def sizes(df):
    return {r["source"]: r["s"] for r in df.groupBy("source").agg(F.sum(F.length("text")).alias("s")).collect()}


def test_sources_reach_their_weights(spark):
    docs = corpus(spark)
    total = sum(sizes(docs).values())
    mixed = sizes(mixing.mix(docs, {"big": 1, "small": 3}, budget=2.0))
    assert abs(mixed["small"] / (2 * total) - 0.75) < 0.03
    assert abs(mixed["big"] / (2 * total) - 0.25) < 0.03


def test_counts_follow_the_distribution(spark):
    docs = corpus(spark, 6_000).withColumn("source", F.lit("one"))
    drawn = mixing.mix(docs, budget=1.5).groupBy("doc_id").count().groupBy("count").agg(F.count("*").alias("n"))
    found = {r["count"]: r["n"] for r in drawn.collect()}
    for k in range(1, 5):
        want = 6_000 * math.exp(-1.5) * 1.5**k / math.factorial(k)
        assert abs(found[k] - want) < 5 * math.sqrt(want)


def test_large_means_are_split_into_draws(spark):
    rows = [(i, "x", "rare") for i in range(200)] + [(1_000 + i, "x" * 200, "rest") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rate = mixing.rates(docs, {"rare": 99, "rest": 1}).where("source = 'rare'").first()
    assert rate["rate"] > mixing.MEAN_PER_DRAW and rate["draws"] > 1
    n = mixing.mix(docs, {"rare": 99, "rest": 1}).where("source = 'rare'").count()
    assert abs(n - 200 * rate["rate"]) < 6 * math.sqrt(200 * rate["rate"])


def test_every_copy_is_whole_and_numbered(spark):
    docs = corpus(spark, 500)
    got = mixing.mix(docs, budget=3.0)
    assert got.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    rows = got.collect()
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows) == len({r["shuffle_key"] for r in rows})
    assert all(len(r["text"]) == 10 + r["doc_id"] % 7 for r in rows)
    again = mixing.mix(docs.repartition(7), budget=3.0).collect()
    assert {(r["doc_id"], r["copy"]) for r in again} == {(r["doc_id"], r["copy"]) for r in rows}


def test_awkward_tables(spark):
    rows = [(1, None, None, "k"), (2, "", "a", "k"), (3, "xx", "b", "k"), (3, "xx", "b", "k"), (None, "yy", "b", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, Copy string")
    got = mixing.mix(df, budget=5.0)
    assert got.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    counts = {(r["doc_id"], r["source"]): r["n"] for r in got.groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    assert counts[(3, "b")] % 2 == 0
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.where("source = 'a'")).count() >= 0


def test_clashing_names(spark):
    rows = [(i, "xx" * (i % 7 + 1), "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = ("draws", "cdf", "n", "their_source", "size", "rate", "__source", "__n")
    extra = df.withColumns({name: F.lit(f"own {name}") for name in names})
    got = mixing.mix(extra, budget=2.0).collect()
    plain = mixing.mix(df, budget=2.0).collect()
    assert sorted((r["doc_id"], r["copy"]) for r in got) == sorted((r["doc_id"], r["copy"]) for r in plain)
    assert all(r[name] == f"own {name}" for r in got for name in names)


def test_query_equals_sql(spark, sf_dir):
    n, problems, *_ = compare(
        spark, connect(sf_dir), queries.QUERIES["op3_poisson_mix"], queries.ORACLES["op3_poisson_mix"], sf_dir
    )
    assert n > 100 and problems == []
