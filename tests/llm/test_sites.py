import numpy as np
import pytest
from pyspark.sql import functions as F

from askgauge.llm import queries, sites


def evidence(seed=1, hosts=30):
    chance = np.random.default_rng(seed)
    rows = []
    for h in range(hosts):
        share = chance.beta(6, 2)
        for p in range(1 + h % 4):
            rows += [(f"h{h}", f"p{p}", float(y)) for y in chance.random(1 + 5 * (h % 7)) < share]
    return rows


def brute(rows):
    n = len(rows)
    rate = sum(y for *_, y in rows) / n
    groups, paths = {}, {}
    for h, p, y in rows:
        groups.setdefault(h, []).append(y)
        paths.setdefault((h, p), []).append(y)
    spread = sum(len(v) * (np.mean(v) - rate) ** 2 for v in groups.values())
    k_host = sites.strength(rate, spread, len(groups) - 1, n - sum(len(v) ** 2 for v in groups.values()) / n)
    within = sum(len(v) * (np.mean(v) - np.mean(groups[h])) ** 2 for (h, _), v in paths.items())
    pairs = sum(len(v) for v in groups.values()) - sum(len(v) ** 2 / len(groups[h]) for (h, _), v in paths.items())
    k_path = sites.strength(rate, within, len(paths) - len(groups), pairs)
    host_rate = {h: (sum(v) + k_host * rate) / (len(v) + k_host) for h, v in groups.items()}
    return rate, k_host, k_path, host_rate


def test_posteriors_equal_brute_force(spark):
    rows = evidence()
    paths, rate, k_host, k_path = sites.posteriors(spark.createDataFrame(rows, "host string, path string, y double"))
    want = brute(rows)
    assert (rate, k_host, k_path) == pytest.approx(want[:3])
    for r in paths.collect():
        assert r["host_rate"] == pytest.approx(want[3][r["host"]])
    assert 1 < k_host < 100


def test_sparse_sites_shrink_and_large_ones_do_not():
    assert sites.strength(0.8, 0.0, 10, 100) == sites.STRONGEST
    assert sites.strength(0.8, 50.0, 10, 100) < sites.strength(0.8, 5.0, 10, 100)


def test_awkward_tables(spark):
    rows = [(1, None, None, None), (2, "", "a", "x"), (2, "", "a", "x"), (None, "w " * 80, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("n", F.lit(1))
    labels = spark.createDataFrame([(2, 1), (2, 0), (None, 0), (1, None), (77, 0)], "doc_id long, quality int")
    got = sites.judge(docs, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == 4
    assert all(0 < r["quality"] < 1 for r in got)
    assert sites.judge(docs.limit(0), labels, F.col("source"), F.col("lang")).count() == 0
    assert sites.judge(docs, labels.limit(0), F.col("source"), F.col("lang")).count() == 4


def test_bad_hosts_weigh_on_their_documents(spark):
    rows = [(i, f"text number{i} " * 30, f"host{i % 10}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 10 > 1)) for i in range(400) if i % 3], "doc_id long, quality int")
    got = sites.judge(docs, labels, F.col("source"), F.lit(None).cast("string")).collect()
    low = [r["path_rate"] for r in got if r["host"] in ("host0", "host1")]
    high = [r["path_rate"] for r in got if r["host"] not in ("host0", "host1")]
    assert max(low) < 0.4 < 0.9 < min(high)


def test_query(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = queries.QUERIES["op9_sites"](spark, sf_dir).collect()
    assert len(got) == n
    told = [(r["kept"], quality[r["doc_id"]]) for r in got if r["doc_id"] in quality]
    assert sum(k == bool(q) for k, q in told) > 0.95 * len(told)
    assert sum(not k for k, q in told if q == 1) <= 0.02 * len(told)
