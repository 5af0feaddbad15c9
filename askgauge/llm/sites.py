"""Document quality by hierarchical empirical Bayes over sites and paths.

A classifier gives each document a probability of being good. Hosts, and paths within hosts, have
posterior shares of good documents, from labels where there are any and the classifier elsewhere; a
site with few documents is drawn towards its parent, by as much as the spread between sites warrants.
A document's evidence and its path's posterior are then combined.
"""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from askgauge.llm import decision_rules
from askgauge.llm.common import written

MAX_LABELLED = 20_000
# A strength of prior beyond this many documents means that sites do not differ.
STRONGEST = 1e6
INPUTS = decision_rules.FEATURES


@dataclass(frozen=True)
class Classifier:
    """Logistic regression on standardised features."""

    center: tuple
    scale: tuple
    weights: tuple
    bias: float

    def probability(self) -> Column:
        z = F.lit(self.bias)
        for name, c, s, w in zip(INPUTS, self.center, self.scale, self.weights):
            z = z + F.lit(w) * (_input(name) - F.lit(c)) / F.lit(s)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def _input(name: str) -> Column:
    value = decision_rules.feature(name)
    return F.log1p(value) if name == "n_words" else value


def fit_classifier(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier:
    """Ridge-penalised logistic regression on at most ``max_labelled`` labelled documents, by hash of id.

    Without labels of both kinds it gives every document the share of good labels (one half if none).
    """
    chosen = (
        labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__quality"))
        .where(F.col("__id").isNotNull() & F.col("__quality").isNotNull())
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_labelled)
        .groupBy("__id")
        .agg(F.max("__quality").alias("good"))
    )
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    # Bounded by max_labelled.
    known = decision_rules.with_features(texts.join(F.broadcast(chosen), "__id"), "__text")
    rows = known.select(F.col("good").cast("double"), *(_input(f).alias(f) for f in INPUTS)).toPandas()
    y, x = rows["good"].to_numpy(float), rows[list(INPUTS)].to_numpy(float)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        zero = tuple(0.0 for _ in INPUTS)
        return Classifier(zero, tuple(1.0 for _ in INPUTS), zero, math.log(share / (1 - share)))
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - center) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.append(np.ones(len(INPUTS)), 1e-6)
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - ridge * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(*(tuple(map(float, v)) for v in (center, scale, w[:-1])), float(w[-1]))


def strength(rate: float, spread: float, groups: float, pairs: float) -> float:
    """Documents a prior is worth, from the spread of group rates beyond what chance explains.

    ``spread`` is the sum over groups of n times the squared distance from the parent's rate, ``groups``
    the degrees of freedom, ``pairs`` the parents' sums of n minus those of n squared over n.
    """
    chance = rate * (1 - rate)
    between = (spread - groups * chance) / pairs if pairs > 0 else 0.0
    if between <= 0 or chance <= 0:
        return STRONGEST
    return min(STRONGEST, max(0.0, chance / between - 1))


def posteriors(evidence: DataFrame) -> tuple[DataFrame, float, float, float]:
    """(host, path, n, s, host_rate) per path, the global rate, and the strengths of both priors.

    ``evidence`` has host, path and a share ``y`` of being good per document. Sums are combined before
    they are shuffled; what reaches the driver are ten totals.
    """
    paths = written(
        evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("y").alias("s")), "sites-paths"
    )
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.count("*").alias("k")
    )
    hosts = written(hosts, "sites-hosts")
    top = hosts.agg(
        F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.sum(F.col("hn") * F.col("hn")).alias("n2"), F.count("*").alias("k")
    ).first()
    if not top["n"]:
        return paths.select("*", F.lit(0.5).alias("host_rate")), 0.5, STRONGEST, STRONGEST
    rate = min(1 - 1e-6, max(1e-6, top["s"] / top["n"]))
    distance = F.col("hs") / F.col("hn") - F.lit(rate)
    spread = hosts.agg(F.sum(F.col("hn") * distance * distance).alias("d")).first()["d"]
    k_host = strength(rate, spread, top["k"] - 1, top["n"] - top["n2"] / top["n"])
    placed = paths.join(hosts, "host")
    inner = F.col("s") / F.col("n") - F.col("hs") / F.col("hn")
    within = placed.agg(F.sum(F.col("n") * inner * inner).alias("d")).first()["d"]
    sizes = hosts.agg(F.sum(F.col("k") - 1).alias("k"), F.sum(F.col("hn") - F.col("n2") / F.col("hn")).alias("p")).first()
    k_path = strength(rate, within, sizes["k"], sizes["p"])
    host_rate = (F.col("hs") + k_host * rate) / (F.col("hn") + k_host)
    return placed.select("host", "path", "n", "s", host_rate.alias("host_rate")), rate, k_host, k_path


def _logit(p: Column) -> Column:
    held = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(held / (1 - held))


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = 0.5) -> DataFrame:
    """doc_id, host, path, ``p_document``, ``host_rate``, ``path_rate``, ``quality`` and ``kept`` per document.

    ``path_rate`` leaves the document's own evidence out, so that a site of one document says nothing
    about it beyond its host. A null host or path is a site of its own, named by an empty text; a null
    text has no words and is judged by its features like any other; a label without document plays no
    part, and a document labelled both ways counts as good. Repeated rows count each and come back.
    """
    model = fit_classifier(docs, labels)
    placed = docs.select("doc_id", "text", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    scored = decision_rules.with_features(placed).select(
        "doc_id", "host", "path", model.probability().alias("p_document")
    )
    told = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").cast("double").alias("told")
    )
    evidence = written(
        scored.join(told, "doc_id", "left").withColumn("y", F.coalesce("told", "p_document")).drop("told"),
        "sites-evidence",
    )
    rated, rate, _, k_path = posteriors(evidence)
    # One row per path, read back as files: broadcast by their size, joined by shuffle beyond it.
    rated = written(rated, "sites-rated")
    joined = evidence.join(rated, ["host", "path"])
    others = (F.col("s") - F.col("y") + k_path * F.col("host_rate")) / (F.col("n") - 1 + F.lit(k_path))
    path_rate = F.when(F.col("n") - 1 + F.lit(k_path) > 0, others).otherwise(F.col("host_rate"))
    known = joined.withColumn("path_rate", path_rate)
    z = _logit(F.col("p_document")) + _logit(F.col("path_rate")) - _logit(F.lit(rate))
    return known.withColumn("quality", 1 / (1 + F.exp(-z))).select(
        "doc_id", "host", "path", "p_document", "host_rate", "path_rate", "quality", (F.col("quality") >= threshold).alias("kept")
    )
