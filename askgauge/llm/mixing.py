"""Mixing sources to target weights by Poisson replication, with built-in functions only.

Each source gets a mean repetition rate: its share of the target over its share of the corpus. Every
document draws its number of copies by inverting a Poisson distribution of that mean at a number
hashed from seed and id, is exploded by it, and all copies are shuffled by another hash.
"""

from pyspark.sql import Column, DataFrame, functions as F

from askgauge.llm.common import unused, written

SEED = 20
# A mean above this is drawn as the sum of equal smaller ones, so that the inverted table stays short.
MEAN_PER_DRAW = 16.0
# The probability of more copies in one draw, 1e-30 at that mean, is below what 52 hashed bits can tell.
MOST_PER_DRAW = 90


def hashed_unit(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the parts, null as empty text."""
    key = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def rates(
    docs: DataFrame,
    weights: dict | None = None,
    default_weight: float = 1.0,
    budget: float = 1.0,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(source, size, rate, draws, cdf) per source: size in characters, mean copies of a document.

    ``weights`` are relative; a source they do not name has ``default_weight``. The target is
    ``budget`` times the size of the corpus. Sources without characters keep rate 1. A null source
    is a source of its own.
    """
    weight = F.lit(float(default_weight))
    for name, w in sorted((weights or {}).items()):
        weight = F.when(F.col("source") == name, float(w)).otherwise(weight)
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0)).cast("bigint")).alias("size")
    )
    weighed = written(sizes.withColumn("weight", weight), "mixing-sizes")
    totals = weighed.where("size > 0").agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    rate = F.lit(1.0)
    if totals["weight"]:
        share = F.col("weight") / F.lit(float(totals["weight"]))
        target = share * (float(budget) * F.lit(float(totals["size"])) / F.col("size"))
        rate = F.when(F.col("size") > 0, target).otherwise(1.0)
    rated = weighed.withColumn("rate", rate)
    rated = rated.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN_PER_DRAW)).cast("int"))
    mean_each = F.col("rate") / F.col("draws")
    none = F.array().cast("array<double>")
    start = F.struct(F.exp(-mean_each).alias("term"), F.lit(0.0).alias("sum"), none.alias("cdf"))

    def add(acc, k):
        total = acc["sum"] + acc["term"]
        return F.struct(
            (acc["term"] * mean_each / (k + 1)).alias("term"),
            total.alias("sum"),
            F.concat(acc["cdf"], F.array(total)).alias("cdf"),
        )

    steps = F.sequence(F.lit(0), F.lit(MOST_PER_DRAW))
    cdf = F.aggregate(steps, start, add, lambda acc: acc["cdf"])
    return rated.select("source", "size", "rate", "draws", cdf.alias("cdf"))


def copies(doc_id: Column, draws: Column, cdf: Column, seed: int) -> Column:
    """How often a document is repeated: the inverted distribution at each hashed number, summed."""

    def one(j):
        at = hashed_unit(F.lit(seed), doc_id, j)
        return F.size(F.filter(cdf, lambda p: p < at))

    return F.aggregate(F.transform(F.sequence(F.lit(1), draws), one), F.lit(0), lambda a, n: a + n)


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    default_weight: float = 1.0,
    budget: float = 1.0,
    seed: int = SEED,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every document as often as it is drawn, with ``copy`` (from 1) and ``shuffle_key``, shuffled globally.

    The draw depends on seed and id alone, so it is the same at every size and file layout, and rows
    that share an id are drawn alike. Rows without id draw as the empty id. A copy goes to the
    partition its key hashes to and partitions are ordered by key, so a source that holds a third of
    all rows is spread like any other. Input columns named like an output give way to it. An empty
    table gives an empty table.
    """
    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    # One row per source, read back as files: broadcast by their size, joined by shuffle beyond it.
    table = written(rates(docs, weights, default_weight, budget, source, text), "mixing-rates")
    theirs, draws, cdf, n = (unused(docs, name) for name in ("their_source", "draws", "cdf", "n"))
    table = table.select(F.col("source").alias(theirs), F.col("draws").alias(draws), F.col("cdf").alias(cdf))
    drawn = docs.select(*kept).join(table, F.col(source).eqNullSafe(F.col(theirs)))
    number = copies(F.col(doc_id), F.col(draws), F.col(cdf), seed)
    drawn = drawn.select(*kept, number.alias(n)).where(F.col(n) > 0)
    repeated = drawn.select(*kept, F.explode(F.sequence(F.lit(1), F.col(n))).alias("copy"))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "copy"))
    return (
        repeated.withColumn("shuffle_key", key)
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )


def oracle(seed: int = SEED, documents: str = "documents", columns: str = "doc_id, source, copy, shuffle_key") -> str:
    """The same draw in DuckDB SQL, for equal weights and a budget of 1."""
    return f"""
WITH RECURSIVE sizes AS (
    SELECT source, sum(coalesce(length(text), 0))::BIGINT AS size FROM {documents} GROUP BY source),
totals AS (SELECT sum(size)::BIGINT AS total, count(*)::DOUBLE AS weights FROM sizes WHERE size > 0),
rated AS (
    SELECT source, CASE WHEN size > 0 THEN (1.0::DOUBLE / weights) * (total::DOUBLE / size) ELSE 1.0::DOUBLE END AS rate
    FROM sizes LEFT JOIN totals ON true),
means AS (
    SELECT source, greatest(1, ceil(rate / {MEAN_PER_DRAW}::DOUBLE))::INT AS draws,
        rate / greatest(1, ceil(rate / {MEAN_PER_DRAW}::DOUBLE)) AS mean FROM rated),
poisson(source, draws, mean, k, term, cdf) AS (
    SELECT source, draws, mean, 0, exp(-mean), exp(-mean) FROM means
    UNION ALL
    SELECT source, draws, mean, k + 1, term * mean / (k + 1), cdf + term * mean / (k + 1)
    FROM poisson WHERE k < {MOST_PER_DRAW}),
listed AS (SELECT source, any_value(draws) AS draws, list(cdf ORDER BY k) AS cdf FROM poisson GROUP BY source),
drawn AS (
    SELECT d.*, list_sum(list_transform(range(1, draws + 1), lambda j: len(list_filter(cdf, lambda p: p < (
        ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || j), 1, 13))::BIGINT + 0.5)
        / 4503599627370496::DOUBLE))))::BIGINT AS n
    FROM {documents} d JOIN listed l ON d.source IS NOT DISTINCT FROM l.source),
repeated AS (SELECT *, unnest(range(1, n + 1))::INT AS copy FROM drawn),
mixed AS (
    SELECT *, md5('{seed}|order|' || coalesce(doc_id::VARCHAR, '') || '|' || copy) AS shuffle_key FROM repeated)
SELECT {columns} FROM mixed"""
