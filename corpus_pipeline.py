"""The corpus pipeline: from raw documents to shuffled token ids, in stages that are each written and reread.

Every stage works on all rows its predecessor kept. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from askgauge.llm import bpe, decision_rules, mixing, repeats, simhash
from askgauge.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rule and the decision list learned from the labels."""
    rules = decision_rules.learn(docs, table(spark, sf_dir, "labels"))
    return decision_rules.filter_documents(docs, rules)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate component."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines and sentences that occurred before; ``n_chars`` follows."""
    cleaned = repeats.remove_repeats(docs)
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", counted).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh the same in characters, shuffled globally."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the text they decode to."""
    encoded = bpe.encode_documents(docs.select("doc_id", "source", "text"), decoded="decoded")
    return encoded.select(
        "doc_id",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Encoding has no SQL form; tests run the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
