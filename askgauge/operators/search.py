"""Literal text search through an index of trigrams.

Each text is indexed by its distinct runs of three characters in lower case. A text that contains a
term contains all trigrams of the term, so only texts listed under the term's rarest ones are looked
at, and each of those is verified by the literal test. The posting lists are sorted and partitioned by
a hash of the trigram: a search reads a few row groups, not the texts.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

GRAM = 3
BUCKETS = 64
RAREST = 4  # posting lists a search intersects


def grams(text: Column) -> Column:
    """Distinct runs of three characters of a text in lower case; none for a shorter or null text."""
    folded = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(folded) - (GRAM - 1))
    runs = F.transform(starts, lambda i: F.substring(folded, i, F.lit(GRAM)))
    return F.when(F.length(folded) >= GRAM, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def bucket_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


class TextIndex:
    """Postings (gram, id) and posting counts (gram, n) of one text column, stored under a path.

    ``id_type`` is the type of the key as Spark names it.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str):
        self.spark, self.path = spark, path
        self.schemas = {
            "postings": f"id {id_type}, gram string, bucket int",
            "counts": "gram string, n bigint, bucket int",
        }

    def _stored(self, table: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[table]).parquet(f"{self.path}/{table}")

    @classmethod
    def build(cls, texts: DataFrame, key: str, text: str, path: str) -> "TextIndex":
        """Index ``text`` by ``key``; replaces the index at ``path``.

        Rows are brought together by ranges of (bucket, gram, id), so a trigram that most texts hold is
        split over tasks and files instead of filling one. Rows without key or text are not found.
        """
        index = cls(texts.sparkSession, path, texts.schema[key].dataType.simpleString())
        postings = (
            texts.where(F.col(key).isNotNull())
            .select(F.col(key).alias("id"), F.explode(grams(F.col(text))).alias("gram"))
            .withColumn("bucket", bucket_of(F.col("gram")))
        )
        ordered = postings.repartitionByRange("bucket", "gram", "id").sortWithinPartitions("bucket", "gram", "id")
        ordered.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
        counted = index._stored("postings").groupBy("bucket", "gram").agg(F.count("*").alias("n"))
        counted.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy(
            "bucket"
        ).parquet(f"{path}/counts")
        return index

    def _read(self, table: str, wanted: list) -> DataFrame:
        """Rows of some (bucket, gram): other partitions and row groups are passed over."""
        buckets, names = {b for b, _ in wanted}, [g for _, g in wanted]
        return self._stored(table).where(F.col("bucket").isin(buckets) & F.col("gram").isin(names))

    def rarest(self, term: str) -> list | None:
        """The (bucket, gram) pairs of a term to look up, fewest postings first; None if a gram has none."""
        folded = self.spark.range(1).select(F.explode(grams(F.lit(term))).alias("gram"))
        wanted = [tuple(r) for r in folded.select(bucket_of(F.col("gram")), "gram").collect()]  # as many as the term has
        known = self._read("counts", wanted).collect()
        if len(known) < len(wanted):
            return None
        return [(r["bucket"], r["gram"]) for r in sorted(known, key=lambda r: (r["n"], r["gram"]))[:RAREST]]

    def candidates(self, term: str) -> DataFrame:
        """Distinct ``id`` of the texts that hold the rarest trigrams of a term of three characters or more."""
        wanted = self.rarest(term)
        if wanted is None:
            return self._stored("postings").select("id").limit(0)
        listed = self._read("postings", wanted)
        return listed.groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(wanted)).select("id")

    def search(self, texts: DataFrame, key: str, text: str, term: str) -> DataFrame:
        """Rows of ``texts`` whose text contains the term, ignoring case.

        The same rows as ``contains(lower(text), lower(term))`` on the texts that were indexed. Terms
        under three characters have no trigram: all texts are scanned for them.
        """
        holds = F.contains(F.lower(F.col(text)), F.lower(F.lit(term)))
        length = self.spark.range(1).select(F.length(F.lower(F.lit(term)))).first()[0]
        if length < GRAM:
            return texts.where(holds)
        found = self.candidates(term)
        return texts.join(found, texts[key] == found["id"], "left_semi").where(holds)
