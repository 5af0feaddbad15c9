"""I-Match fingerprints: hashes of a text's informative terms under randomised lexicons.

Terms whose document frequency lies in a band form the lexicon. A text is reduced to its distinct terms
in that lexicon, sorted; each of several random sub-lexicons, at several densities, selects some of
them, and the hash of the selected ones is one part of the fingerprint. An edit changes only the parts
whose selection it touches, so the share of equal parts tells how much two texts have in common.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from askgauge.llm.common import map_batches, partitions, replace_columns, schema_with, shipped, slices, written

# The band as shares of all documents a term may occur in. Lexicon terms number at most the mean of
# distinct terms per document over LOW, whatever the size of the corpus.
LOW, HIGH = 1 / 2000, 1 / 20
MOST_TERMS = 4_000_000
LEAST_TERMS = 4  # a text with fewer terms of the lexicon is fingerprinted by all its terms
DENSITIES = 12  # sub-lexicons hold 1/2, 1/4, ... 1/4096 of the terms
DRAWS = 8  # sub-lexicons per density
PARTS = DENSITIES * DRAWS
DIGITS = 6  # hex digits per part
EVIDENCE = 16  # parts that are compared before denser, more sensitive ones are left out
FLUSH_TERMS = 400_000
PAIRS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
PAIRS_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def terms(text: str | None) -> set[bytes]:
    """Distinct words of a whole text, A-Z lower-cased."""
    return set((text or "").encode().lower().split())


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> list[bytes]:
    """The terms in the band, sorted, from the document frequencies of all documents."""

    def count(batches):
        from collections import Counter

        seen: Counter = Counter()

        def flush():
            names = pa.array(seen.keys(), pa.binary())
            return pa.RecordBatch.from_arrays([names, pa.array(seen.values(), pa.int64())], ["term", "df"])

        for batch in slices(batches, 256):
            for t in batch.column(text).to_pylist():
                seen.update(terms(t))
            if len(seen) > FLUSH_TERMS:
                yield flush()
                seen.clear()
        yield flush()

    total = docs.count()
    counted = map_batches(docs.select(text), count, "term binary, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    in_band = counted.where((F.col("df") >= low * total) & (F.col("df") <= high * total)).select("term")
    listed = written(in_band, "imatch-lexicon")
    if listed.count() > MOST_TERMS:
        raise ValueError(f"the band holds over {MOST_TERMS} terms; raise its lower end")
    return sorted(listed.toArrow().column("term").to_pylist())


def selections(hashes: np.ndarray) -> np.ndarray:
    """For every term hash, which sub-lexicons hold it: a row of PARTS booleans."""
    chosen = np.empty((len(hashes), PARTS), bool)
    for part in range(PARTS):
        mixed = (hashes ^ np.uint64((part + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        chosen[:, part] = (mixed >> np.uint64(63 - part // DRAWS)) == 0
    return chosen


class Fingerprinter:
    """Fingerprints of texts under one lexicon."""

    def __init__(self, words: list[bytes]):
        self.places = {w: i for i, w in enumerate(words)}
        self.hashes = term_hashes(words)
        self.chosen = np.packbits(selections(self.hashes), axis=1) if words else np.zeros((0, PARTS // 8), np.uint8)

    def __call__(self, text: str | None) -> str:
        import xxhash

        found = terms(text)
        places = self.places
        known = sorted(places[w] for w in found if w in places)  # places follow the sorted terms
        if len(known) >= LEAST_TERMS:
            hashes = self.hashes[known]
            chosen = np.unpackbits(self.chosen[known], axis=1).view(bool)
        else:
            hashes = term_hashes(sorted(found))
            chosen = selections(hashes)
        parts = ["0" * DIGITS] * PARTS
        for part in np.flatnonzero(chosen.any(axis=0)).tolist():
            value = xxhash.xxh32_intdigest(hashes[chosen[:, part]].tobytes()) % 16**DIGITS
            parts[part] = f"{value or 1:0{DIGITS}x}"
        return "".join(parts)


def term_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def likeness(a: str, b: str) -> float:
    """Share of terms in common, told by equal parts from the sparsest sub-lexicons up.

    Where a part selects a term or two, it is equal as often as terms common to both are among all
    terms of either; twice that share over one more is the common share of the terms of each. Denser
    parts are used only until enough select anything: for short texts. Equal fingerprints are 1.
    """
    if a == b:
        return 1.0
    used = same = 0
    for density in reversed(range(DENSITIES)):
        for part in range(density * DRAWS, (density + 1) * DRAWS):
            x, y = (s[part * DIGITS : (part + 1) * DIGITS] for s in (a, b))
            if x != "0" * DIGITS or y != "0" * DIGITS:
                used += 1
                same += x == y
        if used >= EVIDENCE:
            break
    return 2 * same / (used + same) if used else 0.0


def fingerprints(
    df: DataFrame, words: list[bytes], text: str = "text", out: str = "fingerprint"
) -> DataFrame:
    """Add the fingerprint of every whole text under a lexicon; null and blank texts get one of zeros."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    def add(batches):
        make = Fingerprinter(shared.value)
        for batch in slices(batches, 512):
            made = pa.array([make(t) for t in batch.column(text).to_pylist()], pa.string())
            yield replace_columns(batch, {out: made})

    return map_batches(df, add, schema_with(df, f"`{out}` string"))


def edited(text: str | None, after: str | None) -> str:
    """The text with its last third replaced by as many characters from the start of the next one."""
    text, after = text or "", after or ""
    n = len(text) // 3
    return text[: len(text) - n] + after[:n]


def ring(docs: DataFrame, n: int) -> DataFrame:
    """Rows of ``docs`` (doc_id, h, ...) in ``n`` runs of consecutive ids, each closed by the next run's first row.

    Adds ``run`` and ``extra``, which marks the closing row. Descending ids run on from run to run and
    start again after the last; rows without id come last, equal ids in descending h. Bounds are id
    quantiles, so runs are even whatever the ids are. Only bounds and first rows' keys, ``n`` of each,
    pass the driver.
    """
    shipped(docs.sparkSession)
    shares = [i / n for i in range(1, n)]
    quantiles = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("b")).first()["b"] if shares else None
    bounds = np.unique(np.array(quantiles or [], np.int64))

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(), side="left"), dtype="int32")

    placed = docs.withColumn("run", run_of(F.coalesce("doc_id", F.lit(-(2**63)))))
    first = F.max(F.struct(F.isnotnull("doc_id").alias("known"), "doc_id", "h")).alias("first")
    rows = sorted(placed.select("run", "doc_id", "h").groupBy("run").agg(first).collect())
    closed = [(r["run"], r["first"]["doc_id"], r["first"]["h"], rows[i - 1]["run"]) for i, r in enumerate(rows)]
    heads = docs.sparkSession.createDataFrame(closed, "own int, head_id bigint, head_h bigint, closes int")
    is_head = (
        (F.col("run") == F.col("own"))
        & F.col("doc_id").eqNullSafe(F.col("head_id"))
        & (F.col("h") == F.col("head_h"))
    )
    # One row per run.
    marked = placed.join(F.broadcast(heads), is_head, "left")
    own = F.struct("run", F.lit(False).alias("extra"))
    closing = F.struct(F.col("closes").alias("run"), F.lit(True).alias("extra"))
    places = F.when(F.col("closes").isNotNull(), F.array(own, closing)).otherwise(F.array(own))
    return marked.select(*docs.columns, F.explode(places).alias("p")).select(*docs.columns, "p.run", "p.extra")


def compare_with_next(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """Each document against its edited text and against the next document in descending id.

    From ``doc_id`` and ``text``: ``n_chars``, the SHA-256 of the edited text, both fingerprints, and
    the likeness of the document's to the edited text's and to the next document's. Texts move once;
    a task streams over its runs and holds two documents at a time.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = ring(body.withColumn("h", F.xxhash64("text")), 4 * partitions(spark))
    dealt = placed.repartition("run").sortWithinPartitions(
        "run", "extra", F.isnull("doc_id"), F.desc("doc_id"), F.desc("h")
    )

    def stream(batches):
        import hashlib

        make, last = Fingerprinter(shared.value), None
        for batch in slices(batches, 256):
            made = []
            for doc_id, text, run, extra in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "run", "extra"))):
                if last is not None and last[0] == run and last[4]:
                    continue  # a second row equal to the closing one
                print_ = make(text)
                if last is not None and last[0] == run:
                    changed = edited(last[2], text)
                    other = make(changed)
                    made.append(
                        {
                            "doc_id": last[1],
                            "n_chars": len(last[2]),
                            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
                            "fingerprint": last[3],
                            "edited_fingerprint": other,
                            "near_edited": likeness(last[3], other),
                            "near_next": likeness(last[3], print_),
                        }
                    )
                last = (run, doc_id, text, print_, extra)
            yield pa.RecordBatch.from_pylist(made, schema=PAIRS)

    return map_batches(dealt.select("doc_id", "text", "run", "extra"), stream, PAIRS_DDL)
