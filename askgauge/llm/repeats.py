"""Substring dedup by hashing lines and sentences.

A text is cut into lines, each line into sentences, and each sentence before its capitalised words;
every unit that is long enough is normalised and digested. Digests are grouped over the whole corpus, the earliest occurrence by (document id, offset)
stays, and every later one is cut out of its text at its original offsets.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from askgauge.llm.common import map_batches, schema_with, slices, unused, written

MIN_WORDS = 10  # of a line or a sentence
PIECE = 2  # times as many for a piece of a sentence
UNSPACED_WORD = 2  # characters that count as a word in scripts that put no blanks between words
# Thai to Lao, Myanmar, Khmer, kana, Han. Fixed values.
UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"
# A sentence ends after closing punctuation and the blanks behind it.
SENTENCE_END = r"[.!?][ \t]+|[。！？][ \t]*"
# Passages that were put into the middle of a sentence are found by the pieces that start with a capital.
PIECE_START = r"[ \t](?=[A-ZÀ-ÖØ-Þ])"
ENDS, STARTS, UNSPACED_ONE = re.compile(SENTENCE_END), re.compile(PIECE_START), re.compile(UNSPACED)


def parts(text: str, start: int, end: int, cut: re.Pattern) -> list[tuple[int, int]]:
    """The spans of a span that is cut after every match but one at its end."""
    at = [start, *(m.end() for m in cut.finditer(text, start, end) if m.end() < end), end]
    return list(zip(at, at[1:]))


def units(text: str, min_words: int = MIN_WORDS):
    """(start, end, words it needs) of every line, sentence and piece, each span once; end exclusive, in code points."""
    at = 0
    for line in text.split("\n"):
        end = at + len(line)
        yield at, end, min_words
        for sentence in parts(text, at, end, ENDS):
            if sentence != (at, end):
                yield *sentence, min_words
            for piece in parts(text, *sentence, STARTS):
                if piece != sentence:
                    yield *piece, PIECE * min_words
        at = end + 1


def long_enough(unit: str, words: list[str], least: int) -> bool:
    """Whether a unit has enough words, or enough characters of scripts that do not part words."""
    return len(words) >= least or (
        not unit.isascii() and len(UNSPACED_ONE.findall(unit)) >= UNSPACED_WORD * least
    )


def digests(text: str | None, min_words: int):
    """(start, end, digest) of the units of a text that are long enough."""
    import xxhash

    text = text or ""
    for start, end, least in units(text, min_words):
        unit = text[start:end].lower()
        words = unit.split()
        if long_enough(unit, words, least):
            yield start, end, xxhash.xxh3_128_digest(" ".join(words).encode())


def unit_table(df: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """(id, h, start, end, digest) per unit; h is the hash of the whole text."""

    def cut(batches):
        for batch in slices(batches, 512):
            rows = [(i, *u) for i, t in enumerate(batch.column("text").to_pylist()) for u in digests(t, min_words)]
            at, start, end, digest = zip(*rows) if rows else ((), (), (), ())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(take),
                    batch.column("h").take(take),
                    pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()),
                    pa.array(digest, pa.binary()),
                ],
                ["id", "h", "start", "end", "digest"],
            )

    chosen = df.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    id_type = chosen.schema["id"].dataType.simpleString()
    return map_batches(chosen, cut, f"id {id_type}, h bigint, start int, end int, digest binary")


def _rank() -> Column:
    """Where an occurrence stands: documents by id, those without one last, then by offset."""
    return F.struct(F.isnull("id").alias("o"), "id", "h", "start", "end")


def later_occurrences(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS):
    """(id, h, spans): per document the sorted [start, end) spans that occurred before.

    Counting is combined before the shuffle, so a unit that most documents share moves as one row per
    task. Only repeated digests are joined back, in a join that adaptive execution can split.
    """
    found = written(unit_table(df, doc_id, text, min_words), "repeats-units")
    grouped = found.groupBy("digest").agg(F.min(_rank()).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = found.join(grouped, "digest").where(~_rank().eqNullSafe(F.col("first")))
    return again.groupBy("id", "h").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def without_spans(text: str, starts, ends) -> tuple[str, list]:
    """The text without the spans, and the spans merged where they touch or overlap.

    A removed line takes the line break behind it along, which is not part of its span.
    """
    merged: list[list[int]] = []
    for a, b in zip(starts, ends):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, at = [], 0
    for a, b in merged:
        kept.append(text[at:a])
        at = b
        if (a == 0 or text[a - 1] == "\n") and text[b : b + 1] == "\n":
            at = b + 1
    kept.append(text[at:])
    return "".join(kept), merged


def remove_repeats(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, spans: str = "removed_spans"
) -> DataFrame:
    """Every document with its text cut and ``removed_spans``, offsets into the original text in code points.

    Units are equal if they agree in lower case with blanks squeezed. Lines and sentences of fewer than
    ``min_words`` words are never removed, nor are pieces of a sentence of fewer than twice as many; where
    a script parts no words, two characters count as one. Each row comes back, emptied ones as empty texts, null texts as null. The
    first occurrence is that of the smallest id, then offset; rows without id come last. Rows equal in
    id and text are one document: what stays in one stays in all. An input column named like the spans
    gives way to them.
    """
    kept = [c for c in df.columns if c.lower() != spans]
    key, their_id, their_key, found = (unused(df, name) for name in ("key", "their_id", "their_key", "found"))
    later = later_occurrences(df, doc_id, text, min_words).toDF(their_id, their_key, found)
    keyed = df.select(*kept, F.xxhash64(text).alias(key))
    same = F.col(doc_id).eqNullSafe(F.col(their_id)) & (F.col(key) == F.col(their_key))
    joined = keyed.join(later, same, "left").select(*kept, found)

    def cut(batches):
        for batch in slices(batches, 512):
            column = batch.column(found)
            flat, offsets = column.flatten(), np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0))])
            starts, ends = (flat.field(k).to_pylist() for k in ("start", "end"))
            texts, removed = [], []
            for k, t in enumerate(batch.column(text).to_pylist()):
                a, b = offsets[k], offsets[k + 1]
                body, merged = without_spans(t, starts[a:b], ends[a:b]) if b > a else (t, [])
                texts.append(body)
                removed.append([{"start": x, "end": y} for x, y in merged])
            arrays = dict(zip(kept, (batch.column(c) for c in kept)))
            arrays[text] = pa.array(texts, pa.string())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            arrays[spans] = pa.array(removed, kind)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    schema = schema_with(df.select(*kept), f"`{spans}` array<struct<start: int, end: int>>")
    return map_batches(joined, cut, schema)


def oracle() -> str:
    """The same removal in DuckDB SQL: per document the merged spans and the text that is left."""
    return rf"""
WITH lines AS (
    SELECT doc_id, text, i AS line_no, parts[i] AS line,
        coalesce(list_sum(list_transform(parts[:i - 1], lambda x: length(x) + 1)), 0)::BIGINT AS pos
    FROM (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents) t, unnest(range(1, len(parts) + 1)) u(i)),
sentences AS (
    SELECT doc_id, text, line, pos, j AS sentence_no, cuts[j] AS sentence,
        pos + coalesce(list_sum(list_transform(cuts[:j - 1], lambda x: length(x))), 0)::BIGINT AS since
    FROM (SELECT *, list_filter(string_split(regexp_replace(line, '({SENTENCE_END})', '\1' || chr(1), 'g'), chr(1)),
        lambda x: x <> '') AS cuts FROM lines) t, unnest(range(1, len(cuts) + 1)) u(j)),
pieces AS (
    SELECT doc_id, text, since + coalesce(list_sum(list_transform(cuts[:j - 1], lambda x: length(x))), 0)::BIGINT AS "start",
        since + list_sum(list_transform(cuts[:j], lambda x: length(x)))::BIGINT AS "end"
    FROM (SELECT *, list_filter(string_split(regexp_replace(sentence, '([ \t])([A-ZÀ-ÖØ-Þ])', '\1' || chr(1) || '\2', 'g'),
        chr(1)), lambda x: x <> '') AS cuts FROM sentences) t, unnest(range(1, len(cuts) + 1)) u(j)),
spans AS (
    SELECT doc_id, text, "start", "end", min(least) AS least FROM (
        SELECT doc_id, text, pos AS "start", pos + length(line) AS "end", {MIN_WORDS} AS least FROM lines
        UNION ALL SELECT doc_id, text, since, since + length(sentence), {MIN_WORDS} FROM sentences
        UNION ALL SELECT doc_id, text, "start", "end", {PIECE * MIN_WORDS} FROM pieces) GROUP BY ALL),
normal AS (
    SELECT *, trim(regexp_replace(lower(substr(text, "start" + 1, "end" - "start")), '\s+', ' ', 'g')) AS unit FROM spans),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id, "start", "end") AS place FROM normal
    WHERE (unit <> '' AND len(string_split(unit, ' ')) >= least)
        OR length(regexp_replace(unit, '{UNSPACED.replace('[', '[^')}', '', 'g')) >= {UNSPACED_WORD} * least),
later AS (SELECT doc_id, "start", "end" FROM ranked WHERE place > 1),
grown AS (
    SELECT *, max("end") OVER (PARTITION BY doc_id ORDER BY "start", "end"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM later),
grouped AS (
    SELECT *, count(CASE WHEN reach IS NULL OR "start" > reach THEN 1 END)
        OVER (PARTITION BY doc_id ORDER BY "start", "end") AS part FROM grown),
merged AS (SELECT doc_id, min("start") AS "start", max("end") AS "end" FROM grouped GROUP BY doc_id, part),
cut AS (
    SELECT m.*, text, "end" + CASE WHEN ("start" = 0 OR substr(text, "start", 1) = chr(10))
        AND substr(text, "end" + 1, 1) = chr(10) THEN 1 ELSE 0 END AS upto
    FROM merged m JOIN documents USING (doc_id)),
kept AS (
    SELECT *, coalesce(lag(upto) OVER (PARTITION BY doc_id ORDER BY "start"), 0) AS since FROM cut),
summed AS (
    SELECT doc_id, count(*) AS n_spans, sum("end" - "start")::BIGINT AS removed_chars,
        string_agg("start" || '-' || "end", ',' ORDER BY "start") AS spans,
        string_agg(substr(text, since + 1, "start" - since), '' ORDER BY "start")
            || substr(any_value(text), max(upto) + 1) AS left_over
    FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(removed_chars, 0)::BIGINT AS removed_chars,
    coalesce(spans, '') AS spans, sha256(coalesce(left_over, text)) AS kept_sha256
FROM documents d LEFT JOIN summed USING (doc_id)"""
