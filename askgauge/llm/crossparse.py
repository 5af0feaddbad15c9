"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language gives, at any place of a document, the longest match
with that language. Parsing a document greedily into such matches costs few phrases in its own
language and many in others; the language that needs the fewest, after normalisation, wins.

All documents of a batch are parsed at once: each is cut into stretches, every stretch and language is
a lane, and one numpy step moves every lane by one character through the automata. Their transitions
are kept in a hash table of (state, symbol): a text of n characters has under 3n of them, however many
symbols there are.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from askgauge.llm.common import map_batches, replace_columns, schema_with, slices

SAMPLE_CHARS = 24_000  # of labelled text per language
SAMPLE_DOCS = 64  # documents per language that this is taken from
STRETCH = 256  # characters between forced phrase ends
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-case words with one blank between them; everything that is no letter is a blank."""
    return NOT_LETTERS.sub(" ", text or "").strip().lower()


class Automaton:
    """Suffix automaton of one text: reading ``symbol[i]`` in state ``begin[i]`` leads to ``to[i]``.

    State 0 is the start. It cannot be reached by reading, so 0 can stand for "no longer match".
    """

    def __init__(self, symbols: np.ndarray):
        follow, length, link = [{}], [0], [-1]
        last = 0
        for c in symbols.tolist():
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in follow[p]:
                follow[p][c] = new
                p = link[p]
            if p >= 0:
                q = follow[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and follow[p].get(c) == q:
                        follow[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        self.n_states = len(follow)
        self.begin = np.repeat(np.arange(len(follow), dtype=np.int64), [len(edges) for edges in follow])
        self.symbol = np.array([c for edges in follow for c in edges], np.int64)
        self.to = np.array([to for edges in follow for to in edges.values()], np.int64)


class Transitions:
    """A fixed map from non-negative 64-bit keys to positive 32-bit numbers; 0 for any other key.

    Open addressing with linear probing, at most a quarter full, filled and asked by whole arrays.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(4 * len(keys) - 1).bit_length())
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.mask = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.values = np.zeros(size, np.int32)
        place = self._places(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]  # of several that want one place the last has it
            won = self.keys[place] == keys
            self.values[place[won]] = values[won]
            keys, values, place = keys[~won], values[~won], (place[~won] + 1) & self.mask

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        asked = keys.ravel()
        place = self._places(asked)
        held = self.keys[place]
        out = np.where(held == asked, self.values[place], 0)
        open_ = np.flatnonzero((held != asked) & (held >= 0))
        while len(open_):
            place[open_] = (place[open_] + 1) & self.mask
            held = self.keys[place[open_]]
            hit = held == asked[open_]
            out[open_[hit]] = self.values[place[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out.reshape(keys.shape)


class Model:
    """The automata of all languages in one table; symbol 0 is any character the samples do not have."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        known = sorted({c for text in samples.values() for c in text})
        self.codes = {c: i + 1 for i, c in enumerate(known)}
        self.width = len(known) + 1
        self.lookup = np.zeros(max(map(ord, known), default=0) + 1, np.int32)
        for c, i in self.codes.items():
            self.lookup[ord(c)] = i
        keys, values, starts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
        for language in self.languages:
            automaton = Automaton(self.encode(samples[language]))
            keys.append((automaton.begin + at) * self.width + automaton.symbol)
            values.append(automaton.to + at)
            starts.append(at)
            at += automaton.n_states
        self.follow = Transitions(np.concatenate(keys), np.concatenate(values))
        self.starts = np.array(starts, np.int64)
        # Phrases per character are compared in bits: a phrase points into a text of the sample's size.
        self.bits = np.array([math.log2(max(2, len(samples[x]))) for x in self.languages])

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return np.where(points < len(self.lookup), self.lookup[np.minimum(points, len(self.lookup) - 1)], 0).astype(np.int32)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases each text (row) needs in each language (column)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        symbols = self.encode("".join(texts))
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        order = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[owner] + order * STRETCH
        length = np.minimum(STRETCH, sizes[owner] - order * STRETCH)
        by_length = np.argsort(-length, kind="stable")
        owner, begin, length = owner[by_length], begin[by_length], length[by_length]
        # alive[k]: how many stretches have more than k characters.
        alive = np.searchsorted(-length, -np.arange(STRETCH), side="left")
        counts = np.zeros((len(owner), len(self.languages)), np.int32)
        start = np.broadcast_to(self.starts, counts.shape)
        state = start.copy()
        for k in range(int(length.max()) if len(length) else 0):
            n = alive[k]
            c = symbols[begin[:n] + k][:, None]
            here = state[:n]
            to = self.follow[here * self.width + c].astype(np.int64)
            stuck = np.flatnonzero(to.ravel() == 0)
            if len(stuck):  # the phrase ends before this character, and the next one starts with it
                row, language = np.divmod(stuck, to.shape[1])
                start_there = self.starts[language]
                again = self.follow[start_there * self.width + c[row, 0]]
                # A character the language does not have at all is a phrase by itself.
                counts[row, language] += (here[row, language] != start_there).astype(int) + (again == 0)
                to[row, language] = np.where(again > 0, again, start_there)
            state[:n] = to
        counts += state != start
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        np.add.at(total, owner, counts)
        return total

    def predict(self, texts) -> tuple[list, list]:
        """Language and score of each text; the score is 1 minus half the best cost over the next best."""
        plain = [letters(t) for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(plain), [0.0] * len(plain)
        cost = self.phrases(plain) * self.bits
        best = cost.argmin(axis=1)  # ties: the language that comes first by name
        ordered = np.sort(cost, axis=1)
        second = ordered[:, 1] if cost.shape[1] > 1 else np.maximum(2 * ordered[:, 0], 1)
        score = 1 - 0.5 * np.divide(ordered[:, 0], second, out=np.ones(len(plain)), where=second > 0)
        return (
            [self.languages[b] if t else UNKNOWN for b, t in zip(best, plain)],
            [float(s) if t else 0.0 for s, t in zip(score, plain)],
        )


def fit(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Automata from a bounded sample: of each language the ``sample_docs`` documents with the smallest hash.

    Rows without language or without a letter teach nothing. Of the sampled documents, equal shares of
    ``sample_chars`` characters are read. Ids pass first, texts only for the ids chosen.
    """
    named = labelled.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    named = named.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id", F.lit(7)), "id"))
    chosen = named.select("id", "lang").withColumn("place", place).where(F.col("place") <= sample_docs)
    # At most sample_docs ids per language.
    rows = (
        named.join(F.broadcast(chosen.select("id", "lang").distinct()), ["id", "lang"])
        .select("lang", "id", F.substring("text", 1, sample_chars).alias("text"))
        .orderBy("lang", F.xxhash64("id", F.lit(7)), "id", "text")
        .collect()
    )
    texts: dict[str, list] = {}
    for r in rows:
        texts.setdefault(r["lang"], []).append(letters(r["text"]))
    samples = {}
    for name, parts in texts.items():
        share = sample_chars // len(parts)
        short = sum(max(0, share - len(p)) for p in parts)
        # What short documents leave over is shared among the others.
        share += short // max(1, sum(len(p) > share for p in parts))
        joined = " ".join(p[:share] for p in parts)[:sample_chars]
        if joined:
            samples[name] = joined
    return Model(samples)


def identify(
    docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Add the predicted language of every whole text and a score from 0 to 1.

    A null text, or one without a letter, is ``und`` with score 0; equal costs go to the language
    first by name; every row is judged by itself. Input columns named like an output give way to it.
    """
    spark = docs.sparkSession
    # Bounded by languages x sample_chars: under 300 bytes a character, whatever the alphabet.
    shared = spark.sparkContext.broadcast(model)

    def predict(batches):
        for batch in slices(batches, 512):
            languages, scores = shared.value.predict(batch.column(text).to_pylist())
            made = {lang_pred: pa.array(languages, pa.string()), score: pa.array(scores, pa.float64())}
            yield replace_columns(batch, made)

    return map_batches(docs, predict, schema_with(docs, f"`{lang_pred}` string, `{score}` double"))
