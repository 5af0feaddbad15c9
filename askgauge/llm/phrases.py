"""Phrase collocations, counted in burst tries and scored exactly.

A task counts phrases in a trie whose upper levels are keyed by word ids and whose leaves are hash
containers of suffixes; a container that grows too large bursts into a node. When a task holds too many
phrases it spills its coldest subtrees whole, as sorted runs of (prefix, rest, count). Spark brings the
runs of one prefix together and adds them up.

Only phrases whose words and word pairs all can reach the threshold enter a trie. Two passes before count
64-bit hashes of words, then of pairs of such words; the frequent hashes become a bit filter of bounded
size that knows no false negatives, so nothing is lost and the counts stay exact.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from askgauge.llm.common import map_batches, shipped, written

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words
TOP = 2000  # phrases reported per language
SEED = 42
BURST = 2048  # suffixes in a container before it bursts
DEEPEST = 2  # levels of the trie above the containers
HELD = 1_000_000  # phrases a task holds, some 150 MB, before it spills half of them
HASHES = 3_000_000  # hashes a task holds before it hands them on: 48 MB
WORDS = 400_000  # distinct words a task knows the numbers of before it forgets the rare ones
TOKENS = 500_000  # words counted at once
FILTER_BITS = (16, 28)  # sizes of the filters, as powers of two: 8 kB to 32 MB
RUN = 20_000  # rows of a run in one record batch
# Fixed value: what ends a piece; blanks and tabs part the words of one.
PIECE_END = ".,;:!?\n\x0b\x0c\r"
CLEAN = bytes(
    10 if chr(b) in PIECE_END else 32 if b == 9 else b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256)
)
TOKEN = re.compile(rb"[^ \n]+|\n")


# --- The trie ---


class BurstTrie:
    """Counts of word-id sequences: nodes by word id above hash containers of suffixes."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.root: dict[int, dict | BurstTrie] = {}
        self.size = 0

    def add(self, sequences: np.ndarray, counts: np.ndarray, depth: int = 1) -> None:
        """Add counts of the distinct rows of ``sequences``, which must be sorted by their first id."""
        heads = sequences[:, 0]
        firsts = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]])) if len(heads) else []
        suffixes = np.ascontiguousarray(sequences[:, 1:].astype("<u4"))
        width = 4 * suffixes.shape[1]
        keys = suffixes.view(f"V{width}").ravel().tolist() if width else [b""] * len(heads)
        numbers = counts.tolist()
        for a, b in zip(firsts, [*firsts[1:], len(heads)]):
            head = int(heads[a])
            below = self.root.get(head)
            if below is None:
                below = self.root[head] = {}
            if isinstance(below, BurstTrie):
                before = below.size
                order = np.argsort(suffixes[a:b, 0], kind="stable") if width else slice(None)
                below.add(suffixes[a:b][order], counts[a:b][order], depth + 1)
                self.size += below.size - before
                continue
            before, get = len(below), below.get
            for key, n in zip(keys[a:b], numbers[a:b]):
                below[key] = get(key, 0) + n
            self.size += len(below) - before
            if len(below) > self.burst and depth < DEEPEST and width > 4:
                self.root[head] = self.burst_container(below)

    def burst_container(self, container: dict[bytes, int]) -> "BurstTrie":
        """The same suffixes under a node of their first ids."""
        node = BurstTrie(self.burst)
        for key, n in container.items():
            node.root.setdefault(int.from_bytes(key[:4], "little"), {})[key[4:]] = n
        node.size = len(container)
        return node

    def occurrences(self) -> int:
        return sum(b.occurrences() if isinstance(b, BurstTrie) else sum(b.values()) for b in self.root.values())

    def coldest(self) -> list[int]:
        """The heads of the subtrees below the root, those first whose phrases recur least."""
        heat = {}
        for head, below in self.root.items():
            node = isinstance(below, BurstTrie)
            heat[head] = below.occurrences() / below.size if node else sum(below.values()) / len(below)
        return sorted(heat, key=heat.get)

    def pairs(self):
        """(ids as bytes, count) of all sequences."""
        for head, below in self.root.items():
            start = head.to_bytes(4, "little")
            for key, n in below.pairs() if isinstance(below, BurstTrie) else below.items():
                yield start + key, n

    def cut(self, keep: int):
        """Take whole subtrees out, the coldest first, until at most ``keep`` sequences are left."""
        for head in self.coldest():
            if self.size <= keep:
                return
            below = self.root.pop(head)
            size = below.size if isinstance(below, BurstTrie) else len(below)
            self.size -= size
            alone = BurstTrie(self.burst)
            alone.root[head], alone.size = below, size
            yield alone


# --- Hashes and filters ---


def word_hashes(lang: bytes, words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(lang + b"\n" + w, SEED) for w in words), np.uint64, len(words))


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of word pairs from those of their words; the order of the words counts."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(32)))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class HashCounts:
    """Counts by hash in sorted arrays."""

    def __init__(self):
        self.keys, self.n = [np.array([], np.uint64)], [np.array([], np.int64)]
        self.pending = 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n)
        self.pending += len(keys)
        if self.pending > HASHES // 3:
            self.merge()

    def merge(self) -> None:
        keys, n = np.concatenate(self.keys), np.concatenate(self.n)
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.array([], int)
        self.keys, self.n, self.pending = [keys[firsts]], [np.add.reduceat(n, firsts) if len(keys) else n], 0

    def size(self) -> int:
        return len(self.keys[0]) + self.pending

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        keys, n = self.keys[0], self.n[0]
        self.__init__()
        return keys, n


def bit_filter(items: DataFrame) -> np.ndarray:
    """The bits of the distinct hashes ``key``: 16 a hash, within ``FILTER_BITS``, so at most 32 MB.

    A full filter lets more phrases be counted that turn out rare; it never hides a frequent one.
    """
    n = items.count()
    bits = min(max(FILTER_BITS[0], (16 * n).bit_length()), FILTER_BITS[1])
    at = F.col("key").bitwiseAND(2**bits - 1)
    # Buckets of 2**15 bits, combined in every task before they move.
    found = (
        items.select(at.alias("at"))
        .groupBy(F.shiftright("at", 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(2**15 - 1)).alias("bits"))
        .toArrow()
    )
    chunks = np.zeros((2 ** (bits - 15), 4096), np.uint8)
    for bucket, chunk in zip(found.column("bucket").to_pylist(), found.column("bits").to_pylist()):
        chunks[bucket] = np.frombuffer(chunk, np.uint8)
    return chunks.ravel()


def passes(bits: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter lets through; without a filter all."""
    if bits is None:
        return np.ones(len(keys), bool)
    at = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# --- Counting ---


class Numbers(dict):
    """Ids of words in the order they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b"\n": 0})
        self.fresh: list[bytes] = []
        self.next = 1

    def __missing__(self, word):
        self[word] = n = self.next
        self.next += 1
        self.fresh.append(word)
        return n


class Reader:
    """The words of one language in one task: their ids, hashes, and whether they can be frequent."""

    def __init__(self, lang: str, words=None):
        self.lang, self.filter = lang.encode(), words
        self.numbers, self.names = Numbers(), [b"\n"]
        self.hashes, self.frequent = np.zeros(1, np.uint64), np.zeros(1, bool)

    def number(self, texts: list[bytes]) -> np.ndarray:
        tokens = TOKEN.findall(b"\n".join(texts))
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
        fresh, self.numbers.fresh = self.numbers.fresh, []
        self.names += fresh
        hashes = word_hashes(self.lang, fresh)
        self.hashes = np.concatenate([self.hashes, hashes])
        self.frequent = np.concatenate([self.frequent, passes(self.filter, hashes)])
        return ids

    def forget(self) -> None:
        """Forget the words that cannot be frequent; one that comes again gets another number."""
        for word, i in list(self.numbers.items()):
            if i and not self.frequent[i]:
                del self.numbers[word]
                self.names[i] = b""

    def pairs(self, ids: np.ndarray):
        """(starts, pairs, first, place, n): where pairs of frequent words start, and the distinct pairs among them."""
        ok = self.frequent[ids]
        at = np.flatnonzero(ok[:-1] & ok[1:])
        packed = ids[:-1][at] << 32 | ids[1:][at]
        return at, *np.unique(packed, return_index=True, return_inverse=True, return_counts=True)

    def pair_keys(self, pair: np.ndarray) -> np.ndarray:
        return pair_hashes(self.hashes[pair >> 32], self.hashes[pair & 0xFFFFFFFF])


class Counter(Reader):
    """The phrases of one language in one task, of all sizes up to ``longest``."""

    def __init__(self, lang: str, longest: int, words=None, pairs=None, burst: int = BURST):
        super().__init__(lang, words)
        self.longest, self.pair_filter = longest, pairs
        self.trie, self.single = BurstTrie(burst), np.zeros(0, np.int64)

    def add(self, texts: list[bytes]) -> None:
        """Count the phrases of these texts; all occurrences of one of them at once."""
        ids = self.number(texts)
        single = np.bincount(ids, minlength=len(self.names))
        single[: len(self.single)] += self.single
        self.single = single
        at, pair, first, place, n = self.pairs(ids)
        kept = passes(self.pair_filter, self.pair_keys(pair))
        if self.longest >= 2 and kept.any():
            self.put(ids, at[first[kept]], 2, n[kept])
        kept = kept[place]
        # For every word the number of the phrase that starts there, -1 for none; first the pairs.
        code = np.full(len(ids), -1, np.int64)
        code[at[kept]] = place[kept]
        pair_code = code
        for size in range(3, self.longest + 1):
            # A phrase is the one a word shorter and the pair that ends it.
            starts = max(0, len(ids) - size + 1)
            shorter, last = code[:starts], pair_code[size - 2 :][:starts]
            at = np.flatnonzero((shorter >= 0) & (last >= 0))
            if not len(at):
                return
            _, first, place, n = np.unique(
                shorter[at] << 32 | last[at], return_index=True, return_inverse=True, return_counts=True
            )
            code = np.full(len(ids), -1, np.int64)
            code[at] = place
            self.put(ids, at[first], size, n)

    def put(self, ids, at, size, n):
        sequences = ids[at[:, None] + np.arange(size)]
        order = np.argsort(sequences[:, 0], kind="stable")
        self.trie.add(sequences[order], n[order])

    def run(self, tries):
        """Sorted runs (lang, prefix, rest, n) of the given subtrees; a prefix is the first two words."""
        names = self.names
        for trie in tries:
            rows = []
            for key, n in trie.pairs():
                words = [names[i] for i in np.frombuffer(key, "<u4").tolist()]
                rows.append((b" ".join(words[:2]), b" ".join(words[2:]), n))
            rows.sort()
            for start in range(0, len(rows), RUN):
                yield self.record(*zip(*rows[start : start + RUN]))

    def record(self, prefix, rest, n):
        texts = (pa.array(c, pa.binary()).cast(pa.string()) for c in (prefix, rest))
        arrays = [pa.array([self.lang.decode()] * len(n), pa.string()), *texts, pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "prefix", "rest", "n"])

    def spill(self, keep: int):
        yield from self.run(joined(self.trie.cut(keep)))

    def finish(self):
        """All that is held, the single words too."""
        yield from self.spill(0)
        some = np.flatnonzero(self.frequent[: len(self.single)] & (self.single > 0))
        if len(some):
            yield self.record([self.names[i] for i in some.tolist()], [b""] * len(some), self.single[some].tolist())


def joined(tries):
    """Small subtrees together, so that a run is not a record batch of a few rows."""
    held = None
    for trie in tries:
        if held is None:
            held = trie
        else:
            held.root.update(trie.root)
            held.size += trie.size
        if held.size >= RUN:
            yield held
            held = None
    if held is not None:
        yield held


def by_language(batches, add):
    """Hand the cleaned texts of the batches to ``add`` (lang, texts), about ``TOKENS`` words of a language at once."""
    waiting: dict[str, list[bytes]] = {}
    volume: dict[str, int] = {}

    def flush(lang):
        volume.pop(lang)
        return add(lang, waiting.pop(lang))

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            cleaned = text.encode().translate(CLEAN)
            waiting.setdefault(lang, []).append(cleaned)
            volume[lang] = volume.get(lang, 0) + len(cleaned)
            if volume[lang] > 6 * TOKENS:
                yield from flush(lang)
        while sum(volume.values()) > 12 * TOKENS:
            yield from flush(max(volume, key=volume.get))
    for lang in list(waiting):
        yield from flush(lang)


def hashed_counts(texts: DataFrame, words=None) -> DataFrame:
    """(lang, key, n) of the hashes of all words, or, with a filter of words, of the pairs of those it lets through."""
    spark = shipped(texts.sparkSession)
    shared = spark.sparkContext.broadcast(words)

    def count(batches):
        word_bits = shared.value
        readers: dict[str, Reader] = {}
        held: dict[str, HashCounts] = {}

        def take(lang):
            keys, n = held.pop(lang).take()
            lang = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(keys), np.int32)))
            for start in range(0, len(keys), 2**17):
                part = slice(start, start + 2**17)
                arrays = [lang[part], pa.array(keys[part].view(np.int64)), pa.array(n[part])]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "key", "n"])

        def add(lang, some):
            reader = readers.setdefault(lang, Reader(lang, word_bits))
            counts = held.setdefault(lang, HashCounts())
            ids = reader.number(some)
            if word_bits is None:
                n = np.bincount(ids, minlength=1)
                n[0] = 0
                here = np.flatnonzero(n)
                counts.add(reader.hashes[here], n[here])
            else:
                _, pair, _, _, n = reader.pairs(ids)
                counts.add(reader.pair_keys(pair), n)
            if sum(c.size() for c in held.values()) > HASHES:
                yield from take(max(held, key=lambda x: held[x].size()))
            if sum(len(r.numbers) for r in readers.values()) > WORDS:
                readers.clear()

        yield from by_language(batches, add)
        for lang in list(held):
            yield from take(lang)

    found = map_batches(texts, count, "lang string, key bigint, n bigint")
    return found.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def counts(
    texts: DataFrame, longest: int, words=None, pairs=None, held: int = HELD, words_held: int = WORDS
) -> DataFrame:
    """(lang, phrase, words, n) of the phrases of up to ``longest`` words that the filters let through.

    Only words that can be frequent are in a trie, so the others are forgotten when a task knows too
    many. If those left, or all numbers ever given, are too many, it hands on all it holds.
    """
    spark = shipped(texts.sparkSession)
    shared = spark.sparkContext.broadcast((words, pairs))

    def count(batches):
        word_bits, pair_bits = shared.value
        counters: dict[str, Counter] = {}

        def add(lang, some):
            counters.setdefault(lang, Counter(lang, longest, word_bits, pair_bits)).add(some)
            total = sum(c.trie.size for c in counters.values())
            if sum(len(c.numbers) for c in counters.values()) > words_held:
                for c in counters.values():
                    c.forget()
            known, given = (sum(f(c.numbers) for c in counters.values()) for f in (len, lambda x: x.next))
            if known > words_held or given > 16 * words_held:
                for c in counters.values():
                    yield from c.finish()
                counters.clear()
            elif total > held:
                largest = max(counters.values(), key=lambda c: c.trie.size)
                yield from largest.spill(max(0, largest.trie.size - (total - held // 2)))

        yield from by_language(batches, add)
        for counter in counters.values():
            yield from counter.finish()

    runs = map_batches(texts, count, "lang string, prefix string, rest string, n bigint")
    # All runs of a prefix meet in one partition; the sum by phrase needs no further exchange.
    merged = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "rest").agg(F.sum("n").alias("n"))
    phrase = F.when(F.col("rest") == "", F.col("prefix")).otherwise(F.concat_ws(" ", "prefix", "rest"))
    return merged.select("lang", phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("words"), "n")


def frequent_phrases(
    df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, phrase, words, n) of 1 to ``longest`` words with ``least`` occurrences, and (lang, total) words.

    Phrases are runs of lower-cased words within a piece, overlaps included. A null text is empty, a
    null language is ``und``. The texts are read three times: hashes of words, hashes of pairs, phrases.
    """
    texts = df.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    often = F.col("n") >= least
    words = written(hashed_counts(texts), "phrases-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    word_bits = bit_filter(words.where(often))
    pairs = written(hashed_counts(texts, word_bits).where(often), "phrases-pairs")
    found = counts(texts, longest, word_bits, bit_filter(pairs)).where(often)
    return written(found, "phrases-counts"), totals


def collocations(
    df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 words or more that occurs ``least`` times is cut in two where its score
    floor(1000 * a * n / (l * r)) is lowest (the first such cut), a, l and r being the occurrences of the
    phrase and its parts and n all words of the language. Phrases that always stand inside one longer
    phrase are dropped: a part of a longer one with the same count, which is then true of a phrase just
    one word longer. Order: score, then a, descending, then phrase by its bytes. An empty table gives no
    rows; other columns are not looked at.
    """
    found, totals = frequent_phrases(df, lang, text, least, longest)
    split = F.split("phrase", " ")
    each = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = found.where("words > 1").select("lang", "phrase", F.col("n").alias("a"), "words", each, split.alias("w"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        (F.col("k") == F.col("words") - 1).alias("drops_left"),
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"),
    )
    sides = {c: found.select("lang", F.col("phrase").alias(c), F.col("n").alias(c[0])) for c in ("left", "right")}
    joined_cuts = cuts.join(sides["left"], ["lang", "left"]).join(sides["right"], ["lang", "right"]).join(totals, "lang")

    def exact(x):
        return F.col(x).cast("decimal(19,0)")

    above = (exact("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(23,0)") * exact("total")
    scored = joined_cuts.withColumn("above", above.cast("decimal(38,0)")).withColumn(
        "below", (exact("l") * exact("r")).cast("decimal(38,0)")
    )
    scored = written(
        scored.select(
            *("lang", "phrase", "a", "k", "l", "r", "left", "right", "drops_left"),
            F.col("total").alias("n"),
            F.expr("above div below").alias("score"),
        ),
        "phrases-cuts",
    )
    inside = (
        scored.where("drops_left and l = a")
        .select("lang", F.col("left").alias("phrase"))
        .unionByName(scored.where("k = 1 and r = a").select("lang", F.col("right").alias("phrase")))
        .distinct()
    )
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    kept = best.join(inside, ["lang", "phrase"], "left_anti").select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, longest: int = LONGEST, top: int = TOP, documents: str = "documents") -> str:
    """The same ranking in DuckDB SQL."""
    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM {documents}),
pieces AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w
    FROM texts, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) u(piece)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces) p, range(1, {longest + 1}) s(size)
    WHERE i + size - 1 <= len(w) GROUP BY ALL),
often AS (SELECT * FROM grams WHERE f >= {least}),
cuts AS (
    SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM often WHERE size > 1),
parts AS (
    SELECT c.lang, c.phrase, c.a, c.size, c.k, l.phrase AS left_part, r.phrase AS right_part, l.f AS l, r.f AS r, t.n,
        (1000::HUGEINT * a * t.n // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts c JOIN totals t ON c.lang = t.lang
    JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
    JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
contained AS (
    SELECT o.lang, o.phrase FROM often o JOIN cuts c ON o.lang = c.lang AND c.k = 1 AND o.size < c.size
        AND 100 * c.a >= 100 * o.f AND contains(' ' || c.phrase || ' ', ' ' || o.phrase || ' ')),
best AS (
    SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM best b WHERE NOT EXISTS (FROM contained c WHERE c.lang = b.lang AND c.phrase = b.phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {top}"""
