"""Byte-level BPE encoding and decoding of whole texts with a public vocabulary file.

A word is held as a contiguous row of parts with the ranks of adjacent pairs beside it. The smallest
rank is found by a scan, its right boundary is deleted, and the two ranks next to it are refreshed,
until no pair has a rank. Many distinct words are processed as the rows of one matrix; words seen
before come from a bounded cache.
"""

import functools
import heapq
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from askgauge.llm.common import map_batches, replace_columns, schema_with, slices

# Fixed value: how the vocabulary's pre-tokenizer cuts a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same cut where the text has common Latin characters only, for which the faster engine's classes agree.
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_LATIN = re.compile("[^\t-\r\x20-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]").search
NO_RANK = np.iinfo(np.int32).max
SHORT_WORD = 64  # bytes; longer words are merged with a heap, whose cost does not grow with the square
CACHED_WORDS = 150_000
BATCH_ROWS = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


TABLE_BITS = 19


def hash_slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def hash_table(keys: np.ndarray):
    """Open addressing: keys, their places in ``keys``, and how many neighbouring slots a lookup must see."""
    size, most = 1 << TABLE_BITS, 1
    table, places = np.full(size + 64, -1, np.int64), np.zeros(size + 64, np.int32)
    for place, (slot, key) in enumerate(zip(hash_slot(keys).tolist(), keys.tolist())):
        step = 0
        while table[slot + step] >= 0:
            step += 1
        table[slot + step], places[slot + step], most = key, place, max(most, step + 1)
    return table, places, most


class ByteBPE:
    """One vocabulary: ``encode`` texts to id arrays, ``decode`` id arrays to texts."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or pre["add_prefix_space"]:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        vocab = model["vocab"]
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = {t["content"]: t["id"] for t in added}
        self.added_pattern = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
        self.find_any, self.find_latin = regex.compile(WORD_PATTERN).findall, re.compile(LATIN_PATTERN).findall

        chars = byte_characters()
        to_byte = {c: b for b, c in enumerate(chars)}
        self.token_bytes = [b""] * (max(*vocab.values(), *self.added.values()) + 1)
        for token, i in chain(vocab.items(), self.added.items()):
            known = all(c in to_byte for c in token)
            self.token_bytes[i] = bytes(map(to_byte.get, token)) if known else token.encode()
        self.byte_ids = np.array([vocab[c] for c in chars], np.int32)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.span = len(self.token_bytes)
        keys = np.array([vocab[a] * self.span + vocab[b] for a, b in pairs], np.int64)
        self.table_keys, self.table_ranks, self.probes = hash_table(keys)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs))))
        self.cache: dict[str, bytes] = {}

    def pair_ranks(self, left, right):
        """Ranks of the pairs; NO_RANK where one side is missing (-1) or the pair is never merged."""
        key = left.astype(np.int64) * self.span + right
        slot = hash_slot(key)
        result = np.where(self.table_keys[slot] == key, self.table_ranks[slot], NO_RANK)
        for step in range(1, self.probes):
            result = np.where(self.table_keys[slot + step] == key, self.table_ranks[slot + step], result)
        return np.where((left < 0) | (right < 0), NO_RANK, result)

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of similar length, merged together row by row of one matrix."""
        width = max(map(len, words))
        sizes = np.array([len(w) for w in words])
        parts = np.full((len(words), width + 2), -1, np.int32)
        inside = np.arange(width)[None, :] < sizes[:, None]
        parts[:, :width][inside] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.pair_ranks(parts[:, :-1], parts[:, 1:])
        done, rows = [None] * len(words), np.arange(len(words))
        while len(rows):
            least = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), least]
            ended = best == NO_RANK
            if ended.any():
                left = parts[ended]
                ends = 4 * np.cumsum((left >= 0).sum(axis=1))
                flat, start = left[left >= 0].astype("<u4").tobytes(), 0
                for i, end in zip(rows[ended].tolist(), ends.tolist()):
                    done[i], start = flat[start:end], end
                rows, parts, ranks, least, best = (x[~ended] for x in (rows, parts, ranks, least, best))
                if not len(rows):
                    break
            each, n = np.arange(len(rows)), len(rows)
            parts[each, least] = self.merged[best]
            kept = np.ones(parts.shape, bool)
            kept[each, least + 1] = False  # every row loses one boundary
            parts = parts[kept].reshape(n, -1)
            ranks = ranks[kept[:, 1:]].reshape(n, -1)
            ranks[each, least] = self.pair_ranks(parts[each, least], parts[each, least + 1])
            inner = np.flatnonzero(least)
            left = least[inner] - 1
            ranks[inner, left] = self.pair_ranks(parts[inner, left], parts[inner, left + 1])
        return done

    def merge_long(self, word: bytes) -> bytes:
        """The ids of one long word: the same merges, the next smallest rank from a heap."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n, span, rank_of = len(ids), self.span, self.rank_of
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of.get(ids[i] * span + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank_of.get(ids[i] * span + ids[j]) != rank:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank_of.get(ids[i] * span + ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank_of.get(ids[before[i]] * span + ids[i])) is not None:
                heapq.heappush(heap, (r, before[i]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def learn(self, new: list[str]) -> None:
        """Put the ids of words not seen before into the cache."""
        coded = sorted(((w.encode(), w) for w in new), key=lambda x: len(x[0]))
        short = [x for x in coded if len(x[0]) <= SHORT_WORD]
        for start in range(0, len(short), 8192):
            some = short[start : start + 8192]
            self.cache.update(zip((w for _, w in some), self.merge_short([b for b, _ in some])))
        self.cache.update((w, self.merge_long(b)) for b, w in coded[len(short) :])

    def find_words(self, text: str) -> list[str]:
        return self.find_any(text) if NOT_LATIN(text) else self.find_latin(text)

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text, added tokens taken as such wherever their string occurs; null is empty."""
        cut = []
        for text in texts:
            pieces, at = [], 0
            for m in self.added_pattern.finditer(text or ""):
                pieces += [self.find_words(text[at : m.start()]), self.added[m[0]]]
                at = m.end()
            cut.append([*pieces, self.find_words(text[at:] if at else text or "")])
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        seen = set().union(*(p for pieces in cut for p in pieces if isinstance(p, list)))
        self.learn([w for w in seen if w not in self.cache])
        get = self.cache.__getitem__
        return [
            np.frombuffer(
                b"".join(
                    b"".join(map(get, p)) if isinstance(p, list) else np.array([p], "<u4").tobytes() for p in pieces
                ),
                "<u4",
            )
            for pieces in cut
        ]

    def decode(self, ids: np.ndarray) -> str:
        """The text of one id array; bytes that are not UTF-8 become the replacement character."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBPE:
    """One vocabulary per worker process."""
    return ByteBPE(path)


def encode_documents(
    df: DataFrame,
    text: str = "text",
    ids: str = "ids",
    digest: str = "ids_sha256",
    path: str | None = None,
    decoded: str | None = None,
) -> DataFrame:
    """Add the token ids of whole texts and the SHA-256 of the ids as little-endian 32-bit integers.

    ``decoded`` names a further column for the text that the ids decode to, made in the same pass.
    A null text encodes as an empty one. Every row is kept, repeated ones too; an empty table stays
    empty. Input columns named like an output give way to it. Row by row: nothing is shuffled.
    """
    path = path or default_path()

    def encode(batches):
        import hashlib

        bpe = vocabulary(path)
        for batch in slices(batches, BATCH_ROWS):
            coded = bpe.encode(batch.column(text).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in coded])]).astype(np.int32)
            values = np.concatenate(coded).astype(np.int32) if coded else np.array([], np.int32)
            arrays = {
                ids: pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                digest: pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in coded], pa.string()),
            }
            if decoded:
                arrays[decoded] = pa.array([bpe.decode(x) for x in coded], pa.string())
            yield replace_columns(batch, arrays)

    added = f"`{ids}` array<int>, `{digest}` string" + (f", `{decoded}` string" if decoded else "")
    return map_batches(df, encode, schema_with(df, added))


def decode_documents(
    df: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None, keep_ids: bool = False
) -> DataFrame:
    """Add the text that the ids decode to, in place of the ids or beside them; null ids are an empty text."""
    path = path or default_path()
    kept = df if keep_ids else df.drop(ids)

    def decode(batches):
        bpe = vocabulary(path)
        for batch in slices(batches, BATCH_ROWS):
            column = batch.column(ids)
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat, ends = column.flatten().to_numpy(), np.cumsum(sizes)
            texts = [bpe.decode(flat[b - n : b]) for b, n in zip(ends.tolist(), sizes.tolist())]
            rest = batch if keep_ids else batch.drop_columns([ids])
            yield replace_columns(rest, {text: pa.array(texts, pa.string())})

    return map_batches(df, decode, schema_with(kept, f"`{text}` string"))
