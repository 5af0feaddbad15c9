"""Chat formatting on token level: turns become ids with reserved ids around them, and a loss mask.

Role and text of a turn are encoded on their own and reserved ids, which no text can encode to, are
spliced between the segments, so a control string in a text is never a control token. It is escaped
besides, by one more backslash behind its ``<|``, so that the rendered text can be read back too. The
mask of a batch of turns is the running sum of +1 where a learned text starts and -1 behind its end.
"""

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from askgauge.llm import bpe
from askgauge.llm.common import map_batches, slices

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, SEP, END)  # their ids follow those of the vocabulary, in this order
NAMES = "|".join([*(c[2:-2] for c in CONTROLS), "endoftext"])
CONTROL = re.compile(rf"<\|(\\*)({NAMES})\|>")
ESCAPED = re.compile(rf"<\|\\(\\*)({NAMES})\|>")
LEARNED = "assistant"
PIECE = 262_144  # tokens after which a conversation goes on in a further row
TURNS = 512  # turns assembled at once


def escape(text: str) -> str:
    """No control string is left; ``unescape`` gives the text back, whatever it holds."""
    return CONTROL.sub(r"<|\\\1\2|>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<|\1\2|>", text)


def control_ids(path: str) -> tuple[int, int, int]:
    """The reserved ids of start, separator and end: the first ones behind the vocabulary."""
    first = bpe.vocabulary(path).span
    return first, first + 1, first + 2


def encoded_turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str, path: str) -> DataFrame:
    """(conv_id, turn, role, tie, body) per turn: the body is the escaped text's ids, packed for the shuffle."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    chosen = df.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.md5(said).alias("tie"),
        said.alias("text"),
    )

    def encode(batches):
        vocabulary = bpe.vocabulary(path)
        for batch in slices(batches, bpe.BATCH_ROWS):
            coded = vocabulary.encode([escape(t) for t in batch.column("text").to_pylist()])
            body = pa.array([zlib.compress(x.astype("<u4").tobytes(), 1) for x in coded], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], body], [*batch.schema.names[:4], "body"])

    return map_batches(chosen, encode, StructType([*chosen.schema.fields[:4], *StructType.fromDDL("body binary")]))


def format_conversations(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = LEARNED,
    path: str | None = None,
    piece: int = PIECE,
) -> DataFrame:
    """``conv_id``, ``piece`` (from 0), ``n_turns``, ``ids`` and ``loss_mask`` (1 in learned texts), one row a conversation.

    Turns stand in the order of turn (null first), role and MD5 of the text; equal rows are as many
    turns. A null text or role is empty, rows without a conversation id are one conversation, other
    columns are not looked at, an empty table stays empty. The rows of a conversation follow one
    another in one partition. A conversation of more than ``piece`` tokens goes on in further rows,
    each of whole turns, so no row grows with the conversation. Texts are encoded where they are read;
    one shuffle brings their packed ids together, and a task streams through its sorted turns.
    """
    path = path or bpe.default_path()
    turns = encoded_turns(df, conv_id, turn, role, text, path)
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie")

    def assemble(batches):
        vocabulary, reserved = bpe.vocabulary(path), np.array(control_ids(path), np.int32)
        start, sep, end = (reserved[i : i + 1] for i in range(3))
        roles: dict[str, np.ndarray] = {}
        held, tokens, opened, n_piece = [], 0, None, 0  # turns of the conversation that is open

        def row(key, number, turns):
            return key, number, len(turns), np.concatenate([t[0] for t in turns]), np.concatenate([t[1] for t in turns])

        def record(rows):
            keys, numbers, counts, ids, masks = zip(*rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, key_type),
                    pa.array(numbers, pa.int32()),
                    pa.array(counts, pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(masks))),
                ],
                ["conv_id", "piece", "n_turns", "ids", "loss_mask"],
            )

        key_type = None
        for batch in slices(batches, TURNS):
            key_type = batch.schema.field("conv_id").type
            who = batch.column("role").to_pylist()
            fresh = [r for r in set(who) if r not in roles]
            if len(roles) + len(fresh) > 4096:
                roles.clear()
                fresh = list(set(who))
            roles.update(zip(fresh, (x.astype(np.int32) for x in vocabulary.encode([escape(r) for r in fresh]))))
            bodies = [np.frombuffer(zlib.decompress(b), "<u4").astype(np.int32) for b in batch.column("body").to_pylist()]
            segments = [(start, roles[r], sep, body, end) for r, body in zip(who, bodies)]
            flat = np.concatenate(list(chain.from_iterable(segments)))
            sizes = np.array([[len(s) for s in turn] for turn in segments])
            bounds = np.cumsum(sizes.ravel()).reshape(sizes.shape)  # where each segment ends
            step = np.zeros(len(flat) + 1, np.int8)
            wanted = np.array([r == learned for r in who])
            np.add.at(step, bounds[wanted, 2], 1)
            np.add.at(step, bounds[wanted, 3], -1)
            mask = np.cumsum(step[:-1], dtype=np.int8)
            ends = bounds[:, 4].tolist()
            rows = []
            for key, a, b in zip(batch.column("conv_id").to_pylist(), [0, *ends], ends):
                if held and (key != opened or tokens >= piece):
                    rows.append(row(opened, n_piece, held))
                    held, tokens, n_piece = [], 0, n_piece + 1 if key == opened else 0
                opened, tokens = key, tokens + b - a
                held.append((flat[a:b], mask[a:b]))
            if rows:
                yield record(rows)
        if held:
            yield record([row(opened, n_piece, held)])

    rest = StructType.fromDDL("piece int, n_turns int, ids array<int>, loss_mask array<tinyint>")
    return map_batches(ordered, assemble, StructType([turns.schema["conv_id"], *rest]))


def read_back(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """What the ids and masks of ``format_conversations`` say, per conversation, in a pass over its rows.

    ``turns_sha256`` digests role, line break, text, line break of every turn; ``loss_chars`` and
    ``loss_sha256`` are of the text under the mask, unescaped; ``formatted_chars`` counts the rendered
    text with its control strings. The rows of a conversation must follow one another in a partition,
    as ``format_conversations`` returns them: a digest is sequential, so its state is all that is held.
    """
    path = path or bpe.default_path()
    formatted_names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches):
        import hashlib

        start, sep, end = control_ids(path)
        token = bpe.vocabulary(path).token_bytes.__getitem__
        frame = sum(map(len, CONTROLS))

        def text_of(ids):
            return b"".join(map(token, ids.tolist())).decode()

        def record(rows):
            keys, *columns = zip(*rows)
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(keys, key_type), *(pa.array(c, t) for c, t in zip(columns, types))]
            return pa.RecordBatch.from_arrays(arrays, formatted_names)

        opened, state, key_type = None, None, None
        for batch in batches:
            key_type = batch.schema.field("conv_id").type
            lists, masks = batch.column("ids"), batch.column("loss_mask")
            ends = np.cumsum(lists.value_lengths().to_numpy())
            flat, flat_mask = lists.flatten().to_numpy(), masks.flatten().to_numpy()
            done = []
            for key, piece, a, b in zip(
                batch.column("conv_id").to_pylist(), batch.column("piece").to_pylist(), [0, *ends.tolist()], ends.tolist()
            ):
                if piece == 0:
                    if state:
                        done.append((opened, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    opened, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, mask = flat[a:b], flat_mask[a:b]
                for s, p, e in zip(*(np.flatnonzero(ids == x).tolist() for x in (start, sep, end))):
                    role, text = text_of(ids[s + 1 : p]), text_of(ids[p + 1 : e])
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                    state[4] += frame + len(role) + len(text)
                edges = np.flatnonzero(np.diff(mask, prepend=0, append=0)).reshape(-1, 2)
                for s, e in edges.tolist():
                    text = unescape(text_of(ids[s:e]))
                    state[2] += len(text)
                    state[3].update(text.encode())
            if done:
                yield record(done)
        if state:
            yield record([(opened, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])])

    rest = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'bigint'}" for n in formatted_names[1:])
    return map_batches(formatted, read, StructType([formatted.schema["conv_id"], *StructType.fromDDL(rest)]))


def oracle(conversations: str) -> str:
    """The same digests in DuckDB SQL, from the texts themselves."""
    escaped = rf"regexp_replace({{}}, '<\|(\\*)({NAMES})\|>', '<|\\\1\2|>', 'g')"
    frame = sum(map(len, CONTROLS))
    order = "ORDER BY turn NULLS FIRST, role, md5(text)"
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({conversations}) c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' {order}) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
    sum({frame} + length({escaped.format("role")}) + length({escaped.format("text")}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""
