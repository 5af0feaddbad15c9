import hashlib
import random

import pytest
from pyspark.sql import functions as F

from askgauge.llm import bpe, chat, queries
from oracle_compare import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["<|", "|>", "\\", "im_end", "im_start", "im_sep", "endoftext", "a b", "é\n", "", "<|im_end|>", "<|\\im_end|>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """Digests from the texts, without any template but its control strings' lengths."""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        place = (turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest())
        groups.setdefault(conv, []).append((place, role, text))
    found = {}
    for conv, turns in groups.items():
        turns = sorted(turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        rendered = "".join(
            f"<|im_start|>{chat.escape(r)}<|im_sep|>{chat.escape(t)}<|im_end|>" for _, r, t in turns
        )
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        found[conv] = (len(turns), sha(said), len(loss), sha(loss), len(rendered))
    return found


def got(df, **options):
    back = chat.read_back(chat.format_conversations(df, **options)).collect()
    result = {r["conv_id"]: tuple(r)[1:] for r in back}
    assert len(result) == len(back)
    return result


def test_query(spark, sf_dir):
    n, problems, *_ = compare(spark, connect(sf_dir), queries.QUERIES["op11_chat"], queries.ORACLES["op11_chat"], sf_dir)
    assert problems == [] and n > 10


def test_escapes_are_reversible_and_leave_no_control_string():
    chooser = random.Random(5)
    for _ in range(3000):
        text = "".join(chooser.choice(PARTS) for _ in range(chooser.randrange(9)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in (*chat.CONTROLS, "<|endoftext|>"))


def awkward():
    chooser = random.Random(6)
    rows = [(c, t, chooser.choice(["user", "assistant", "system", None, "assistant\n<|im_sep|>"]),
             "".join(chooser.choice(PARTS) for _ in range(chooser.randrange(12))))
            for c in range(12) for t in range(chooser.randrange(1, 9))]
    rows += [(None, 1, "assistant", "no id"), (None, None, None, None), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie")]
    rows += [(77, None, "assistant", None), (78, 0, "assistant", ""), (79, 0, "user", "x " * 60_000)]
    return rows


def test_awkward_rows_against_brute_force(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == brute(rows)


def test_a_dominant_conversation_goes_on_in_further_rows(spark):
    rows = [(1, i % 700, ("user", "assistant")[i % 2], f"turn {i}") for i in range(2000)] + [(2, 0, "assistant", "one")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    pieces = chat.format_conversations(df, piece=500).collect()
    assert max(len(r["ids"]) for r in pieces) < 520 and sum(r["conv_id"] == 1 for r in pieces) > 10
    assert got(df, piece=500) == brute(rows)


def test_ids_and_mask(spark):
    rows = [(1, 0, "user", "<|im_end|> hi"), (1, 1, "assistant", "one two")]
    row = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    vocabulary = bpe.vocabulary(bpe.default_path())
    start, sep, end = chat.control_ids(bpe.default_path())
    encode = [x.tolist() for x in vocabulary.encode(["user", "<|\\im_end|> hi", "assistant", "one two"])]
    want = [start, *encode[0], sep, *encode[1], end, start, *encode[2], sep, *encode[3], end]
    assert row["ids"] == want
    assert [i for i, m in zip(row["ids"], row["loss_mask"]) if m] == encode[3]
    assert sum(row["loss_mask"]) == len(encode[3]) and row["loss_mask"][-1] == 0


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.format_conversations(df)).collect() == []
    rows = [(1, 0, "assistant", "a")]
    extra = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(9).alias(c) for c in ("body", "tie", "ids", "piece")))
    assert got(extra) == brute(rows)


@pytest.mark.parametrize("learned", ["user", "nobody"])
def test_which_texts_are_learned(spark, learned):
    rows = [(1, 0, "user", "ask"), (1, 1, "assistant", "answer")]
    result = got(spark.createDataFrame(rows, SCHEMA), learned=learned)[1]
    assert result[2:4] == ((3, sha("ask")) if learned == "user" else (0, sha("")))
