import re

import pytest
from pyspark.sql import functions as F

from askgauge.llm import queries, repeats
from oracle_compare import compare, connect

LONG = "One two three four five six seven eight nine ten. And then eleven twelve thirteen fourteen, fifteen sixteen seventeen eighteen."
CHINESE = "人工智能正在改变我们的日常生活方式和工作环境"


def spans_of(text):
    """(start, end, least) of lines, sentences and pieces, by walking over the characters."""
    found, at = {}, 0
    for line in text.split("\n"):
        ends, capitals = {0, len(line)}, set()
        for i in range(1, len(line)):
            if line[i] not in " \t" and re.search(r"([.!?][ \t]+|[。！？][ \t]*)$", line[:i]):
                ends.add(i)
            elif line[i - 1] in " \t" and re.match("[A-ZÀ-ÖØ-Þ]", line[i]):
                capitals.add(i)
        for cuts, least in ((ends | capitals, 20), (ends, 10), ({0, len(line)}, 10)):
            cuts = sorted(cuts)
            found.update({(at + a, at + b): least for a, b in zip(cuts, cuts[1:])})
        at += len(line) + 1
    return sorted((a, b, least) for (a, b), least in found.items())


def brute(rows):
    seen, removed = set(), {}
    for doc, text in sorted(rows):
        for a, b, least in spans_of(text or ""):
            words = (text or "")[a:b].lower().split()
            unspaced = [c for w in words for c in w if "\u0e00" <= c <= "\u0eff" or "\u3040" <= c <= "\u30ff" or "\u4e00" <= c <= "\u9fff"]
            if len(words) < least and len(unspaced) < 2 * least:
                continue
            if tuple(words) in seen:
                removed.setdefault(doc, []).append((a, b))
            seen.add(tuple(words))
    return removed


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r for r in repeats.remove_repeats(df).collect()}


def merged(spans):
    out = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def test_against_brute_force(spark):
    rows = [
        (1, f"Start of it. {LONG}\nshort line\n{LONG}"),
        (2, f"{LONG}\nown words only in this one here"),
        (3, f"put in the middle {LONG} and more words follow it here"),
        (4, "short line\nshort line"),
        (5, LONG.upper().replace(" ", "   ")),
        (6, f"\n\n{LONG}\n\nÉté a b c d e f g h i. Été a b c d e f g h i."),
        (7, f"x {CHINESE}。y"), (8, f"{CHINESE}。{CHINESE}。\n{CHINESE}\n{CHINESE}"),
    ]
    got, want = run(spark, rows), brute(rows)
    for doc, text in rows:
        spans = [(s["start"], s["end"]) for s in got[doc]["removed_spans"]]
        assert spans == merged(want.get(doc, []))
    assert got[3]["text"].startswith("put in the middle ") and "And then" not in got[3]["text"]
    assert got[2]["text"] == "own words only in this one here"
    assert got[4]["text"] == "short line\nshort line"


PASSAGES = {
    "german": "Die Stadt hat im Sommer viele Besucher aus dem Ausland.",
    "title case": "The Old Man And The Sea Was Written In Cuba By A Writer.",
    "chinese": CHINESE + "。",
    "japanese": "これはとても長い日本語の文章で、単語の間に空白がありません。",
    "thai": "กรุงเทพมหานครเป็นเมืองหลวงและนครที่มีประชากรมากที่สุด",
}


@pytest.mark.parametrize("passage", PASSAGES.values(), ids=PASSAGES)
def test_whole_sentences_whatever_the_script(spark, passage):
    alone, inside = (1, f"{passage}\nother"), (2, f"Something else. {passage} \nat the end")
    got = run(spark, [alone, inside, (3, passage), (4, f"First line.\n{passage}")])
    assert got[1]["text"] == alone[1] and got[3]["text"] == "" and got[4]["text"] == "First line.\n"
    assert got[2]["text"] == "Something else. \nat the end"


def test_common_short_units_stay(spark):
    rows = [(i, f"We met {name} in the old Town hall.\nAll rights reserved.\n{name} 日本語の質問") for i, name in enumerate(("Ann", "Bob", "Ann"))]
    got = run(spark, rows)
    assert all(got[i]["text"] == t for i, t in rows)
    # A piece between two capitals needs twice the words of a sentence.
    ten, twenty = ("Then " + " ".join("abcdefghijklmnopqrstuvw"[:n]) for n in (12, 19))
    for piece, stays in ((ten, True), (twenty, False)):
        text = f"so it was for Bob {piece} Alice agreed"
        assert (run(spark, [(1, f"here is what Carl {piece} Dora thought"), (2, text)])[2]["text"] == text) == stays


def test_very_long_text_and_clashing_names(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    df = spark.createDataFrame([(1, long, 7, "a"), (2, f"{long}.\nend", 8, "b")], "doc_id long, text string, key int, found string")
    df = df.withColumns({"__key": F.lit(1), "their_id": F.lit(2), "_found": F.lit(3), "digest": F.lit(4)})
    got = {r["doc_id"]: r for r in repeats.remove_repeats(df).collect()}
    assert got[1]["text"] == long and got[2]["text"] == f"{long}.\nend" and got[2]["key"] == 8 and got[2]["found"] == "b"
    again = {r["doc_id"]: r for r in repeats.remove_repeats(df.withColumn("text", F.lit(long))).collect()}
    assert again[1]["text"] == long and again[2]["text"] == "" and again[2]["_found"] == 3


def test_offsets_point_into_the_original(spark):
    rows = [(1, LONG), (2, f"x y. {LONG}\nend of the text")]
    got = run(spark, rows)[2]
    text = rows[1][1]
    cut = "".join(text[s["start"] : s["end"]] for s in got["removed_spans"])
    assert cut.split() == LONG.split()


def test_awkward_tables(spark):
    rows = [(1, LONG, "a"), (1, LONG, "a"), (None, LONG, "b"), (2, None, "c"), (3, "", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, removed_spans string").withColumn("h", F.lit(1))
    got = repeats.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "h", "removed_spans"]
    texts = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert texts == sorted([(1, LONG), (1, LONG), (None, ""), (2, None), (3, "")], key=repr)
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_query_equals_sql(spark, sf_dir):
    build, sql = queries.QUERIES["op6_repeats"], queries.ORACLES["op6_repeats"]
    n, problems, *_ = compare(spark, connect(sf_dir), build, sql, sf_dir)
    assert n > 0 and problems == []


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(rows)
    got = queries.QUERIES["op6_repeats"](spark, sf_dir).collect()
    assert len(got) == len(rows) and want
    for r in got:
        assert r["spans"] == ",".join(f"{a}-{b}" for a, b in merged(want.get(r["doc_id"], [])))
