import html
import math

import pytest
from pyspark.sql import functions as F

from askgauge.functions import labels, metrics, text


def one_column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_strip_whitespace_only_trims_ascii_space(spark):
    values = [" a\t\n", "\r\fb ", "\u00a0c\u00a0", "d\u000b", "", None, " \n "]
    assert one_column(spark, values, text.strip_whitespace) == ["a", "b", "\u00a0c\u00a0", "d\u000b", "", None, ""]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("**Peru.**", "peru"),
        ('"Peru"', "peru"),
        (" Peru!.! ", "peru"),
        ("New \n  York", "new york"),
        ("'`ÉTÉ`'", "été"),
        ('*"a.b"*.', 'a.b"*'),
        ("...", ""),
    ],
)
def test_normalize_answer(spark, raw, expected):
    assert one_column(spark, [raw], text.normalize_answer) == [expected]


def test_tidy_spaces_follows_python_split(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    values = [f"{s}a{s}{s}b{s}" for s in spaces] + ["so\u00adft", "  ", "plain", "zero\u200bwidth"]
    expected = [" ".join(v.replace("\u00ad", "").replace("\u00a0", " ").split()) for v in values]
    assert one_column(spark, values, text.tidy_spaces) == expected
    assert one_column(spark, values, text.strip_python_space) == [v.strip() for v in values]
    outer = [v != v.strip() for v in values]
    assert one_column(spark, values, text.has_outer_space) == outer


def test_unescape_html(spark):
    values = ["&quot;a&quot;", "a&nbsp;b", "&amp;lt;", "&eacute;t&#233;", "no entity", "&unknown;", None, "&"]
    expected = [None if v is None else html.unescape(v) for v in values]
    assert one_column(spark, values, text.unescape_html) == expected
    assert one_column(spark, ["a&nbsp;b &quot;"], text.clean_text) == ['a b "']


def test_clean_text_list(spark):
    got = one_column(spark, [["&lt;b&gt; ", "x"], [], None, ["plain  text"]], text.clean_text_list, "array<string>")
    assert got == [["<b>", "x"], [], None, ["plain text"]]


def test_rounding_matches_scaled_rounding(spark):
    df = spark.range(1, 1000).select(F.col("id"), metrics.round_to(F.col("id") / F.lit(800.0), 4).alias("r"))
    for row in df.collect():
        assert row.r == math.floor(row.id / 800.0 * 10000 + 0.5) / 10000
    assert one_column(spark, [57 / 800], lambda c: metrics.round_to(c, 4), "double") == [0.0712]


def test_wilson_interval(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (10, 10), (7, 10)], "k long, n long")
    rows = df.select(metrics.wilson_low(F.col("k"), F.col("n")), metrics.wilson_high(F.col("k"), F.col("n"))).collect()
    assert tuple(rows[0]) == (None, None)
    assert rows[1][0] == pytest.approx(0, abs=1e-12) and rows[2][1] == pytest.approx(1)
    z, p, n = 1.96, 0.7, 10
    centre, half = p + z * z / (2 * n), z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    assert rows[3][0] == pytest.approx((centre - half) / (1 + z * z / n))
    assert rows[3][1] == pytest.approx((centre + half) / (1 + z * z / n))


def test_chance_corrected(spark):
    df = spark.createDataFrame([(0.25, 0.25), (1.0, 0.5), (0.0, 0.5)], "a double, b double")
    assert [r[0] for r in df.select(metrics.chance_corrected(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0, -1.0]


def test_lookups(spark):
    codes = ["easy", "odd", None]
    assert one_column(spark, codes, lambda c: labels.label_or_code(c, {"easy": "Facile"})) == ["Facile", "odd", None]
    assert one_column(spark, codes, lambda c: labels.lookup(c, {"easy": 1})) == [1, None, None]
    assert one_column(spark, codes, lambda c: labels.rank_in(c, ["hard", "easy"])) == [1, 2, 2]
