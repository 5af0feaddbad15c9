"""Learned decision list: ordered threshold rules that reject documents, as Spark conditional expressions.

Sequential covering on labelled documents: a rule is grown condition by condition by information gain
on two thirds of them, pruned on the rest, and kept if it stays precise; the rows it covers leave, and
the next rule is grown. Every statistic comes from one grouped count over feature bins, so the driver
sees a few hundred counts and no row. Features, learning and verdict are built-in functions only.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from askgauge.llm.common import remainder, words, written

SYMBOLS = "[#*$%&|<>]"
FEW_REPEATED = 48
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# What rules may test, from the counts above and two more.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_windows", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
}
FEATURES = ("n_words", *RATIOS)


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def _repeated_words(windows: Column) -> Column:
    """Words in windows of three that occur twice or more, given the windows' hashes in order.

    Equal hashes are neighbours once sorted. A few repeated ones are looked up per window; if there
    are many, the windows' places are sorted along with their hashes, so that the cost of a text full
    of repetition does not grow with the square of its length. Both ways find the same places.
    """
    none = F.lit(False)
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("end"))

    def covered(places):  # windows in ascending order overlap by at most two words
        return F.aggregate(
            places,
            start,
            lambda acc, i: F.struct(
                (acc["n"] + 3 - F.greatest(F.lit(0), acc["end"] - i)).alias("n"), (i + 3).alias("end")
            ),
            lambda acc: acc["n"],
        )

    def looked_up(repeated):
        places = F.transform(windows, lambda h, i: F.when(F.array_contains(repeated, h), i))
        return covered(F.filter(places, lambda i: i.isNotNull()))

    def sorted_along(s):
        def twin(x, j):
            return F.coalesce(F.get(s, j - 1)["h"] == x["h"], none) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], none)

        return covered(F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"])))

    def by_number(repeated):
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(repeated) <= FEW_REPEATED, looked_up(repeated)).otherwise(_let(pairs, sorted_along))

    def repeated_hashes(s):
        return F.array_distinct(F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1) == x, none)))

    has_any = F.size(F.array_distinct(windows)) < F.size(windows)
    repeated = _let(F.sort_array(windows), repeated_hashes)
    return F.when(has_any, _let(repeated, by_number)).otherwise(0)


def with_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Add a struct ``__f`` of counts and ratios of each whole text; a null text has no words.

    Ratios of a text without words are 0. The struct comes out of a generator of one row, so that
    later filters use it instead of computing it again.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # A line counts if it holds any character but the six ASCII spaces.
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    listed = df.withColumn("__words", words(body))
    listed = listed.withColumn(
        "__windows",
        F.when(
            F.size("__words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("__words") - 3),
                lambda i: F.xxhash64(
                    F.get(F.col("__words"), i), F.get(F.col("__words"), i + 1), F.get(F.col("__words"), i + 2)
                ),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    counts = F.struct(
        F.size("__words").cast("bigint").alias("n_words"),
        (F.length(body) - _occurrences(body, "[\\x20\\x09-\\x0D]")).alias("word_chars"),
        _occurrences(body, SYMBOLS).alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("__windows")).cast("bigint").alias("n_repeat_words"),
        F.size(F.array_distinct("__windows")).cast("bigint").alias("n_distinct_windows"),
        _occurrences(body, "[A-Z]").alias("n_upper"),
        _occurrences(body, "[!?;:=~^@_/+{}]").alias("n_marks"),
    )
    return listed.select(*df.columns, F.explode(F.array(counts)).alias("__f"))


def feature(name: str) -> Column:
    if name not in RATIOS:
        return F.col(f"__f.{name}").cast("double")
    top, bottom = (F.col(f"__f.{n}").cast("double") for n in RATIOS[name])
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def base_failed() -> Column:
    """The fixed rule: under 50 words, or over half of the words in repeated windows."""
    n_words, repeated = F.col("__f.n_words"), F.col("__f.n_repeat_words")
    return (n_words < 50) | (100 * repeated > 50 * n_words)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, value: Column) -> Column:
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple
    bad: int
    good: int

    def column(self, value=feature) -> Column:
        test = F.lit(True)
        for c in self.conditions:
            test = test & c.column(value(c.feature))
        return test

    def __str__(self):
        return " and ".join(map(str, self.conditions))


def _bins(labelled: DataFrame, n_bins: int) -> dict:
    """Candidate thresholds of each feature: midway between neighbours among both classes' quantiles."""
    shares = [i / n_bins for i in range(n_bins + 1)]
    rows = (
        labelled.groupBy("bad").agg(*(F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES)).collect()
    )
    seen = {f: sorted({v for r in rows for v in r[f] or ()}) for f in FEATURES}
    return {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in seen.items()}


def _counts(rows: DataFrame, cuts: dict) -> dict:
    """Bad and good rows at or below every threshold of every feature, from one grouped count."""

    def bin_of(f):
        below = F.filter(F.array(*map(F.lit, cuts[f])), lambda c: c < F.col(f))
        return F.struct(F.lit(f).alias("feature"), F.size(below).alias("bin"))

    pairs = F.array(*(bin_of(f) for f in FEATURES if cuts[f]))
    found = rows.select("bad", F.explode(pairs).alias("p")).groupBy("p.feature", "p.bin", "bad").count().collect()
    table = {f: [[0, 0] for _ in range(len(v) + 1)] for f, v in cuts.items()}
    for r in found:
        table[r["feature"]][r["bin"]][0 if r["bad"] else 1] += r["count"]
    return table


def _gain(bad, good, bad0, good0):
    """How much a condition raises the share of bad rows, times the bad rows it keeps."""
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0))) if bad else 0.0


def _best_condition(table: dict, cuts: dict):
    best = (0.0, "", None)
    for f in sorted(cuts):
        bad0, good0 = (sum(x[k] for x in table[f]) for k in (0, 1))
        bad = good = 0
        for cut, here in zip(cuts[f], table[f]):
            bad, good = bad + here[0], good + here[1]
            for above, b, g in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                condition = Condition(f, above, cut)
                gain = _gain(b, g, bad0, good0) if b + g else 0.0
                if gain > best[0] + 1e-9:
                    best = (gain, str(condition), condition)
    return best[2]


def _covered(rows: DataFrame, conditions) -> list:
    """(bad, good) covered by each leading part of the conditions."""
    parts = [Rule(tuple(conditions[: k + 1]), 0, 0).column(F.col) for k in range(len(conditions))]
    row = rows.agg(
        *(F.count_if(p & F.col("bad")).alias(f"b{k}") for k, p in enumerate(parts)),
        *(F.count_if(p & ~F.col("bad")).alias(f"g{k}") for k, p in enumerate(parts)),
    ).first()
    return [(row[f"b{k}"], row[f"g{k}"]) for k in range(len(parts))]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.97,
    n_bins: int = 24,
) -> list[Rule]:
    """Rules that pick out the documents labelled ``quality`` 0, in the order they are to be tried.

    Fitted on at most ``max_labelled`` labelled documents, those with the smallest hash of their id.
    Labels without id or quality are ignored; a document labelled both ways counts as good; labels
    whose document is absent play no part. Without bad examples the list is empty.
    """
    # Bounded by max_labelled: always small enough to broadcast.
    chosen = (
        labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__quality"))
        .where(F.col("__id").isNotNull() & F.col("__quality").isNotNull())
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_labelled)
        .groupBy("__id")
        .agg((F.max("__quality") == 0).alias("bad"))
    )
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    known = with_features(texts.join(F.broadcast(chosen), "__id"), "__text").where(~base_failed())
    # The features of at most max_labelled documents: few enough for one partition, which every later
    # count reads without a shuffle. They get there by a shuffle, so that all tasks share the texts.
    labelled = written(
        known.select(
            "bad", (remainder(F.col("__id"), 3) == 0).alias("prune"), *(feature(f).alias(f) for f in FEATURES)
        ).repartition(1),
        "decision-rules",
    ).cache()
    cuts, rules, left = _bins(labelled, n_bins), [], labelled
    while any(cuts.values()) and len(rules) < max_rules:
        grow, prune = left.where(~F.col("prune")), left.where("prune")
        conditions, rows = [], grow
        while len(conditions) < max_conditions:
            condition = _best_condition(_counts(rows, cuts), cuts)
            if condition is None:
                break
            conditions.append(condition)
            rows = rows.where(condition.column(F.col(condition.feature)))
        if not conditions:
            break
        pruned = _covered(prune, conditions)
        # The shortest part that is the most precise on rows that did not choose the conditions.
        worth = [(b + 1) / (b + g + 2) for b, g in pruned]
        keep = max(range(len(worth)), key=lambda k: (round(worth[k], 9), -k)) + 1
        conditions = conditions[:keep]
        bad, good = _covered(left, conditions)[-1]
        if not bad or bad < min_precision * (bad + good):
            break
        rules.append(Rule(tuple(conditions), bad, good))
        left = left.where(~rules[-1].column(F.col))
    labelled.unpersist()
    return rules


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """The list as one conditional expression: the first rule that holds (from 1; null if none), and kept."""
    first = F.when(F.lit(False), 0)
    for i, rule in enumerate(rules, start=1):
        first = first.when(rule.column(), i)
    return first, first.isNull()


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Add the counts, ``base_failed``, ``rule`` and ``kept`` of every whole text.

    A null or blank text has no words and fails the fixed rule. Each row is judged by itself, so
    repeated rows get the same verdict; an empty table stays empty. Input columns named like an
    output give way to it.
    """
    made = {*COUNTS, "base_failed", "rule", "kept"}
    kept = [c for c in docs.columns if c.lower() not in made or c == text]
    rule, passes = verdict(rules)
    return with_features(docs.select(*kept), text).select(
        *(c for c in kept if c.lower() not in made),
        *(F.col(f"__f.{c}").alias(c) for c in COUNTS),
        base_failed().alias("base_failed"),
        rule.alias("rule"),
        (~base_failed() & passes).alias("kept"),
    )


def filter_documents(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The documents that pass the fixed rule and the list, with their own columns only."""
    passes = ~base_failed() & verdict(rules)[1]
    return with_features(docs, text).where(passes).select(*docs.columns)
