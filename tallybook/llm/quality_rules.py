"""Quality rules learned as a decision list, with DataFrame functions only.

Statistics of every whole text are columns. From those of labelled documents, sequential covering
learns rules for poor ones: a rule grows condition by condition (``statistic >= t`` or
``statistic <= t``) by information gain on two thirds of the rows, is cut back on the other third,
and the rows it covers are taken out before the next. The rules become one ordered conditional
expression (``when(rule 1).when(rule 2)…otherwise(keep)``).

Each step is one aggregate over the stored statistics; what reaches the driver are counts by
statistic and threshold, whose number does not depend on the data.

Defined results: a null or empty text has zero for every statistic and fails the base rule; rows
that repeat give repeated rows; labels that are null or of no document are not used, several labels
of one document all count; with no labelled rows, or of one class only, the list is empty and the
base rule decides alone.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.session import materialise

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
THRESHOLDS = 32
"""Quantiles of each statistic that a condition may use."""
MOST_RULES = 8
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.8
"""A rule must be right this often on rows that it was not grown on."""
LEAST_COVERED = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _next(values: Column) -> Column:
    """The same array moved up by one: the follower of each element, one element shorter."""
    return F.slice(values, 2, F.size(values))


def _repeat_words(words: Column) -> Column:
    """Words in a 3-word window whose words stand twice or more in the text.

    The windows are sorted with their places, so equal ones are neighbours; a word is counted with
    the first window that covers it.
    """

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.sort_array(
            F.transform(at, lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("w"), i.alias("i")))
        )

    def places(s: Column) -> Column:
        same = F.zip_with(s, _next(s), lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False)))
        return _let(
            same,
            lambda e: F.sort_array(
                F.filter(
                    F.zip_with(
                        s,
                        F.zip_with(
                            e,
                            F.concat(F.array(F.lit(False)), e),
                            lambda a, b: F.coalesce(a, F.lit(False)) | b,
                        ),
                        lambda x, twice: F.when(twice, x["i"]),
                    ),
                    lambda p: p.isNotNull(),
                )
            ),
        )

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, _next(p), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    return F.when(
        F.size(words) >= 3, _let(_let(windows(words), places), covered)
    ).otherwise(0)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, further counts, and the statistics that rules are made of.

    Reads ``doc_id`` and ``text`` only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("t")).select(
        "doc_id",
        "t",
        F.filter(F.split("t", GAP), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("l"),
    )

    def without(chars: str) -> Column:
        return F.length("t") - F.length(F.translate("t", chars, ""))

    rows = rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _let(F.col("w"), _repeat_words).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        without("0123456789").cast("long").alias("n_digits"),
        without("!?").cast("long").alias("n_shouts"),
    )
    share = lambda part, whole: F.coalesce(100 * F.col(part) / F.expr(f"nullif({whole}, 0)"), F.lit(0.0))
    return rows.withColumns(
        {
            "symbol_pct": share("n_symbols", "word_chars"),
            "upper_pct": share("n_upper", "word_chars"),
            "digit_pct": share("n_digits", "word_chars"),
            "shout_pct": share("n_shouts", "word_chars"),
            "repeat_pct": share("n_repeat_words", "n_words"),
            "dup_line_pct": share("n_dup_lines", "n_lines"),
            "word_length": share("word_chars", "n_words") / 100,
        }
    )


STATISTICS = (
    "symbol_pct", "upper_pct", "digit_pct", "shout_pct", "repeat_pct", "dup_line_pct", "word_length"
)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")
    )


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    return functools.reduce(lambda a, b: a & b, (c.column() for c in rule), F.lit(True))


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    if not p1:
        return -math.inf
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def _grown(rows: DataFrame, grid: dict[str, list[float]]) -> tuple[Rule, int, int]:
    """One rule, a condition at a time; and what it covers on the rows it was grown on."""
    rule: Rule = ()
    counts = rows.agg(F.sum("poor"), F.count(F.lit(1))).first()
    p0 = int(counts[0] or 0)
    n0 = counts[1] - p0
    while len(rule) < MOST_CONDITIONS and p0 >= LEAST_COVERED and n0:
        # one row per statistic: in how many of its thresholds' steps the value lies
        steps = F.array(
            *[
                F.struct(
                    F.lit(s).alias("s"),
                    F.size(F.filter(F.array(*map(F.lit, grid[s])), functools.partial(_below, s))).alias("b"),
                    F.array_contains(F.array(*map(F.lit, grid[s])), F.col(s)).alias("on"),
                )
                for s in STATISTICS
            ]
        )
        table = (
            rows.filter(_all(rule))
            .select("poor", F.explode(steps).alias("x"))
            .groupBy("x.s", "x.b", "x.on")
            .agg(F.sum("poor").alias("p"), F.count(F.lit(1)).alias("c"))
            .collect()
        )
        best: tuple[float, Condition, int, int] | None = None
        for s in STATISTICS:
            own = [r for r in table if r["s"] == s]
            for k, t in enumerate(grid[s]):
                for at_least in (True, False):
                    inside = [r for r in own if (r["b"] > k if at_least else r["b"] <= k or (r["on"] and r["b"] == k + 1))]
                    p = sum(r["p"] for r in inside)
                    n = sum(r["c"] for r in inside) - p
                    gain = _gain(p0, n0, p, n)
                    found = (gain, Condition(s, at_least, t), p, n)
                    if best is None or gain > best[0] + 1e-9:
                        best = found
        if best is None or best[0] <= 1e-9 or best[2] < LEAST_COVERED:
            break
        _, condition, p0, n0 = best
        rule = (*rule, condition)
    return rule, p0, n0


def _below(statistic: str, t: Column) -> Column:
    return t <= F.col(statistic)


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The first conditions of the rule that are best on rows it was not grown on."""
    sums = []
    for k in range(1, len(rule) + 1):
        inside = _all(rule[:k]).cast("int")
        sums += [F.sum(inside * F.col("poor")).alias(f"p{k}"), F.sum(inside).alias(f"c{k}")]
    row = rows.agg(*sums).first()
    worth = {}
    for k in range(1, len(rule) + 1):
        p, c = int(row[f"p{k}"] or 0), int(row[f"c{k}"] or 0)
        worth[k] = ((2 * p - c) / c if c else -1.0, -k, p, c - p)
    k = max(worth, key=lambda i: worth[i][:2])
    return rule[:k], worth[k][2], worth[k][3]


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for poor documents from ``labels`` (``doc_id, quality``; 0 is poor), in order."""
    known = labels.filter("quality IS NOT NULL").select(
        F.col("doc_id").alias("_of"), (F.col("quality") == 0).cast("int").alias("poor")
    )
    rows = stats.join(known, F.col("doc_id") == F.col("_of")).filter(~base_failed())
    rows, n = materialise(
        rows.select("poor", *STATISTICS, (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grow")), "labelled"
    )
    if not n:
        return []
    cuts = [(k + 0.5) / THRESHOLDS for k in range(THRESHOLDS)]
    marks = rows.agg(*[F.percentile_approx(s, cuts, 10_000).alias(s) for s in STATISTICS]).first()
    grid = {s: sorted(set(marks[s])) for s in STATISTICS}
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        left = rows.filter(~functools.reduce(lambda a, b: a | b, map(_all, rules), F.lit(False)))
        rule, _, _ = _grown(left.filter("grow"), grid)
        if not rule:
            break
        rule, p, n = _pruned(left.filter("NOT grow"), rule)
        if p < max(LEAST_COVERED * 0.4, 1) or p < LEAST_PRECISION * (p + n):
            break
        rules.append(rule)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True for documents to keep: the ordered conditional of the decision list."""
    if not rules:
        return F.lit(True)
    return functools.reduce(
        lambda chain, rule: chain.when(_all(rule), False), rules[1:], F.when(_all(rules[0]), False)
    ).otherwise(True)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its statistics, ``base_failed`` and ``kept``."""
    stats, _ = materialise(statistics(docs), "text-statistics")
    rules = learn(stats, labels)
    return stats.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules)
    )
